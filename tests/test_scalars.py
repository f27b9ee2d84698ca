"""Golden cases of the scalar functions (FIXTURES §3) and quirks Q11, Q20, Q21."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from courtgrid.functions import scalars as S


def _eval(spark, fn, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_phone_both_variants(spark):
    vals = ["2345678901", "12345678901", "+12345678901", "+442071234567", "", None, "   "]
    assert _eval(spark, S.normalize_phone_ingest, vals) == [
        "+12345678901", "+12345678901", "+12345678901", "+442071234567", None, None, None]
    assert _eval(spark, S.normalize_phone_model, vals) == [
        "+12345678901", "+12345678901", "+12345678901", "+442071234567", None, None, None]


def test_phone_model_formatted(spark):
    assert _eval(spark, S.normalize_phone_model, ["(234) 567-8901"]) == ["+12345678901"]


def test_phone_variants_differ_q11(spark):
    vals = ["+1 (234) 567-8901", "1234567890123", "23456789012"]
    assert _eval(spark, S.normalize_phone_ingest, vals) == ["+12345678901", "+12345678901", "+23456789012"]
    assert _eval(spark, S.normalize_phone_model, vals) == ["+1 (234) 567-8901", "+14567890123", "+13456789012"]


def test_phone_ingest_strips_tabs_q21(spark):
    assert _eval(spark, S.normalize_phone_ingest, ["\t2345678901\n"]) == ["+12345678901"]
    assert _eval(spark, S.normalize_phone_ingest, ["12345"]) == [None]


def test_email_cases(spark):
    vals = ["John.Doe@Example.COM", "  user@email.com  ", "", None, "a@b@c", "@x", "x@"]
    assert _eval(spark, S.normalize_email_ingest, vals) == [
        "john.doe@example.com", "user@email.com", None, None, None, None, None]
    assert _eval(spark, S.normalize_email_model, vals) == [
        "john.doe@example.com", "user@email.com", None, None, "a@b@c", None, None]


def test_email_trim_differs_q21(spark):
    # Python strip() cuts the tab; SQL trim() does not, so the model keeps it.
    assert _eval(spark, S.normalize_email_ingest, ["\tA@B.com"]) == ["a@b.com"]
    assert _eval(spark, S.normalize_email_model, ["\tA@B.com"]) == ["\ta@b.com"]


def test_courts_text_and_array(spark):
    assert _eval(spark, S.parse_courts_text, ["Court #1, Court #2", " , Court #3 ,", None]) == [
        ["Court #1", "Court #2"], ["Court #3"], []]
    df = spark.createDataFrame([([{"Label": " Court #1 "}, {"Label": None}, {"Label": ""}],), (None,)],
                               "x array<struct<Label:string>>")
    assert [r[0] for r in df.select(S.parse_courts_array(F.col("x"))).collect()] == [["Court #1"], []]


def test_time_label_and_duration(spark):
    df = spark.createDataFrame([("2025-01-01 17:00:00", "2025-01-01 18:30:00"),
                                ("2025-01-01 00:30:00", "2025-01-01 00:45:00")], "a string, b string")
    df = df.select(F.col("a").cast("timestamp").alias("a"), F.col("b").cast("timestamp").alias("b"))
    rows = df.select(S.time_label(F.col("a")), S.time_label(F.col("b")), S.duration_text("a", "b"),
                     S.rounded_minutes("a", "b")).collect()
    assert [tuple(r) for r in rows] == [("5 PM", "6:30 PM", "1.5 hours", 90), ("12:30 AM", "12:45 AM", "15 minutes", 15)]


def test_pg_text_and_keys(spark):
    df = spark.createDataFrame([("2025-01-01 17:00:00",), ("2025-01-01 17:00:00.250",)], "a string")
    rows = df.select(S.pg_timestamptz_text(F.col("a").cast("timestamp"))).collect()
    assert [r[0] for r in rows] == ["2025-01-01 17:00:00+00", "2025-01-01 17:00:00.25+00"]
    k = spark.range(1).select(S.md5_key(F.lit("a"), F.lit(None).cast("string"), F.lit("b")).alias("k"),
                              S.surrogate_key(F.lit("a"), F.lit(None).cast("string")).alias("s")).first()
    import hashlib
    assert k.k == hashlib.md5(b"a||b").hexdigest()
    assert k.s == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()


def test_parse_iso(spark):
    vals = ["2025-01-01T12:00:00Z", "2025-01-01T12:00:00+05:30", "2025-01-01T12:00:00-0400",
            "2025-01-01T12:00:00", "2025-01-01", "junk", None]
    got = _eval(spark, S.parse_iso_utc, vals)
    assert got == [dt.datetime(2025, 1, 1, 12), dt.datetime(2025, 1, 1, 6, 30), dt.datetime(2025, 1, 1, 16),
                   dt.datetime(2025, 1, 1, 12), dt.datetime(2025, 1, 1), None, None]
    ny = _eval(spark, S.parse_event_time, ["2025-01-01T12:00:00", "2025-07-01T12:00:00", "2025-01-01T12:00:00Z"])
    assert ny == [dt.datetime(2025, 1, 1, 17), dt.datetime(2025, 7, 1, 16), dt.datetime(2025, 1, 1, 12)]


def test_zone_resolution_c7(spark):
    zones = S.known_zone_names(spark)
    df = spark.createDataFrame([("Mars/Olympus",), ("Europe/Paris",), (None,)], "z string")
    got = [r[0] for r in df.select(S.resolve_zone(zones, F.col("z"), F.lit("America/Chicago"))).collect()]
    assert got == ["America/Chicago", "Europe/Paris", "America/Chicago"]


def test_dow_and_event_types(spark):
    df = spark.createDataFrame([("2025-01-05 10:00:00",)], "a string").select(F.col("a").cast("timestamp").alias("a"))
    assert df.select(S.dow_sunday0(F.col("a"))).first()[0] == 0  # a Sunday
    vals = [" adult_class ", "Drop-in", "league night", "party", "Other", None]
    assert _eval(spark, S.map_event_type, vals) == ["Class", "Open Play", "Compete", "party", "Other", None]
    keep = spark.createDataFrame([(v,) for v in vals], "x string").filter(S.keep_event_type(F.col("x")))
    assert [r[0] for r in keep.collect()] == [" adult_class ", "Drop-in", "league night", "Other"]


def test_is_full_and_truthy(spark):
    df = spark.createDataFrame([(5, 5), (4, 5), (None, 5), (5, None)], "a int, b int")
    assert [r[0] for r in df.select(S.is_full(F.col("a"), F.col("b"))).collect()] == [True, False, False, False]
    df = spark.createDataFrame([("", "b"), (None, "b"), ("a", "b")], "a string, b string")
    assert [r[0] for r in df.select(S.truthy_or(F.col("a"), F.col("b"))).collect()] == ["b", "b", "a"]
