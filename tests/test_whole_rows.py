"""No row is lost or left over in loads, sinks and parsing."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from courtgrid.functions import scalars as S
from courtgrid.operators import merge as M
from courtgrid.operators import quality as Q
from courtgrid.operators import watermark as T
from courtgrid.sources import payloads as PL
from courtgrid.sources import snapshot as SN
from courtgrid.sources.tables import write_table


def test_every_response_is_good_or_rejected(spark, tmp_path):
    texts = {"ok": '{"IsSuccessStatusCode": true, "Data": []}', "failed": '{"IsSuccessStatusCode": false}',
             "absent": '{"Data": []}', "null": '{"IsSuccessStatusCode": null}',
             "message": '{"IsSuccessStatusCode": true, "ErrorMessage": "no"}', "broken": '{"IsSuccessStatusCode": tr'}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    good, bad = PL.split_status_a(PL.read_landed(spark, str(tmp_path), PL.envelope_a("Id STRING")))
    names = lambda df: sorted(r[0].rsplit("/", 1)[1] for r in df.select("_file").collect())
    assert names(good) == ["ok.json"]
    assert names(bad) == sorted(f"{n}.json" for n in texts if n != "ok")


def test_overwrite_leaves_no_old_partition(spark, tmp_path):
    df = spark.createDataFrame([("t", 1), ("u", 2)], "client_code string, x int")
    write_table(df, str(tmp_path / "mart"), partition_by=["client_code"])
    write_table(df.filter("client_code = 't'"), str(tmp_path / "mart"), partition_by=["client_code"])
    assert spark.read.parquet(str(tmp_path / "mart")).count() == 1


def test_merge_removes_emptied_partitions(spark, tmp_path):
    base = str(tmp_path / "table")
    df = spark.createDataFrame([("t", 1), ("u/v", 2), ("w", 3)], "client_code string, x int")
    SN.merge_partitions(spark, base, df, lambda cur, inc: inc, ["client_code"])
    gone = df.filter("client_code = 'u/v'")
    SN.merge_partitions(spark, base, gone, lambda cur, inc: cur.filter("false"), ["client_code"])
    left = spark.read.schema(df.schema).parquet(base).collect()
    assert sorted(r["x"] for r in left) == [1, 3]


def test_rows_without_a_time_are_loaded(spark):
    batch = spark.createDataFrame([("a", None), ("b", dt.datetime(2025, 1, 9)), ("c", dt.datetime(2020, 1, 1))],
                                  "k string, at timestamp")
    resolved = spark.createDataFrame([("s", dt.datetime(2025, 1, 5))], "source_name string, watermark timestamp")
    got = T.incremental(batch, resolved, "at", F.lit("s"))
    assert sorted(r["k"] for r in got.collect()) == ["a", "b"]


def test_upsert_takes_one_row_of_a_repeated_key(spark):
    current = spark.createDataFrame([(1, "old")], "k int, v string")
    batch = spark.createDataFrame([(1, "b"), (1, "a"), (None, "x"), (None, "x")], "k int, v string")
    got = sorted(((r["k"], r["v"]) for r in M.upsert(current, batch, ["k"]).collect()), key=str)
    assert got == [(1, "a"), (None, "x"), (None, "x")]


def test_duplicate_report_has_null_keys(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("b", 1, 3)], "x string, y int, z int")
    assert sorted(r["z"] for r in Q.duplicate_report(df, ["x", "y"]).collect()) == [1, 2]


@pytest.mark.parametrize("text, want", [
    ("2025-01-06T10:00:00.1234567Z", dt.datetime(2025, 1, 6, 10, 0, 0, 123456)),
    ("2025-01-06T10:00:00.123456789+01:00", dt.datetime(2025, 1, 6, 9, 0, 0, 123456)),
    ("20250106T100000Z", dt.datetime(2025, 1, 6, 10)),
    ("20250106T1000", dt.datetime(2025, 1, 6, 10)),
    ("20250106", dt.datetime(2025, 1, 6)),
    ("2025-01-06T10:00:00,5Z", dt.datetime(2025, 1, 6, 10, 0, 0, 500000)),
    ("2025-01-06 10:00", dt.datetime(2025, 1, 6, 10)),
    ("nonsense", None),
])
def test_iso_forms(spark, text, want):
    got = spark.range(1).select(S.parse_iso_utc(F.lit(text)).cast("timestamp_ntz").alias("t")).first()["t"]
    assert got == want
