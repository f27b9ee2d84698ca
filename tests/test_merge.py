"""Merge operators: golden cases (FIXTURES §3), quirks Q2–Q5, Q27 and merge laws."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from courtgrid.operators import merge as M

RES = ("client_code string, reservation_id string, event_id string, member_id string, "
       "reservation_created_at timestamp, reservation_updated_at timestamp, reservation_start_at timestamp, "
       "reservation_end_at timestamp, reservation_cancelled_at timestamp, created_at timestamp")
D = dt.datetime(2025, 1, 1)


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_batch_dedupe_w5(spark):
    rows = [("k1", None, 1, "a"), ("k1", None, 2, "b"),            # null/null -> last
            ("k2", 5, 1, "a"), ("k2", None, 2, "b"), ("k2", 5, 3, "c"),  # 5/null/5 -> first
            ("k3", None, 1, "a"), ("k3", 5, 2, "b")]                # null/5 -> 5
    df = spark.createDataFrame(rows, "k string, u int, pos int, v string")
    got = _rows(M.dedupe_latest(df, ["k"], "u", "pos"), ["k", "v"])
    assert got == [("k1", "b"), ("k2", "a"), ("k3", "b")]


def test_first_last_max(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 30), ("a", 3, 20), ("b", 4, 5)], "k string, pos int, id int")
    assert _rows(M.dedupe_first(df, ["k"], "pos"), ["k", "pos"]) == [("a", 1), ("b", 4)]
    assert _rows(M.dedupe_last(df, ["k"], "pos"), ["k", "pos"]) == [("a", 3), ("b", 4)]
    assert _rows(M.dedupe_max_id(df, ["k"], "id"), ["k", "id"]) == [("a", 30), ("b", 5)]


def test_null_keys_group_together(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "k string, pos int")
    assert M.dedupe_first(df, ["k"], "pos").count() == 1


def _res(rid, member, start_h, end_h, updated_h=None, created_h=0):
    return ("t", rid, "ev", member, D + dt.timedelta(hours=created_h),
            None if updated_h is None else D + dt.timedelta(hours=updated_h),
            D + dt.timedelta(hours=start_h), D + dt.timedelta(hours=end_h), None, D)


def test_merge_quirk_q2_and_q4(spark):
    prod = spark.createDataFrame([_res("r1", "m1", 10, 11), _res("r2", None, 10, 11)], RES)
    # re-sent with a new end only: stays as in production (Q2)
    # re-sent with a new start: updated
    # null member re-sent: stopped by the null-safe check (Q4)
    inc = spark.createDataFrame([_res("r1", "m1", 10, 12), _res("r2", None, 10, 13)], RES).withColumn("_pos", F.lit(1))
    nxt = M.merge_reservations(prod, inc)
    got = _rows(nxt, ["reservation_id", "reservation_end_at"])
    assert got == [("r1", D + dt.timedelta(hours=11)), ("r2", D + dt.timedelta(hours=11))]
    inc2 = spark.createDataFrame([_res("r1", "m1", 14, 15)], RES).withColumn("_pos", F.lit(1))
    got = _rows(M.merge_reservations(prod, inc2), ["reservation_id", "reservation_start_at"])
    assert got == [("r1", D + dt.timedelta(hours=14)), ("r2", D + dt.timedelta(hours=10))]
    # refresh_existing lets the new end land
    got = _rows(M.merge_reservations(prod, inc, refresh_existing=True), ["reservation_id", "reservation_end_at"])
    assert ("r1", D + dt.timedelta(hours=12)) in got


def test_upsert_laws(spark):
    cur = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 3, "z")], "k string, v int, keep string")
    inc = spark.createDataFrame([("a", 10, 1), ("c", 30, 2), ("a", 11, 3), (None, 40, 4)], "k string, v int, pos int")
    once = M.upsert(cur, inc, ["k"], update_cols=["v"], pos="pos")
    got = _rows(once, ["k", "v", "keep"])
    assert sorted(got, key=str) == sorted([("a", 10, "x"), ("b", 2, "y"), (None, 3, "z"), ("c", 30, None),
                                           (None, 40, None)], key=str)
    twice = M.upsert(once, inc, ["k"], update_cols=["v"], pos="pos")
    # upsert twice = once, except null keys never conflict (they append again)
    assert _rows(twice.filter("k is not null"), ["k", "v"]) == _rows(once.filter("k is not null"), ["k", "v"])


def test_disjoint_batches_commute(spark):
    cur = spark.createDataFrame([("a", 1)], "k string, v int")
    b1 = spark.createDataFrame([("b", 2)], "k string, v int")
    b2 = spark.createDataFrame([("c", 3)], "k string, v int")
    x = M.upsert(M.upsert(cur, b1, ["k"]), b2, ["k"])
    y = M.upsert(M.upsert(cur, b2, ["k"]), b1, ["k"])
    assert _rows(x, ["k", "v"]) == _rows(y, ["k", "v"])


def test_insert_ignore_and_replace_groups(spark):
    cur = spark.createDataFrame([("a", 1)], "k string, v int")
    inc = spark.createDataFrame([("a", 9, 1), ("b", 2, 2), ("b", 3, 3)], "k string, v int, pos int")
    assert _rows(M.insert_ignore(cur, inc, ["k"], pos="pos"), ["k", "v"]) == [("a", 1), ("b", 2)]
    cur = spark.createDataFrame([("t1", "s", "e1"), ("t1", "s", "e2"), ("t2", "s", "e3")], "c string, s string, e string")
    inc = spark.createDataFrame([("t1", "s", "e9")], "c string, s string, e string")
    assert _rows(M.replace_groups(cur, inc, ["c", "s"]), ["c", "e"]) == [("t1", "e9"), ("t2", "e3")]
    empty = inc.limit(0)
    clear = spark.createDataFrame([("t2", "s")], "c string, s string")
    assert _rows(M.replace_groups(cur, empty, ["c", "s"], clear_groups=clear), ["c", "e"]) == [("t1", "e1"), ("t1", "e2")]


def test_anti_null_safe_vs_plain(spark):
    a = spark.createDataFrame([("x", None), ("y", "1")], "k string, m string")
    b = spark.createDataFrame([("x", None)], "k string, m string")
    assert _rows(M.anti_existing(a, b, ["k", "m"], null_safe=True), ["k"]) == [("y",)]
    assert _rows(M.anti_existing(a, b, ["k", "m"], null_safe=False), ["k"]) == [("x",), ("y",)]


def test_cancellations_delete(spark):
    prod = spark.createDataFrame([("T", "r1"), ("t", "r2")], "client_code string, reservation_id string")
    cancelled = spark.createDataFrame([("t", "r1")], "client_code string, reservation_id string")
    assert _rows(M.delete_keys(prod, cancelled, ["client_code", "reservation_id"], fold_case=["client_code"]),
                 ["reservation_id"]) == [("r2",)]


def test_partial_group_limit_in_plan(spark):
    df = spark.createDataFrame([("a", 1, 1)], "k string, u int, pos int")
    plan = M.dedupe_latest(df, ["k"], "u", "pos")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_event_summary_merge_m10_m11(spark):
    cur = spark.createDataFrame([("e1", "d1", 1), ("e2", "d2", 2)], "event_id string, program_date_time string, v int")
    inc = spark.createDataFrame([("e1", "d1", 10, 1), ("e1", "d1", 11, 2), ("e3", "d3", 30, 3)],
                                "event_id string, program_date_time string, v int, _pos int")
    got = _rows(M.event_summary_merge(cur, inc), ["event_id", "v"])
    assert got == [("e1", 11), ("e2", 2), ("e3", 30)]


def test_missing_keys_and_watermark_filter(spark):
    df = spark.createDataFrame([("a", D), (None, D), ("b", D + dt.timedelta(days=2))], "k string, t timestamp")
    ok, bad = M.split_missing_keys(df, ["k"])
    assert (ok.count(), bad.count()) == (2, 1)
    assert M.drop_at_or_before(df, "t", "2025-01-01 00:00:00").count() == 1


def test_snapshot_versions(spark, tmp_path):
    from courtgrid.sources import snapshot as SN
    base = str(tmp_path / "tbl")
    a = spark.createDataFrame([("a", 1)], "k string, v int")
    assert SN.read_latest(spark, base) is None
    SN.merge_into(spark, base, a, lambda cur, inc: M.upsert(cur, inc, ["k"]))
    b = spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int")
    v = SN.merge_into(spark, base, b, lambda cur, inc: M.upsert(cur, inc, ["k"]))
    assert v == 2 and SN.versions(spark, base) == [1, 2]
    assert _rows(SN.read_latest(spark, base), ["k", "v"]) == [("a", 2), ("b", 3)]
    # re-running a batch with the same version number rewrites it (idempotent)
    SN.merge_into(spark, base, b, lambda cur, inc: M.upsert(cur, inc, ["k"]), version=2)
    assert SN.versions(spark, base) == [1, 2]


def test_observed_merge_counts_in_one_pass(spark):
    prod = spark.createDataFrame([_res("r1", "m1", 10, 11)], RES)
    inc = spark.createDataFrame([_res("r1", "m1", 10, 12), _res("r3", "m3", 9, 10), _res("r3", "m3", 9, 10)],
                                RES).withColumn("_pos", F.monotonically_increasing_id())
    nxt, obs = M.merge_reservations_observed(prod, inc)
    nxt.write.format("noop").mode("overwrite").save()
    got = {k: o.get["rows"] for k, o in obs.items()}
    assert got == {"incoming": 3, "batch_dedupe": 2, "stage_dedupe": 2, "new_vs_production": 1}


def test_snapshot_replay_reads_prior_state(spark, tmp_path):
    from courtgrid.sources import snapshot as SN
    base = str(tmp_path / "t")
    a = spark.createDataFrame([("a", 1)], "k string, v int")
    SN.merge_into(spark, base, a, lambda cur, inc: cur.unionByName(inc), version=1)
    b = spark.createDataFrame([("b", 2)], "k string, v int")
    SN.merge_into(spark, base, b, lambda cur, inc: cur.unionByName(inc), version=2)
    SN.merge_into(spark, base, b, lambda cur, inc: cur.unionByName(inc), version=2)  # replay
    assert _rows(SN.read_latest(spark, base), ["k", "v"]) == [("a", 1), ("b", 2)]


def test_merge_partitions_touches_only_batch_partitions(spark, tmp_path):
    from courtgrid.sources import snapshot as SN
    base = str(tmp_path / "res")
    first = spark.createDataFrame([_res("r1", "m1", 10, 11), _res("r2", "m2", 10, 11)], RES) \
        .withColumn("client_code", F.when(F.col("reservation_id") == "r1", "t1").otherwise("t2"))
    SN.merge_partitions(spark, base, first, lambda cur, inc: M.upsert(cur, inc, M.RES_BATCH_KEY), ["client_code"])
    before_t2 = sorted(os.listdir(os.path.join(base, "client_code=t2")))
    inc = spark.createDataFrame([_res("r1", "m1", 14, 15)], RES).withColumn("client_code", F.lit("t1")) \
        .withColumn("_pos", F.lit(1))
    SN.merge_partitions(spark, base, inc, lambda cur, b: M.merge_reservations(cur, b), ["client_code"])
    assert sorted(os.listdir(os.path.join(base, "client_code=t2"))) == before_t2  # untouched
    got = _rows(spark.read.parquet(base), ["client_code", "reservation_id", "reservation_start_at"])
    assert got == [("t1", "r1", D + dt.timedelta(hours=14)), ("t2", "r2", D + dt.timedelta(hours=10))]
    plan = spark.read.parquet(base).join(inc.select("client_code").distinct(), ["client_code"], "left_semi") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() or "PartitionFilters" in plan


def test_whole_load_reads_its_inputs_few_times(spark):
    """The whole reservation load: no step doubles the work below it."""
    from courtgrid.plans.merge_queries import merge_bookings

    plan = merge_bookings(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("Relation [") <= 6
    assert 1 <= plan.count("Window [") <= 4


def test_null_keys_survive_in_one_pass(spark):
    rows = [("a", 1), (None, 2), (None, 2)]
    cur = spark.createDataFrame(rows, "k string, v int")
    inc = spark.createDataFrame([("a", 5), (None, 2), (None, 7)], "k string, v int")
    kept = M.delete_keys(cur, inc, ["k"])
    assert [r.v for r in kept.collect()] == [2, 2]
    assert sorted(r.v for r in M.anti_existing(inc, cur, ["k"], null_safe=False).collect()) == [2, 7]
    assert sorted((r.k or "", r.v) for r in M.upsert(cur, inc, ["k"]).collect()) == [
        ("", 2), ("", 2), ("", 2), ("", 7), ("a", 5)]
