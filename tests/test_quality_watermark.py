"""Quality checks (D1–D3, A5–A7) and watermarks / windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from courtgrid.operators import merge as M
from courtgrid.operators import quality as Q
from courtgrid.operators import watermark as T


def test_run_checks(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1, "a"), (1, None), (3, "c"), (None, "d")], "pid int, name string")
    out = Q.run_checks([
        Q.TableChecks("parent", parent, unique=["id"]),
        Q.TableChecks("child", child, unique=["pid"], not_null=["name"], relationships=[("pid", "parent", "id")]),
    ])
    got = {(r.table_name, r.column_name, r.check_name): r.failing_rows for r in out.collect()}
    assert got == {("parent", "id", "unique"): 0, ("child", "pid", "unique"): 1, ("child", "name", "not_null"): 1,
                   ("child", "pid", "relationships:parent.id"): 1}


def test_duplicate_report_keeps_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    rep = Q.duplicate_report(df, ["k"]).collect()
    assert sorted((r.k, r.v, r.n_rows) for r in rep) == [("a", 1, 2), ("a", 2, 2)]
    assert [tuple(r) for r in Q.duplicate_keys(df, ["k"]).collect()] == [("a", 2)]


def test_audit_counts(spark):
    a = spark.range(5)
    out = {r.step: r.rows for r in M.audit_counts({"in": a, "kept": a.filter("id > 2")}).collect()}
    assert out == {"in": 5, "kept": 2}


def test_watermark_resolve_and_record(spark):
    wm = spark.createDataFrame([("reservations__a", dt.datetime(2025, 1, 10), None)],
                               "source_name string, last_loaded_at timestamp, last_record_created_at timestamp")
    roster = spark.createDataFrame([("reservations__a",), ("reservations__b",)], "source_name string")
    got = {r.source_name: r.watermark for r in T.resolve(wm, roster, "2025-02-01").collect()}
    assert got == {"reservations__a": dt.datetime(2025, 1, 10), "reservations__b": dt.datetime(2025, 1, 2)}
    nxt = T.record(wm, roster, "2025-02-01")
    assert {r.source_name: r.last_loaded_at for r in nxt.collect()} == {
        "reservations__a": dt.datetime(2025, 2, 1), "reservations__b": dt.datetime(2025, 2, 1)}
    reset = T.reset(nxt, "reservations__a", "2024-12-01")
    assert {r.source_name: r.last_loaded_at for r in reset.collect()}["reservations__a"] == dt.datetime(2024, 12, 1)


def test_windows_share_edges(spark):
    res = spark.createDataFrame([("s", dt.datetime(2025, 1, 1))], "source_name string, watermark timestamp")
    wins = T.load_windows(res, "2025-01-20", 7).orderBy("window_start").collect()
    assert [(w.window_start.day, w.window_end.day) for w in wins] == [(1, 8), (8, 15), (15, 20)]
    recs = spark.createDataFrame([("s", dt.datetime(2025, 1, 8)), ("s", dt.datetime(2025, 1, 3)),
                                  ("s", dt.datetime(2025, 1, 20)), ("s", dt.datetime(2025, 1, 21))],
                                 "src string, t timestamp")
    got = T.assign_windows(recs, res, "t", F.col("src"), "2025-01-20", 7).collect()
    assert sorted((r.t.day, r.window_start.day) for r in got) == [(3, 1), (8, 1), (8, 8), (20, 15)]


def test_incremental_overlap(spark):
    res = spark.createDataFrame([("s", dt.datetime(2025, 1, 10, 15))], "source_name string, watermark timestamp")
    recs = spark.createDataFrame([("s", dt.datetime(2025, 1, 10, 1)), ("s", dt.datetime(2025, 1, 9, 23)),
                                  ("s", dt.datetime(2025, 1, 10, 14))], "src string, t timestamp")
    mid = T.incremental(recs, res, "t", F.col("src"), overlap="midnight")
    assert mid.count() == 2
    ninety = T.incremental(recs, res, "t", F.col("src"), overlap=90)
    assert [r.t.hour for r in ninety.collect()] == [14]


def test_sample_and_truncate(spark):
    from courtgrid.sources import payloads as PL
    from courtgrid.sources import tables as TB
    df = spark.range(100)
    assert [r.id for r in PL.sample(df, 3, ["id"]).collect()] == [0, 1, 2]
    assert TB.truncate(df).count() == 0 and TB.truncate(df).columns == ["id"]


def test_pushdown_and_pruning(spark):
    from courtgrid.operators import merge as M
    from courtgrid.plans import merge_queries as MQ
    from courtgrid.sources.tables import read_table
    cur, _ = MQ._members(spark, "/root/testdata/sf0.001")
    inc = read_table(spark, "/root/testdata/sf0.001", "orders").filter("o_orderstatus = 'O'").select(
        F.col("o_custkey").cast("string").alias("member_id"), F.col("o_orderpriority").alias("membership_type_name"),
        F.col("o_totalprice").alias("balance"), F.col("o_orderkey").alias("_pos"))
    df = M.upsert(cur, inc, ["member_id"], update_cols=["membership_type_name", "balance"], pos="_pos")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,O)]" in plan
    # o_orderdate (between o_totalprice and o_orderpriority) is pruned from the scan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double," \
           "o_orderpriorit" in plan


def test_duplicate_report_requires_start(spark):
    df = spark.createDataFrame([("e", None), ("e", None), ("f", dt.datetime(2025, 1, 1)), ("f", dt.datetime(2025, 1, 1))],
                               "k string, t timestamp")
    rep = Q.duplicate_report(df, ["k", "t"], require=["t"]).collect()
    assert sorted(r.k for r in rep) == ["f", "f"]
