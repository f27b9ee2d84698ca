"""What the load and stream queries hold on disk: large steps are tables made in parts, whose shuffle files go with them."""

from __future__ import annotations

import datetime as dt
import gzip
import json
import time

import pytest
from pyspark.sql import functions as F

from courtgrid.plans import load_job_queries as Q
from courtgrid.plans import loads as LO
from courtgrid.plans import streaming_queries as SQ
from courtgrid.sources import scratch as SC
from courtgrid.sources import snapshot as SN

from .test_load_once import EVENT, RESERVATION

T = dt.datetime(1994, 5, 1, 10)
EVENTS = [(f"t{i % 3}" if i % 9 else None, "podplay" if i % 11 else None, f"e{i % 17}" if i % 13 else None, f"n{i}", None, "t",
           T + dt.timedelta(hours=i % 2) if i % 7 else None, T, i, None, 1.0, None) for i in range(60)]


def _shuffle_files(spark) -> int:
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    return env.blockManager().diskBlockManager().getAllFiles().mkString(" ").count("/shuffle_")


def _settles(spark, most: int) -> bool:
    """Are there ``most`` shuffle files or fewer, at once or soon (they are removed in the background)?"""
    until = time.time() + 10
    while _shuffle_files(spark) > most and time.time() < until:
        time.sleep(0.1)
    return _shuffle_files(spark) <= most


def _sorted(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_written_table_drops_its_shuffle_files(spark):
    before = _shuffle_files(spark)
    table = SC.stored(spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count(), "test")
    assert _settles(spark, before)
    assert table.count() == 7
    assert spark.conf.get(SC.DROP_SHUFFLES, None) in (None, "false")  # only that write's


def test_parts_hold_every_row_once(spark, monkeypatch, tmp_path):
    rows = spark.createDataFrame([(f"k{i % 5}" if i % 4 else None, i) for i in range(40)], "k string, v int")
    told = []

    def step(part):
        told.append(part)
        return part.groupBy("k").agg(F.sum("v").alias("s"), F.count("*").alias("n"))
    whole = _sorted(step(rows))
    monkeypatch.setattr(SC, "ROWS_A_PART", 9)
    assert _sorted(SC.stored_parts(step, [rows], ["k"], str(tmp_path / "t"))) == whole
    assert len(told) == 1 + 5


@pytest.mark.parametrize("query, source", [("load_events_a", "json_events_a"), ("load_events_b", "json_events_b")])
def test_events_are_replaced_without_a_shuffle_of_the_table(spark, monkeypatch, query, source):
    made = spark.createDataFrame(EVENTS, EVENT)
    monkeypatch.setattr(Q.PQ, source, lambda spark, sf_dir: made)
    whole = getattr(Q, query)(spark, "")
    assert "Window" not in _plan(whole)  # the batch's last rows are a table
    monkeypatch.setattr(SC, "ROWS_A_PART", 20)
    before = _shuffle_files(spark)
    parts = getattr(Q, query)(spark, "")
    assert _settles(spark, before)
    assert _sorted(parts) == _sorted(whole)
    rows = [r for r in EVENTS if r[6] is not None]
    keyed = {r[:3] + (r[6],) for r in rows if None not in r[:3]}
    assert whole.filter("event_name = 'second'").count() == len(keyed)


def test_groups_are_measured_before_the_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        rows = SC.stored(spark.range(50_000).select(
            F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("client_code"), F.lit("s").alias("source_system"),
            F.xxhash64("id").cast("string").alias("event_id"), F.lit(T).alias("event_start_time"), F.col("id").alias("_pos")), "test-rows")
        cur = rows.drop("_pos").withColumn("client_code", F.concat(F.lit("u"), "client_code"))
        out = LO.LOADS["events_a"].merge(cur, rows, None)
        assert "BroadcastHashJoin" in _plan(out) and "SortMergeJoin" not in _plan(out)
        assert out.count() == 100_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


RESERVATIONS = [(f"t{i % 3}" if i % 9 else None, f"r{i % 6}" if i % 8 else None, f"e{i % 4}", f"m{i % 3}" if i % 5 else None, T,
                 T + dt.timedelta(days=200 * (i % 4)) if i % 7 else None, T + dt.timedelta(hours=i % 2), T, None) for i in range(80)]


def test_reservations_are_merged_in_parts(spark, monkeypatch):
    made = spark.createDataFrame(RESERVATIONS, RESERVATION)
    monkeypatch.setattr(Q.PQ, "json_participants", lambda spark, sf_dir: made)
    whole = Q.load_reservations_b(spark, "")
    assert "Join" not in _plan(whole) and "Exchange" not in _plan(whole)
    monkeypatch.setattr(SC, "ROWS_A_PART", 10)
    before = _shuffle_files(spark)
    parts = Q.load_reservations_b(spark, "")
    assert _settles(spark, before)
    assert _sorted(parts) == _sorted(whole)
    # as the merge in one piece, from the same rows
    rows = made.withColumn("_pos", F.struct(*Q.RES_COLS))
    old = F.coalesce(F.col("reservation_updated_at") < Q._at(Q._RES_CUT), F.lit(False))
    cur = Q.M.dedupe_latest(rows.filter(old), Q.M.RES_BATCH_KEY, "reservation_updated_at", "_pos").drop("_pos")
    one = Q.M.merge_reservations(cur.withColumn("created_at", Q._at(Q.OLD)), rows.filter(~old).withColumn("created_at", Q._at(Q.NOW)))
    assert _sorted(parts) == _sorted(one) and one.count() > 20


def _payload(i: int) -> str:
    day = f"2024-01-{1 + i % 5:02d}T10:00:00"
    return json.dumps({"Id": 10 * (i % 25), "ReservationTypeId": i % 2, "ReservationTypeName": "Court Reservation", "StartTime": day,
                       "EndTime": day, "CreatedOnUtc": day, "UpdatedOnUtc": None if i % 4 == 0 else f"2024-01-0{1 + i % 9}T09:00:00",
                       "Players": [{"OrganizationMemberId": i % 6}, {"OrganizationMemberId": None}]})


def test_stream_lands_packed_and_merges_in_parts(spark, monkeypatch, tmp_path):
    made = spark.createDataFrame([(f"T{i % 3}", _payload(i)) for i in range(60)], "client_code string, payload string").repartition(3)
    monkeypatch.setattr(SQ.PQ, "_a_res_payload", lambda spark, sf_dir: made)
    monkeypatch.setattr(SQ, "LANDED_ROWS", 4)
    out = []
    for name, rows in (("whole", SC.ROWS_A_PART), ("parts", 40)):
        monkeypatch.setattr(SC, "ROWS_A_PART", rows)
        monkeypatch.setattr(SQ.ST, "job_dir", lambda spark, job, name=name: str(tmp_path / name / job))
        out.append(_sorted(SQ.stream_reservations_merge(spark, "")))
        landed = sorted((tmp_path / name / "reservations" / "landing").glob("part-*"))
        assert landed and all(f.name.endswith(".json.gz") for f in landed)
        assert max(len(gzip.decompress(f.read_bytes()).splitlines()) for f in landed) <= 4
    assert out[0] == out[1] and len(out[0]) > 30


def test_partition_merge_computes_its_batch_once_and_leaves_no_tables(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(SC, "ROWS_A_PART", 3)
    monkeypatch.setattr(SN, "job_dir", lambda spark, name: str(tmp_path / name / str(time.time_ns())))
    seen = spark.sparkContext.accumulator(0)

    def count(row):
        seen.add(1)
        return row

    def merge(cur, inc):
        return inc.unionByName(cur.join(inc, ["client_code", "k"], "left_anti"))
    base, schema = str(tmp_path / "table"), "client_code string, k int, v int"
    for n, rows in enumerate(([(t, k, 1) for t in ("a", "01", "c/d") for k in range(4)], [("a", 1, 2), ("01", 9, 2)])):
        batch = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(count), schema)
        now = SN.merge_partitions(spark, base, batch, merge, ["client_code"])
        assert sorted(map(tuple, now.collect())) == sorted(
            [(t, k, 1) for t in ("a", "01", "c/d") for k in range(4)] if n == 0 else
            [("a", 0, 1), ("a", 1, 2), ("a", 2, 1), ("a", 3, 1), ("01", 9, 2), *[("01", k, 1) for k in range(4)]])
    assert seen.value == 12 + 2
    assert spark.read.schema(schema).parquet(base).count() == 13
    assert not [p for n in ("merge-batch", "merge-next") for p in (tmp_path / n).iterdir()]
