"""Bucketed reservation loads: the pure merges' rows, exact stage counts, no shuffle of the current side."""

from __future__ import annotations

import random
import re
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from courtgrid.operators import bucketed as BU
from courtgrid.operators import merge as M

COLS = ("client_code STRING, reservation_id STRING, event_id STRING, member_id STRING, reservation_created_at TIMESTAMP, "
        "reservation_updated_at TIMESTAMP, reservation_start_at TIMESTAMP, created_at TIMESTAMP")
DAY = datetime(2025, 1, 1)


def _rows(rng, n, first_pos):
    def day():
        return DAY + timedelta(days=rng.randrange(3))
    return [(rng.choice(["a", "A", "b", None]), rng.choice(["hot", "hot", "hot", *"123456", None]), rng.choice(["e", None]),
             rng.choice(["m", "n", "o", None]), rng.choice([day(), None]), rng.choice([day(), None]), day(),
             DAY + timedelta(days=first_pos), first_pos + i) for i in range(n)]


def _names():
    run = uuid.uuid4().hex[:8]
    return [f"t_{run}_v{i}" for i in range(4)]


def _as_set(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_loads_equal_the_pure_merges(spark, tmp_path, seed):
    rng, names = random.Random(seed), _names()
    frames = [spark.createDataFrame(_rows(rng, 60, 1000 * k), COLS + ", _pos BIGINT") for k in range(4)]
    want = M.dedupe_latest(frames[0], M.RES_BATCH_KEY, "reservation_updated_at", "_pos").drop("_pos")
    BU.create(want, names[0], str(tmp_path), 8)
    for k, batch in enumerate(frames[1:], 1):
        cancelled = spark.createDataFrame([("B", str(k)), ("a", str(k + 1)), (None, "1"), ("a", None)],
                                          "client_code STRING, reservation_id STRING")
        prod, active = M.apply_cancellations(want, batch, cancelled)
        want = spark.createDataFrame(M.merge_reservations(prod, active).collect(), COLS)
        BU.merge(spark, names[k - 1], names[k], str(tmp_path), batch, cancelled)
        assert _as_set(BU.rows(spark, names[k])) == _as_set(want)
        counted = spark.table(f"{names[k]}_stages")
        assert _as_set(counted) == _as_set(BU.stages(want).select(*counted.columns))


def test_empty_batch_and_empty_table(spark, tmp_path):
    names = _names()
    rows = spark.createDataFrame(_rows(random.Random(3), 20, 0), COLS + ", _pos BIGINT")
    none = rows.limit(0)
    BU.create(none.drop("_pos"), names[0], str(tmp_path), 8)
    BU.merge(spark, names[0], names[1], str(tmp_path), none)
    assert BU.rows(spark, names[1]).count() == 0
    BU.merge(spark, names[1], names[2], str(tmp_path), rows)
    want = M.merge_reservations(none.drop("_pos"), rows)
    assert _as_set(BU.rows(spark, names[2])) == _as_set(want)
    BU.merge(spark, names[2], names[3], str(tmp_path), none)
    assert _as_set(BU.rows(spark, names[3])) == _as_set(want)


def _above(plan: str, scanned: str) -> list[str]:
    """The nodes above the scan of a table, the nearest first."""
    lines = [(re.search(r"[A-Za-z*]", line).start(), line) for line in plan.splitlines() if re.search(r"[A-Za-z]", line)]
    at = next(i for i, (_, line) in enumerate(lines) if "Scan" in line and f"{scanned}[" in line)
    depth, out = lines[at][0], []
    for d, line in reversed(lines[:at]):
        if d < depth:
            out.append(line.strip())
            depth = d
    return out


def test_the_current_side_is_not_shuffled(spark, tmp_path):
    name = _names()[0]
    rows = spark.createDataFrame(_rows(random.Random(4), 200, 0), COLS + ", _pos BIGINT")
    BU.create(M.dedupe_latest(rows, M.RES_BATCH_KEY, "reservation_updated_at", "_pos").drop("_pos"), name, str(tmp_path), 8)
    current, counted = spark.table(name), spark.table(f"{name}_stages")
    doomed = BU._doomed(rows.select("client_code", "reservation_id"))
    staged = M.stage_dedupe(rows, M.RES_STAGE_KEY, "reservation_updated_at", "created_at", tie="_pos")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with BU.joined_by_bucket(spark):
            gone = BU.stages(BU._by_reservation(current, doomed, "left_semi"))
            fresh = BU.plan_fresh(counted, BU.stages(rows), staged)
            keyed = BU.with_row_key(fresh.drop("_pos"))
            plans = [(BU.plan_rows(current, doomed, BU.with_row_key(staged.drop("_pos"))), name),
                     (fresh, f"{name}_stages"), (BU.plan_stages(counted, BU.stages(keyed)), f"{name}_stages")]
            for df, scanned in plans:
                above = _above(df._jdf.queryExecution().executedPlan().toString(), scanned)
                assert any("SortMergeJoin" in x for x in above)
                assert not any("Exchange" in x for x in above), above
            # what a load takes out is shuffled after the join: rows of the batch's reservations alone
            above = _above(gone._jdf.queryExecution().executedPlan().toString(), name)
            joined = next(i for i, x in enumerate(above) if "SortMergeJoin" in x)
            assert not any("Exchange" in x for x in above[:joined])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hot_reservation_is_spread(spark):
    rows = spark.range(20_000).select(
        F.lit("a").alias("client_code"), F.lit("hot").alias("reservation_id"), F.lit(None).cast("string").alias("event_id"),
        F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("member_id"), F.col("id").alias("n"))
    sizes = [r["count"] for r in BU.with_row_key(rows).groupBy(BU.ROW_KEY).count().collect()]
    assert len(sizes) == BU.SALTS and max(sizes) < 2 * 20_000 / BU.SALTS
