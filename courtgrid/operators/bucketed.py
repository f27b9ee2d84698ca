"""Reservation loads into bucketed tables: the current side of a merge stays where it is.

``merge_reservations`` shuffles all of production at each load, by two keys.
Here production is two Spark tables written with ``bucketBy``, so that a load
shuffles its batch alone:

* ``<name>``: the rows, bucketed by ``bucket_key``, a hash of (lower-cased
  tenant, reservation) and of one of ``SALTS`` salts drawn from the member (of
  the row, where there is none).  An upsert meets its row in the row's bucket; a
  cancellation, which names a reservation only, is sent to each of its salts.  So a
  reservation with a third of all rows lies in ``SALTS`` buckets, and rows that
  can match nothing (no tenant or no reservation) are spread by a hash of the row.
* ``<name>_stages``: each stage key (null-safe J9 key) once with the number
  ``n_rows`` of rows that have it, bucketed by ``stage_key``, a hash of it.
  A load brings it up to date from the rows that come and go, not from the table.

Spark cannot overwrite a table that it reads: a load reads the tables of one
name and writes those of another; the caller names its versions.  A crashed
load is run again with the same names, which replaces what it left behind.
Buckets should be at least ``spark.sql.shuffle.partitions``, or Spark deals
small tables anew.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import merge as M

SALTS = 16
ROW_KEY, STAGE_KEY = "bucket_key", "stage_key"
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def joined_by_bucket(spark: SparkSession) -> Iterator[None]:
    """Plans made inside may join by (bucket key, exact keys) on tables bucketed by the first alone."""
    before = spark.conf.get(CO_PARTITION)
    spark.conf.set(CO_PARTITION, "false")
    try:
        yield
    finally:
        spark.conf.set(CO_PARTITION, before)


def _reservation_key(salt: Column) -> Column:
    return F.xxhash64(F.lower("client_code"), F.col("reservation_id"), salt)


def with_row_key(df: DataFrame) -> DataFrame:
    row = F.xxhash64(*[F.col(c) for c in df.columns])
    salt = F.pmod(F.when(F.col("member_id").isNotNull(), F.xxhash64("member_id")).otherwise(row), F.lit(SALTS))
    alone = F.col("client_code").isNull() | F.col("reservation_id").isNull()
    return df.withColumn(ROW_KEY, F.when(alone, row).otherwise(_reservation_key(salt)))


def stages(rows: DataFrame, n: Column | None = None) -> DataFrame:
    """Each stage key of ``rows`` with its hash and its number of rows (or the sum of ``n``)."""
    return rows.groupBy(F.xxhash64(*M.RES_STAGE_KEY).alias(STAGE_KEY), *M.RES_STAGE_KEY) \
        .agg(F.sum(F.lit(1).cast("long") if n is None else n).alias("n_rows"))


def write(df: DataFrame, name: str, folder: str, key: str, buckets: int) -> None:
    """``df`` as the bucketed table ``name`` with its files in a folder of that name."""
    df.write.mode("overwrite").option("path", os.path.join(folder, name)).bucketBy(buckets, key).saveAsTable(name)


def create(rows: DataFrame, name: str, folder: str, buckets: int) -> None:
    """The two tables of ``rows``, which hold each (tenant, reservation, member) without a null part
    once, as loads keep it: the one time that they are dealt by both keys."""
    keyed = with_row_key(rows)
    write(keyed.repartition(buckets, ROW_KEY), name, folder, ROW_KEY, buckets)
    counted = stages(rows.sparkSession.table(name))
    write(counted.repartition(buckets, STAGE_KEY), f"{name}_stages", folder, STAGE_KEY, buckets)


def rows(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).drop(ROW_KEY)


def buckets_of(spark: SparkSession, name: str) -> int:
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(F.col("col_name") == "Num Buckets").first()
    return int(told["data_type"])


def _same_stage(a: str, b: str) -> Column:
    on = F.col(f"{a}.{STAGE_KEY}") == F.col(f"{b}.{STAGE_KEY}")
    for c in M.RES_STAGE_KEY:
        on = on & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return on


def _doomed(cancelled: DataFrame) -> DataFrame:
    """(tenant in lower case, reservation) of the cancellations once, for each salt."""
    ids = cancelled.select(F.lower("client_code").alias("client_code"), "reservation_id").dropna().distinct()
    return ids.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))) \
        .select(_reservation_key(F.col("_salt").cast("long")).alias(ROW_KEY), "client_code", "reservation_id")


def _by_reservation(current: DataFrame, doomed: DataFrame, how: str) -> DataFrame:
    on = (F.col(f"c.{ROW_KEY}") == F.col(f"d.{ROW_KEY}")) & (F.lower("c.client_code") == F.col("d.client_code")) \
        & (F.col("c.reservation_id") == F.col("d.reservation_id"))
    return current.alias("c").join(doomed.alias("d"), on, how)


def plan_fresh(counted: DataFrame, gone: DataFrame, staged: DataFrame) -> DataFrame:
    """The staged rows whose stage key no row of the table has, ``gone`` (stage keys and counts of
    the rows that cancellations take out) taken off first."""
    left = counted.alias("s").join(gone.alias("g"), _same_stage("s", "g"), "left") \
        .filter(F.col("s.n_rows") > F.coalesce("g.n_rows", F.lit(0))).select("s.*")
    own = staged.withColumn(STAGE_KEY, F.xxhash64(*M.RES_STAGE_KEY))
    return own.alias("b").join(left.alias("s"), _same_stage("b", "s"), "left_anti").drop(STAGE_KEY)


def plan_rows(current: DataFrame, doomed: DataFrame, fresh: DataFrame) -> DataFrame:
    """The next rows: the current ones but for the cancelled, upserted with the fresh ones."""
    return M.upsert(_by_reservation(current, doomed, "left_anti"), fresh, [ROW_KEY, *M.RES_BATCH_KEY],
                    batch_unique=True)


def plan_stages(counted: DataFrame, change: DataFrame) -> DataFrame:
    """The next stage keys: ``change`` has what rows that came and went add to each count."""
    both = counted.alias("s").join(change.alias("d"), _same_stage("s", "d"), "full_outer")
    n = F.coalesce("s.n_rows", F.lit(0)) + F.coalesce("d.n_rows", F.lit(0))
    old = F.col(f"s.{STAGE_KEY}").isNotNull()
    return both.select(*[F.when(old, F.col(f"s.{c}")).otherwise(F.col(f"d.{c}")).alias(c)
                         for c in (STAGE_KEY, *M.RES_STAGE_KEY)], n.alias("n_rows")).filter("n_rows > 0")


def merge(spark: SparkSession, name: str, into: str, folder: str, batch: DataFrame, cancelled: DataFrame | None = None,
          pos: str = "_pos", columns: Sequence[str] | None = None) -> None:
    """M8 and M1 on bucketed tables: the rows of ``apply_cancellations`` and then
    ``merge_reservations``, from the tables ``name`` to the tables ``into``.

    ``cancelled`` has (client_code, reservation_id); ids with a null part
    match nothing.  What the load decides (the rows that go and those that
    come) is cut off with ``checkpoint()``: both are bounded by the batch, and
    each is read more than once.  An empty batch copies the tables.
    """
    ensure_checkpoint_dir(spark)
    n = buckets_of(spark, name)
    current, counted = spark.table(name), spark.table(f"{name}_stages")
    columns = list(columns or [c for c in current.columns if c != ROW_KEY])
    active = batch
    if cancelled is not None:
        active = M.delete_keys(batch, cancelled, ["client_code", "reservation_id"], fold_case=["client_code"])
    else:
        cancelled = batch.select("client_code", "reservation_id").limit(0)
    staged = M.dedupe_latest(active, M.RES_BATCH_KEY, "reservation_updated_at", pos)
    staged = M.stage_dedupe(staged, M.RES_STAGE_KEY, "reservation_updated_at", "created_at", tie=pos)
    with joined_by_bucket(spark):
        doomed = _doomed(cancelled).checkpoint()
        gone = stages(_by_reservation(current, doomed, "left_semi")).checkpoint()
        fresh = with_row_key(plan_fresh(counted, gone, staged.select(*columns, pos)).select(*columns)).checkpoint()
        write(plan_rows(current, doomed, fresh), into, folder, ROW_KEY, n)
        on = [F.col(f"c.{k}") == F.col(f"f.{k}") for k in (ROW_KEY, *M.RES_BATCH_KEY)]
        replaced = _by_reservation(current, doomed, "left_anti").alias("c") \
            .join(fresh.alias("f"), on, "left_semi")
        change = stages(fresh).unionByName(stages(replaced, F.lit(-1).cast("long"))) \
            .unionByName(gone.withColumn("n_rows", -F.col("n_rows")))
        write(plan_stages(counted, stages(change, F.col("n_rows"))), f"{into}_stages", folder, STAGE_KEY, n)
