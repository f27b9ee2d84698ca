"""Model builds over the tenant-days that a batch touches.

Raw tables and marts are parquet partitioned by (``client_code``, ``_day``).  A
batch brings whole tenant-days (a poll replaces a tenant's day) and names those
that it empties.  The days it touches go down the chain: each model says which
of its days they bear on, reads its input from the first to the last day that it
needs, and replaces only its own tenant-days (dynamic partition overwrite).  No
other file is written.  Each tenant-day is a file or more, so a table of many
small tenants has small files.

For many small tenants a table is made in ``groups``: partitioned by (``_group``,
``_day``), a group being the tenants of equal hash, so its files grow with its rows and
not with its tenants.  Still only the touched tenant-days are computed; the rows of
the other tenants of a group's day are written again with them.  All calls on a
table name the same ``groups``.

A folder without rows could not be replaced that way, so every folder that is
written gets one blank row, which :func:`read` leaves out: nothing is ever
deleted.  What is put lies beside the table first, until it is in: a put that died
after that is finished by the next, and a batch that died is run again; it writes
the same days.

Rows without a tenant (null or empty) or without a time lie on no day: they
are left out (``merge.split_missing_keys`` gives them on the landing side).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import daymask
from ..sources import snapshot as SN
from ..streaming.stream import job_dir
from . import models as P

PART = ["client_code", "_day"]
BLANK = "_blank"
FOLDERS = 32               # folders that a task writes, about: small files cost their opening
ROWS_PER_FILE = 1_000_000  # a folder of more rows is several files, of as many tasks


def on_days(df: DataFrame, time: str) -> DataFrame:
    """``df`` with the UTC day of ``time``; rows on no day are left out."""
    return df.withColumn("_day", F.to_date(time)).filter((F.col("client_code") != "") & F.col("_day").isNotNull())


def touched_days(batch: DataFrame, time: str, cleared: DataFrame | None = None) -> DataFrame:
    """The tenant-days of a batch and those it empties (``client_code``, ``day``), one row each,
    as a written table: its size is known, so it is broadcast only where it is small."""
    days = on_days(batch, time).select(*PART)
    if cleared is not None:
        days = days.unionByName(cleared.select("client_code", F.col("day").alias("_day"))
                                .filter((F.col("client_code") != "") & F.col("_day").isNotNull()))
    path = job_dir(batch.sparkSession, "touched-days")
    days.distinct().write.parquet(path)
    return batch.sparkSession.read.parquet(path)


def shifted(days: DataFrame, by: list[int]) -> DataFrame:
    """``days`` and their neighbours, ``by`` days away."""
    return days.select("client_code", F.explode(F.array(*[F.date_add("_day", n) for n in by])).alias("_day")).distinct()


def _part(groups: int) -> list[str]:
    """The columns of a table's folders."""
    return ["_group", "_day"] if groups else PART


def _in_folders(df: DataFrame, groups: int) -> DataFrame:
    """``df`` with its group, if the table has groups."""
    return df.withColumn("_group", F.pmod(F.xxhash64("client_code"), F.lit(groups)).cast("int")) if groups else df


def _finish(spark: SparkSession, path: str, part: list[str]) -> None:
    """Replace the folders of the table at ``path`` that rows lie ready for, if any do."""
    ready = SN.read_latest(spark, f"{path.rstrip('/')}-next")
    if ready is None:
        return
    sizes = ready.groupBy(*part).agg(F.count(F.lit(1)).alias("n"))
    files = F.ceil(F.col("n") / ROWS_PER_FILE)
    folders, rows = sizes.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not folders and SN.exists(spark, path):
        return
    big = F.broadcast(sizes.select(*part, files.alias("_files")).filter("_files > 1"))  # fewer than rows / ROWS_PER_FILE
    (ready.withColumn("_row", F.monotonically_increasing_id()).join(big, part, "left")
     .withColumn("_file", F.coalesce(F.pmod("_row", "_files"), F.lit(0))).drop("_row", "_files")
     .repartition(max(1, -(-folders // FOLDERS) + (rows or 0) // ROWS_PER_FILE), *part, "_file").drop("_file")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*part).parquet(path))
    SN.write_next(ready.limit(0), f"{path.rstrip('/')}-next", version=1)


def put(df: DataFrame, time: str, days: DataFrame, path: str, groups: int = 0) -> None:
    """Replace the tenant-days ``days`` of the table at ``path`` by the rows of ``df``
    on them; a big folder may be several files."""
    spark = df.sparkSession
    days, part = _in_folders(days, groups), _part(groups)
    _finish(spark, path, part)  # the put before, if it died
    out = _in_folders(on_days(df, time).join(days.select(*PART), PART, "left_semi"), groups)
    folders = days.select(*part).distinct()
    if groups and SN.exists(spark, path):
        there = _stored(spark, path, [f for f in df.schema.fields if f.name != "_day"], part)
        there = _span(there, days).join(folders, part, "left_semi").join(days.select(*PART), PART, "left_anti")
        out = out.unionByName(there.filter(~F.col(BLANK)).drop(BLANK))
    out = out.withColumn(BLANK, F.lit(False)).unionByName(folders.withColumn(BLANK, F.lit(True)), allowMissingColumns=True)
    SN.write_next(out, f"{path.rstrip('/')}-next", version=1)
    _finish(spark, path, part)


def _stored(spark: SparkSession, path: str, fields: list[T.StructField], part: list[str]) -> DataFrame:
    kinds = {"client_code": T.StringType(), "_group": T.IntegerType(), "_day": T.DateType()}
    own = [T.StructField(f.name, f.dataType) for f in fields if f.name not in part]
    return spark.read.schema(T.StructType([*own, T.StructField(BLANK, T.BooleanType()),
                                           *[T.StructField(c, kinds[c]) for c in part]])).parquet(path)


def _span(df: DataFrame, days: DataFrame) -> DataFrame:
    """``df`` from the first to the last of ``days``: a filter on folders."""
    first, last = days.agg(F.min("_day"), F.max("_day")).first()
    return df.filter(F.col("_day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def read(spark: SparkSession, path: str, schema: T.StructType, days: DataFrame | None = None, groups: int = 0) -> DataFrame:
    """The table at ``path`` (columns of ``schema``), or its tenant-days ``days`` alone.

    The scan takes the folders from the first to the last of the days, of every tenant
    (a batch is most often a few days of many tenants); the join leaves out the rest.
    """
    part = _part(groups)
    rows = _stored(spark, path, schema.fields, part)
    if days is not None:
        days = _in_folders(days, groups)
        on = list(dict.fromkeys([*part, *PART]))
        rows = _span(rows, days).join(_span(days, days), on, "left_semi")
    return rows.filter(~F.col(BLANK)).select(*schema.names)


def availability_batch(batch: DataFrame, raw: str, mart: str, as_of: str, horizon_days: int = 7,
                       cleared: DataFrame | None = None, groups: int = 0,
                       compose: Callable[..., DataFrame] = daymask.compose_slots) -> None:
    """Replace the tenant-days of a batch of openings in ``raw``, and what they bear on
    in the composed slots at ``mart`` (P12).

    A slot may reach from the last hour of a day into the next, so a touched
    day bears on itself and the day before, and a day is composed from itself and
    the day after.  All batches of a mart share ``as_of`` and the horizon;
    where these move, a new mart is built.
    """
    spark = batch.sparkSession
    days = touched_days(batch, "slot_start", cleared)
    put(batch, "slot_start", days, raw, groups)
    wanted = shifted(days, [-1, 0])
    openings = read(spark, raw, batch.schema, shifted(wanted, [0, 1]), groups)
    put(compose(openings, as_of, horizon_days), "slot_start", wanted, mart, groups)


def events_batch(batch: DataFrame, raw: str, mart: str, cleared: DataFrame | None = None, groups: int = 0) -> None:
    """Replace the tenant-days (by start) of a batch of events in ``raw`` and in the event
    mart (M12, P10), whose rows each come from one event."""
    spark = batch.sparkSession
    days = touched_days(batch, "event_start_time", cleared)
    put(batch, "event_start_time", days, raw, groups)
    events = read(spark, raw, batch.schema, days, groups)
    put(P.fct_events(P.classify_events(events)), "event_start_time", days, mart, groups)
