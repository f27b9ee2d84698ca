"""Table sources (S7) and sinks.

Parquet is the storage format: column pruning and predicate pushdown reach
the scan because every reader here returns a plain ``spark.read.parquet``
DataFrame and lets Catalyst push projections and filters into it.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, spread_scan: bool = False) -> DataFrame:
    """One table of a data folder; timestamps become UTC instants.

    ``spread_scan`` deals the rows to all cores by a hash of the row, whatever
    the size: for fixtures that encode small one-split tables as JSON.

    The test tables store ``TIMESTAMP_NTZ``; under the UTC session a cast to
    ``TIMESTAMP`` keeps the wall clock and gives an instant, which the zone
    functions need.  The cast is a projection, so pushdown is unaffected.
    """
    df = spark.read.parquet(table_path(sf_dir, name))
    if spread_scan:
        df = df.repartition(spark.sparkContext.defaultParallelism, F.xxhash64(*[F.col(c) for c in df.columns]))
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampNTZType):
            cols.append(F.col(f.name).cast("timestamp").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register_views(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> None:
    """Register the data folder's tables as temp views (for SQL users)."""
    for name in names:
        if os.path.exists(table_path(sf_dir, name)):
            read_table(spark, sf_dir, name).createOrReplaceTempView(name)


def as_ntz(df: DataFrame) -> DataFrame:
    """Render instants as UTC wall-clock ``TIMESTAMP_NTZ`` for exchange with
    engines that have no zone-aware type."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_table(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite",
                sort_within=None) -> None:
    """Model sink.  ``sort_within`` orders rows inside each file (O1)
    instead of a global sort, which would need a range shuffle.  An overwrite
    replaces the whole table, also partitions that got no rows this time."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    writer = out.write.mode(mode).option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


TIMES = "spark.sql.parquet.outputTimestampType"


def write_clustered(df: DataFrame, path: str, by: Sequence[str], files: int, rows_per_file: int = 5_000_000,
                    mode: str = "overwrite") -> None:
    """S8 / O1 for a big table: rows dealt by ranges of ``by`` (say tenant, time)
    into ``files`` parts, and sorted in them, so that a filter on a prefix of ``by``
    finds its rows in few files and row groups by their least and greatest values.

    Rows equal in ``by`` go on to be dealt by a hash of the row: a tenant, or
    a tenant's instant, of any size is many parts.  Only rows equal in every
    column share one; no file holds more than ``rows_per_file``.  Nulls come
    first.  The ranges are fitted to a sample that Spark draws in a pass of its
    own, so ``df`` should be a written table.  Times are written as
    microseconds: the older parquet form of Spark keeps no least and greatest value.
    """
    spark = df.sparkSession
    tie = "_tie"
    while tie in df.columns:
        tie += "_"
    out = df.withColumn(tie, F.xxhash64(*[F.col(c) for c in df.columns])) \
        .repartitionByRange(files, *by, tie).sortWithinPartitions(*by, tie).drop(tie)
    before = spark.conf.get(TIMES)
    spark.conf.set(TIMES, "TIMESTAMP_MICROS")
    try:
        out.write.mode(mode).option("maxRecordsPerFile", int(rows_per_file)).parquet(path)
    finally:
        spark.conf.set(TIMES, before)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON dump of raw or normalised rows."""
    df.write.mode(mode).json(path)


def truncate(df: DataFrame) -> DataFrame:
    """An empty table of the same schema."""
    return df.limit(0)
