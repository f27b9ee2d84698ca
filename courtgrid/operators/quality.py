"""Data-quality checks and load statistics.

``run_checks`` evaluates the schema tests of the models (unique, not_null,
relationships) with one scan per table and one aggregate over all of them,
and returns a single DataFrame ``(table_name, column_name, check_name,
failing_rows)`` — never a driver-side loop over rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class TableChecks:
    """Checks of one table: ``unique`` and ``not_null`` column lists and
    ``relationships`` as (column, parent table name, parent column)."""
    name: str
    df: DataFrame
    unique: Sequence[str] = field(default_factory=list)
    not_null: Sequence[str] = field(default_factory=list)
    relationships: Sequence[tuple[str, str, str]] = field(default_factory=list)


def run_checks(specs: Sequence[TableChecks]) -> DataFrame:
    """D1–D3 over several tables as one DataFrame
    ``(table_name, column_name, check_name, failing_rows)``.

    ``unique`` counts values (not null) that occur more than once, ``not_null``
    and ``relationships`` count rows.  Every table is scanned once: a row emits
    one (check, value) record per check it can bear on, all records are counted
    in one aggregate by (check, value) — map-side first, so a value holding
    much of a table is one record per task — and the checks are sums over that.
    """
    checks: list[tuple[int, str, str, str, str]] = []
    emits: dict[str, list] = {s.name: [] for s in specs}

    def emit(check, column, parent=False, nulls=False):
        col = F.col(column)
        return F.struct(F.lit(check).alias("check"), col.cast("string").alias("value"),
                        F.lit(0 if parent else 1).cast("bigint").alias("n"), F.lit(parent).alias("parent"),
                        (col.isNull() if nulls else col.isNotNull()).alias("use"))

    for s in specs:
        wanted = [("not_null", c, None, None) for c in s.not_null] + [("unique", c, None, None) for c in s.unique] \
            + [("relationships", c, p, pc) for c, p, pc in s.relationships]
        for kind, c, parent, pc in wanted:
            i = len(checks)
            checks.append((i, s.name, c, f"relationships:{parent}.{pc}" if parent else kind, kind))
            emits[s.name].append(emit(i, c, nulls=kind == "not_null"))
            if parent:
                emits[parent].append(emit(i, pc, parent=True))
    records = None
    for s in specs:
        if emits[s.name]:
            r = s.df.select(F.inline(F.array(*emits[s.name]))).filter("use").drop("use")
            records = r if records is None else records.unionByName(r)
    spark = specs[0].df.sparkSession
    names = spark.createDataFrame(checks, "check int, table_name string, column_name string, check_name string, kind string")
    if records is None:
        return names.select("table_name", "column_name", "check_name", F.lit(0).cast("bigint").alias("failing_rows"))
    values = records.groupBy("check", "value").agg(F.sum("n").alias("n"), F.max("parent").alias("parent"))
    sums = values.groupBy("check").agg(
        F.sum("n").alias("rows"), F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).alias("repeated"),
        F.sum(F.when(~F.col("parent"), F.col("n")).otherwise(0)).alias("orphans"))
    failing = F.when(F.col("kind") == "unique", F.col("repeated")).when(F.col("kind") == "not_null", F.col("rows")) \
        .otherwise(F.col("orphans"))
    return names.join(sums, "check", "left").select(
        "table_name", "column_name", "check_name", F.coalesce(failing, F.lit(0)).cast("bigint").alias("failing_rows"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], limit: int | None = 10) -> DataFrame:
    """A5: keys occurring more than once with their count; ``limit`` is the
    report size (most frequent first, ties by key)."""
    d = df.groupBy(*keys).count().filter("count > 1").withColumnRenamed("count", "n_rows")
    if limit:
        d = d.orderBy(F.col("n_rows").desc(), *[F.col(k).asc_nulls_first() for k in keys]).limit(int(limit))
    return d


JOIN_SALTS = 32


def duplicate_report(df: DataFrame, keys: Sequence[str], require: Sequence[str] = (),
                     salts: int = JOIN_SALTS) -> DataFrame:
    """Every row whose key is duplicated, with the key's row count;
    rows missing a ``require`` column are not inspected (the event report
    only looks at events with a start time).

    The reference attaches the rows to their key as a list; here they stay
    rows (a join back on the duplicated keys), so a key repeated millions of
    times never has to fit in one record.

    The join back is salted: a duplicated key may hold a large share of all
    rows, and AQE cannot split a join whose other side is an aggregate of
    the same key.  Each row gets a salt from a hash of the whole row, and the
    (small) table of duplicated keys is replicated once per salt, so a hot
    key's rows are spread over ``salts`` tasks.
    """
    for c in require:
        df = df.filter(F.col(c).isNotNull())
    d = df.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("n_rows")) \
        .filter("n_rows > 1").withColumn("_to", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # null-safe: rows with equal null key parts are duplicates too
    match = F.col("_salt") == F.col("_to")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    rows = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts)))
    return rows.join(d, match).select(*df.columns, "n_rows")


def min_max(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Earliest / latest value (per group)."""
    aggs = [F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}"),
            F.count(F.lit(1)).alias("rows")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
