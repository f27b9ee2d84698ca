"""Watermarks, incremental windows and load windows.

The watermark table is a small DataFrame ``(source_name, last_loaded_at,
last_record_created_at)``; reading and writing it are DataFrame operations
(upsert on ``source_name``), so incremental selection is a join of the
batch with one row per source instead of a per-tenant loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import merge as M

DEFAULT_LOOKBACK_DAYS = 30
MEMBER_OVERLAP_MINUTES = 90

# Fixed source-name formats of the watermark table.
SOURCE_FORMATS = {
    "reservations": "reservations__{}",
    "reservation_cancellations": "reservation_cancellations__{}",
    "members": "members__{}",
    "events": "events__{}",
    "court_availability": "{}__court_availability",
}


def source_name(kind: str, tenant: Column) -> Column:
    """T2 key of a tenant's load."""
    fmt = SOURCE_FORMATS[kind]
    pre, post = fmt.split("{}")
    return F.concat(F.lit(pre), tenant, F.lit(post))


def _ts(x) -> Column:
    return F.lit(x).cast("timestamp") if isinstance(x, str) else x


def resolve(watermarks: DataFrame, sources: DataFrame, now, lookback_days: int = DEFAULT_LOOKBACK_DAYS) -> DataFrame:
    """Per source the last load time, else ``now - lookback``.

    ``sources``: one column ``source_name`` (the roster).  Naive stored
    times are UTC (the session zone).
    """
    last = watermarks.groupBy("source_name").agg(F.max("last_loaded_at").alias("last_loaded_at"))
    default = _ts(now) - F.make_dt_interval(F.lit(int(lookback_days)))
    return (sources.select("source_name").distinct().join(last, "source_name", "left")
            .select("source_name", F.coalesce("last_loaded_at", default).alias("watermark")))


def record(watermarks: DataFrame, loaded_sources: DataFrame, now, record_created: str | None = None) -> DataFrame:
    """Upsert ``last_loaded_at = now`` (wall clock, not the newest record)
    for every source that loaded; optional newest record time."""
    cols = [F.col("source_name"), _ts(now).alias("last_loaded_at")]
    if record_created:
        inc = loaded_sources.groupBy("source_name").agg(F.max(record_created).alias("last_record_created_at"))
        inc = inc.select("source_name", _ts(now).alias("last_loaded_at"), "last_record_created_at")
    else:
        inc = loaded_sources.select(*cols, F.lit(None).cast("timestamp").alias("last_record_created_at")).distinct()
    return M.upsert(watermarks, inc, ["source_name"], update_cols=["last_loaded_at", "last_record_created_at"])


def reset(watermarks: DataFrame, source: str, to) -> DataFrame:
    """Set one source's watermark back (the tables are truncated with
    ``sources.tables.truncate``)."""
    inc = watermarks.sparkSession.range(1).select(
        F.lit(source).alias("source_name"), _ts(to).alias("last_loaded_at"),
        F.lit(None).cast("timestamp").alias("last_record_created_at"))
    return M.upsert(watermarks, inc, ["source_name"], update_cols=["last_loaded_at"])


def incremental(batch: DataFrame, resolved: DataFrame, ts_col: str, source_col: Column,
                overlap: str = "none", until=None) -> DataFrame:
    """Rows of ``batch`` at or after the source's watermark,
    re-reading an overlap: ``'midnight'`` (back to the watermark's day) or a
    number of minutes (members: 90); ``until`` bounds the window (now).  Rows
    without a time are kept: they cannot be shown to be old."""
    wm = F.col("watermark")
    if overlap == "midnight":
        lo = F.date_trunc("day", wm)
    elif overlap == "none":
        lo = wm
    else:
        lo = wm - F.make_dt_interval(mins=F.lit(int(overlap)))
    b = batch.withColumn("_src", source_col)
    # One row per source on the right: salted so a big tenant is spread.
    j = M.salted_join(b, resolved.withColumnRenamed("source_name", "_src"), ["_src"], "inner")
    cond = F.col(ts_col) >= lo
    if until is not None:
        cond = cond & (F.col(ts_col) <= _ts(until))
    return j.filter(cond | F.col(ts_col).isNull()).drop("_src", "watermark")


def load_windows(resolved: DataFrame, now, days: int) -> DataFrame:
    """Cut ``[watermark, now]`` into ``days``-long windows, the last one
    clipped to ``now``."""
    step = F.make_dt_interval(F.lit(int(days)))
    n = _ts(now)
    w = resolved.filter(F.col("watermark") < n).select(
        "source_name", F.explode(F.sequence(F.col("watermark"), n, step)).alias("window_start"))
    return w.filter(F.col("window_start") < n).select(
        "source_name", "window_start", F.least(F.col("window_start") + step, n).alias("window_end"))


def assign_windows(records: DataFrame, resolved: DataFrame, ts_col: str, source_col: Column,
                   now, days: int) -> DataFrame:
    """S4 + range join: each record of a source gets the window(s) holding its
    time.  A time on a shared edge belongs to both neighbouring windows, as
    the reference fetches both — duplicates fall to the dedupe (M7).

    The window index is computed arithmetically, so this is an equi join on
    the source, not a range join.
    """
    step_us = int(days) * 86_400_000_000
    b = M.salted_join(records.withColumn("_src", source_col),
                      resolved.withColumnRenamed("source_name", "_src"), ["_src"], "inner")
    n = _ts(now)
    t = F.col(ts_col)
    inside = (t >= F.col("watermark")) & (t <= n)
    off = F.unix_micros(t) - F.unix_micros(F.col("watermark"))
    k = F.floor(off / F.lit(step_us)).cast("bigint")
    on_edge = (off % F.lit(step_us) == 0) & (k > 0)
    last_k = F.floor((F.unix_micros(n) - F.unix_micros(F.col("watermark")) - 1) / F.lit(step_us)).cast("bigint")
    ks = F.when(on_edge, F.array(k - 1, k)).otherwise(F.array(k))
    ks = F.filter(ks, lambda x: x <= last_k)
    out = b.filter(inside).withColumn("_k", F.explode(ks))
    start = F.timestamp_micros(F.unix_micros(F.col("watermark")) + F.col("_k") * F.lit(step_us))
    return out.withColumn("window_start", start).withColumn(
        "window_end", F.least(F.col("window_start") + F.make_dt_interval(F.lit(int(days))), n)
    ).drop("_src", "_k")
