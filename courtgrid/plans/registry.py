"""Query registry shared by the catalogue modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import as_ntz

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` (and its DuckDB oracle SQL)."""
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: as_ntz(fn(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# SQL fragments shared by oracle queries (DuckDB dialect)
# ---------------------------------------------------------------------------
def _tl(x: str) -> str:
    """DuckDB form of the 'FMHH12 AM' / 'FMHH12:MI AM' label."""
    return f"(CASE WHEN minute({x}) = 0 THEN strftime({x}, '%-I %p') ELSE strftime({x}, '%-I:%M %p') END)"


def _pgts(x: str) -> str:
    """DuckDB form of PostgreSQL's timestamptz text (whole seconds and fractions)."""
    return (f"(strftime({x}, '%Y-%m-%d %H:%M:%S') || CASE WHEN microsecond({x}) % 1000000 = 0 THEN '' "
            f"ELSE '.' || rtrim(lpad(CAST(microsecond({x}) % 1000000 AS VARCHAR), 6, '0'), '0') END || '+00')")


def _skey(*parts: str) -> str:
    null = "'_dbt_utils_surrogate_key_null_'"
    return "md5(concat_ws('-', " + ", ".join(f"coalesce({p}, {null})" for p in parts) + "))"


def local_to_utc_sql(wall: str, tz: str) -> str:
    """DuckDB: wall clock in ``tz`` -> UTC, taking the earlier instant of an
    ambiguous (autumn) hour as Python's ``fold=0`` and Spark do."""
    c = f"timezone('UTC', timezone({tz}, {wall}))"
    return (f"(CASE WHEN timezone({tz}, timezone('UTC', {c} - INTERVAL 1 HOUR)) = {wall} "
            f"THEN {c} - INTERVAL 1 HOUR ELSE {c} END)")
