"""Query catalogue on the driver's tables.

Every query reads the driver's tables (or views Spark derives from them) in
full and returns a DataFrame whose columns are aliased exactly like the
DuckDB oracle SQL next to it.  ``QUERIES`` maps a name to
``(spark, sf_dir) -> DataFrame``; ``ORACLE_SQL`` maps the same name to SQL
over the pre-registered views.  A query without oracle SQL is checked on
row counts only (and against brute force in ``tests/``).

Derived inputs (same formula on both sides):

* ``avail`` from ``events``: one 30-minute opening per distinct
  (tenant, system, court, slot, period).  32 users make a tenant, so the
  number of tenants grows with the data; every tenant is on both booking
  systems with four courts each, whose names differ by system (Q8); slot =
  30-minute floor of ``ts``, period 'PEAK' for click/view, else null.
* ``bookings`` from ``orders``; ``tenants`` from ``nation``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import daymask
from ..operators import slots as L
from ..sources.tables import read_table
from ..streaming.stream import job_dir
from . import incremental
from .registry import ORACLE_SQL, QUERIES, _pgts, _skey, _tl, register  # noqa: F401

# The catalogue's composition window covers the whole event month.
AS_OF = "2024-01-01"
HORIZON_DAYS = 30


AVAIL_SQL = """
avail AS (
  SELECT DISTINCT
    'tenant_' || CAST(user_id // 32 AS VARCHAR) AS client_code,
    CASE WHEN user_id // 4 % 2 = 0 THEN 'courtreserve' ELSE 'podplay' END AS source_system,
    CAST(user_id % 4 AS VARCHAR) AS court_id,
    CASE WHEN user_id % 4 = 3 THEN NULL
         WHEN user_id // 4 % 2 = 0 THEN 'Court #' || CAST(user_id % 4 + 1 AS VARCHAR)
         ELSE 'Bay ' || CAST(user_id % 4 + 1 AS VARCHAR) END AS court_name,
    time_bucket(INTERVAL 30 MINUTE, ts) AS slot_start,
    time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE AS slot_end,
    CASE WHEN event_type IN ('click', 'view') THEN 'PEAK' END AS period_type
  FROM events
)"""


def avail_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``facility_court_availabilities`` stand-in derived from ``events``."""
    ev = read_table(spark, sf_dir, "events")
    first_system = F.expr("user_id div 4") % 2 == 0
    court = F.col("user_id") % 4
    slot = F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 1800) * 1800)
    return ev.select(
        F.concat(F.lit("tenant_"), F.expr("user_id div 32").cast("string")).alias("client_code"),
        F.when(first_system, "courtreserve").otherwise("podplay").alias("source_system"),
        court.cast("string").alias("court_id"),
        F.when(court != 3, F.concat(F.when(first_system, "Court #").otherwise("Bay "), (court + 1).cast("string")))
        .alias("court_name"),
        slot.alias("slot_start"),
        (slot + F.expr("INTERVAL 30 MINUTES")).alias("slot_end"),
        F.when(F.col("event_type").isin("click", "view"), "PEAK").alias("period_type"),
    ).distinct()


# ---------------------------------------------------------------------------
# Slot composition
# ---------------------------------------------------------------------------
# The expected rows come from one grouped pass over the court-hours instead of
# the operator's window flags and joins: ``mask`` holds which halves of a
# court-hour are open (1 first, 2 second), and ``span`` which hours of a
# two-hour window a court is open for (1 first, 2 second).
SLOT_BASE_SQL = f"""
WITH {AVAIL_SQL.strip()},
court_hour AS (
  SELECT client_code, source_system, coalesce(period_type, 'NULL') AS period_type, court_id,
         min(coalesce(court_name, 'Court ' || court_id)) AS label, date_trunc('hour', slot_start) AS hr,
         bit_or(CASE WHEN minute(slot_start) < 30 THEN 1 ELSE 2 END) AS mask
  FROM avail
  WHERE slot_start BETWEEN TIMESTAMP '{AS_OF}' AND TIMESTAMP '{AS_OF}' + INTERVAL {HORIZON_DAYS} DAY
  GROUP BY ALL
),
one_hour AS (
  SELECT client_code, source_system, period_type, hr AS slot_start, hr + INTERVAL 1 HOUR AS slot_end,
         count(*) AS available_courts_count, string_agg(DISTINCT label, ', ' ORDER BY label) AS available_courts
  FROM court_hour WHERE mask = 3 GROUP BY ALL
),
span AS (
  SELECT client_code, source_system, period_type, court_id, label, hr - INTERVAL (back) HOUR AS win,
         bit_or(back + 1) AS span
  FROM court_hour, (VALUES (0), (1)) AS b(back)
  WHERE mask = 3 GROUP BY ALL
),
span_text AS (
  SELECT *, label || CASE span
    WHEN 1 THEN ' (' || {_tl('win')} || '-' || {_tl('(win + INTERVAL 1 HOUR)')} || ')'
    WHEN 2 THEN ' (' || {_tl('(win + INTERVAL 1 HOUR)')} || '-' || {_tl('(win + INTERVAL 2 HOUR)')} || ')'
    ELSE '' END AS shown
  FROM span
),
two_hour AS (
  SELECT client_code, source_system, period_type, win AS slot_start, win + INTERVAL 2 HOUR AS slot_end,
         least(count(*) FILTER (span <> 2), count(*) FILTER (span <> 1)) AS available_courts_count,
         CASE WHEN count(DISTINCT span) FILTER (span <> 3) = 2 THEN string_agg(shown, ', ' ORDER BY shown)
              ELSE string_agg(shown, ', ' ORDER BY shown) FILTER (span = 3) END AS available_courts
  FROM span_text GROUP BY ALL
  HAVING bit_or(span) = 3 AND available_courts IS NOT NULL
),
lone AS (
  SELECT client_code, source_system, period_type, hr,
         list(label || ' (' || {_tl('hr')} || '-' || {_tl('(hr + INTERVAL 30 MINUTE)')} || ')') FILTER (mask = 1) AS early,
         list(label || ' (' || {_tl('(hr + INTERVAL 30 MINUTE)')} || '-' || {_tl('(hr + INTERVAL 1 HOUR)')} || ')')
           FILTER (mask = 2) AS late
  FROM court_hour GROUP BY ALL
),
cross_court AS (
  SELECT client_code, source_system, period_type, hr AS slot_start, hr + INTERVAL 1 HOUR AS slot_end,
         1 AS available_courts_count, e.t || ', ' || l.t AS available_courts
  FROM lone, unnest(early) AS e(t), unnest(late) AS l(t)
),
orphan AS (
  SELECT client_code, source_system, period_type, hr + INTERVAL (30 * (mask - 1)) MINUTE AS slot_start,
         hr + INTERVAL (30 * mask) MINUTE AS slot_end,
         count(*) AS available_courts_count, string_agg(DISTINCT label, ', ' ORDER BY label) AS available_courts
  FROM court_hour WHERE mask < 3 GROUP BY ALL
)"""


def _slot_sql(cte: str) -> str:
    return (SLOT_BASE_SQL + f"""
SELECT client_code, source_system, slot_start, slot_end, CAST(available_courts_count AS BIGINT) AS available_courts_count,
       available_courts, CASE WHEN period_type = 'NULL' THEN NULL ELSE period_type END AS period_type
FROM {cte}""")


SLOTS_ALL_SQL = SLOT_BASE_SQL + f""",
every_kind AS (
  SELECT *, 'hour' AS slot_type FROM one_hour
  UNION ALL BY NAME SELECT *, 'orphan' AS slot_type FROM orphan
  UNION ALL BY NAME SELECT *, 'two_hour' AS slot_type FROM two_hour
  UNION ALL BY NAME SELECT *, 'cross_court_hour' AS slot_type FROM cross_court
)
SELECT {_skey('client_code', _pgts('slot_start'), _pgts('slot_end'), 'slot_type')} AS availability_pk,
       {_skey('client_code', 'source_system', _pgts('slot_start'), _pgts('slot_end'), 'slot_type', 'period_type', 'available_courts')} AS slot_pk,
       client_code, source_system, slot_start, slot_end,
       CAST(available_courts_count AS BIGINT) AS available_courts_count, available_courts,
       CAST(round(epoch(slot_end - slot_start) / 60) AS BIGINT) AS duration_minutes,
       CASE epoch(slot_end - slot_start) / 60
         WHEN 30 THEN '30 minutes' WHEN 60 THEN '1 hour' WHEN 90 THEN '1.5 hours'
         WHEN 120 THEN '2 hours' WHEN 150 THEN '2.5 hours' WHEN 180 THEN '3 hours'
         ELSE CAST(CAST(round(epoch(slot_end - slot_start) / 60) AS BIGINT) AS VARCHAR) || ' minutes' END AS duration_display,
       CASE WHEN period_type = 'NULL' THEN NULL ELSE period_type END AS period_type,
       slot_type
FROM every_kind"""


SLOT_MATERIALIZE = "checkpoint"
GROUPS = 16  # of tenants, in the incremental tables


def _slot_plan(spark, sf_dir) -> L.SlotPlan:
    return L.SlotPlan(avail_view(spark, sf_dir), AS_OF, HORIZON_DAYS, materialize=SLOT_MATERIALIZE)


def _unsentinel(df: DataFrame) -> DataFrame:
    return df.withColumn("period_type", F.when(F.col("period_type") != "NULL", F.col("period_type")))


@register("slots_hour", _slot_sql("one_hour"))
def slots_hour(spark, sf_dir):
    return _unsentinel(_slot_plan(spark, sf_dir).hour())


@register("slots_two_hour", _slot_sql("two_hour"))
def slots_two_hour(spark, sf_dir):
    return _unsentinel(_slot_plan(spark, sf_dir).two_hour())


@register("slots_cross_court", _slot_sql("cross_court"))
def slots_cross_court(spark, sf_dir):
    return _unsentinel(_slot_plan(spark, sf_dir).cross_court())


@register("slots_orphan", _slot_sql("orphan"))
def slots_orphan(spark, sf_dir):
    return _unsentinel(_slot_plan(spark, sf_dir).orphan())


@register("slots_all", SLOTS_ALL_SQL)
def slots_all(spark, sf_dir):
    return _slot_plan(spark, sf_dir).all()


@register("slots_bitmask", SLOTS_ALL_SQL)
def slots_bitmask(spark, sf_dir):
    """L1–L14 from day masks: the rows of ``slots_all`` without self joins or checkpoints."""
    return daymask.compose_slots(avail_view(spark, sf_dir), AS_OF, HORIZON_DAYS)


@register("models_incremental", SLOTS_ALL_SQL)
def models_incremental(spark, sf_dir):
    """P12 over three batches, each building the tenant-days it touches: stale openings and a
    tenant that goes; the true openings of even days; those of odd days, the tenant emptied.
    The tenants are many and small: tables in groups."""
    avail, base = avail_view(spark, sf_dir), job_dir(spark, "models")
    raw, mart = os.path.join(base, "raw"), os.path.join(base, "fe")
    even = F.dayofmonth("slot_start") % 2 == 0
    gone = avail.filter(even).withColumn("client_code", F.lit("gone"))
    stale = avail.withColumn("court_id", F.lit("old")).unionByName(gone)
    emptied = gone.select("client_code", F.to_date("slot_start").alias("day"))
    for batch, cleared in ((stale, None), (avail.filter(even), None), (avail.filter(~even), emptied)):
        incremental.availability_batch(batch, raw, mart, AS_OF, HORIZON_DAYS, cleared, GROUPS)
    return incremental.read(spark, mart, daymask.compose_slots(avail, AS_OF, HORIZON_DAYS).schema, groups=GROUPS)
