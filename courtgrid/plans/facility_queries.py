"""Catalogue: peak labelling (K1–K9) and availability by subtraction (V1–V5).

Derived inputs (same formula on both sides):

* ``tenants`` from ``nation``: client_code = lower(n_name), booking system
  by region parity, and one of five opening-hours / peak-hours JSON
  documents chosen by nation key (fixed test documents below).
* ``courts``: three courts per tenant ('Court #1'..'Court #3').
* slots from ``events``: tenant ``user_id % 25``, court ``user_id % 4``
  (court 3 has no court row), 30-minute floor of ``ts``.
* busy intervals from ``events``: start ``ts``, length ``round(value)``
  minutes; click/view/purchase are events, signup an active reservation,
  error a cancelled one.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import availability as V
from ..operators import islands
from ..operators import peak as K
from ..sources.tables import read_table
from .registry import register

# Fixed test documents (not reference values): peak hours by nation key % 5.
PEAK_DOCS = [
    {"timezone": "America/New_York", "weekday_peak": [{"start": "17:00", "end": "21:00"}],
     "weekend_peak": [{"start": "08:00", "end": "12:00"}],
     "weekday_off_peak": [{"start": "06:00", "end": "09:00"}]},
    {"timezone": "America/Chicago", "weekday_peak": [{"start": "22:00", "end": "02:00"}], "weekend_peak": []},
    {"weekday_peak": [], "weekend_peak": [{"start": "10:00", "end": "14:00"}]},
    None,
    {"timezone": "Europe/London",
     "weekday_peak": [{"start": "07:00", "end": "09:30"}, {"start": "18:00", "end": "20:00"}],
     "weekday_off_peak": [{"start": "12:00", "end": "14:00"}], "weekend_peak": None},
]


def _days(open_, close, only=None):
    names = only or V.WEEKDAYS
    return {d: {"open": open_, "close": close} for d in names}


# Fixed test documents: opening hours by nation key % 5.
HOURS_DOCS = [
    {"timezone": "America/New_York", **_days("07:00", "22:00")},
    {"timezone": "America/Los_Angeles", **_days("06:00", "02:00", V.WEEKDAYS[:5]),
     "saturday": {"open": "07:00", "close": "07:45"}},
    {"timezone": "America/Denver", **_days("09:30", "17:00")},
    None,
    {"timezone": "Europe/London", "monday": {"open": "07:00", "close": "22:00"},
     "tuesday": {"open": None, "close": "20:00"}, "friday": {"open": "18:00", "close": "23:30"}},
]
DATE_FROM, DATE_TO = "2024-01-01", "2024-01-30"


def _doc_sql(docs) -> str:
    parts = []
    for i, d in enumerate(docs):
        val = "NULL" if d is None else "'" + json.dumps(d).replace("'", "''") + "'"
        parts.append(f"WHEN {i} THEN {val}")
    return "CASE n_nationkey % 5 " + " ".join(parts) + " END"


def _doc_col(docs):
    expr = None
    for i, d in enumerate(docs):
        v = F.lit(None).cast("string") if d is None else F.lit(json.dumps(d))
        cond = (F.col("n_nationkey") % 5) == i
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr


def tenants_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    return n.select(
        F.lower("n_name").alias("client_code"),
        F.when(F.col("n_regionkey") % 2 == 0, "courtreserve").otherwise("podplay").alias("source_system_code"),
        _doc_col(PEAK_DOCS).alias("peak_hours"),
        _doc_col(HOURS_DOCS).alias("operating_hours"),
        "n_nationkey",
    )


def courts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tenants_view(spark, sf_dir)
    return t.select("client_code", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k")).select(
        F.col("k").cast("string").alias("court_id"), "client_code",
        F.concat(F.lit("Court #"), (F.col("k") + 1).cast("string")).alias("court_label"))


TENANTS_SQL = f"""
tenants AS (
  SELECT lower(n_name) AS client_code,
         CASE WHEN n_regionkey % 2 = 0 THEN 'courtreserve' ELSE 'podplay' END AS source_system_code,
         {_doc_sql(PEAK_DOCS)} AS peak_hours,
         {_doc_sql(HOURS_DOCS)} AS operating_hours
  FROM nation
),
courts AS (
  SELECT CAST(k AS VARCHAR) AS court_id, client_code, 'Court #' || CAST(k + 1 AS VARCHAR) AS court_label
  FROM tenants, range(0, 3) r(k)
)"""


def slots_view(spark, sf_dir) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    slot = F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 1800) * 1800)
    court = (F.col("user_id") % 4).cast("string")
    return ev.groupBy(
        F.concat(F.lit("nation_"), (F.col("user_id") % 25).cast("string")).alias("client_code"),
        F.lit("courtreserve").alias("source_system"),
        court.alias("court_id"),
        F.concat(F.lit("raw "), court).alias("court_name"),
        slot.alias("slot_start"),
        (slot + F.expr("INTERVAL 30 MINUTES")).alias("slot_end"),
        F.when(F.col("event_type") == "click", "PEAK").when(F.col("event_type") == "view", "OFF_PEAK")
        .alias("period_type"),
    ).agg(F.min("ts").alias("created_at"))


SLOTS_SQL = """
slots AS (
  SELECT 'nation_' || CAST(user_id % 25 AS VARCHAR) AS client_code, 'courtreserve' AS source_system,
         CAST(user_id % 4 AS VARCHAR) AS court_id, 'raw ' || CAST(user_id % 4 AS VARCHAR) AS court_name,
         time_bucket(INTERVAL 30 MINUTE, ts) AS slot_start, time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE AS slot_end,
         CASE event_type WHEN 'click' THEN 'PEAK' WHEN 'view' THEN 'OFF_PEAK' END AS period_type,
         min(ts) AS created_at
  FROM events GROUP BY ALL
)"""

_R = '[{"start":"VARCHAR","end":"VARCHAR"}]'
_PEAK_T = ('{"timezone":"VARCHAR","weekday_peak":' + _R + ',"weekend_peak":' + _R
           + ',"weekday_off_peak":' + _R + ',"weekend_off_peak":' + _R + '}')


def _sec(x):
    return f"(CAST(split_part({x}, ':', 1) AS INTEGER) * 3600 + CAST(split_part({x}, ':', 2) AS INTEGER) * 60)"


def _in(lst):
    s, e = _sec("struct_extract(r, 'start')"), _sec("struct_extract(r, 'end')")
    return (f"(len(list_filter({lst}, lambda r: ({s} <= {e} AND t >= {s} AND t < {e}) "
            f"OR ({s} > {e} AND (t >= {s} OR t < {e})))) > 0)")


def _nonempty(lst):
    return f"({lst} IS NOT NULL AND len({lst}) > 0)"


PEAK_SQL = f"""
WITH {TENANTS_SQL.strip()},{SLOTS_SQL},
parsed AS (
  SELECT client_code, json_transform(peak_hours, '{_PEAK_T}') AS pk,
         coalesce(json_extract_string(peak_hours, '$.timezone'), json_extract_string(operating_hours, '$.timezone'),
                  'America/New_York') AS tz
  FROM tenants
),
joined AS (
  SELECT s.*, c.court_label, p.pk, p.tz,
         dayofweek(s.slot_start) BETWEEN 1 AND 5 AS is_weekday,
         hour(timezone(p.tz, timezone('UTC', s.slot_start))) * 3600
           + minute(timezone(p.tz, timezone('UTC', s.slot_start))) * 60
           + second(timezone(p.tz, timezone('UTC', s.slot_start))) AS t
  FROM slots s
  LEFT JOIN courts c ON s.court_id = c.court_id AND s.client_code = c.client_code
  LEFT JOIN parsed p ON s.client_code = p.client_code
),
calc AS (
  SELECT *,
    CASE WHEN pk IS NULL THEN NULL
         WHEN is_weekday THEN
           CASE WHEN NOT {_nonempty('pk.weekday_peak')} THEN NULL
                WHEN {_in('pk.weekday_peak')} THEN 'peak'
                WHEN {_nonempty('pk.weekday_off_peak')} AND {_in('pk.weekday_off_peak')} THEN 'off_peak'
                ELSE 'peak' END
         ELSE CASE WHEN {_nonempty('pk.weekend_peak')} THEN 'peak' END
    END AS calculated
  FROM joined
)
SELECT md5(concat_ws('-', client_code, source_system, court_id,
           strftime(slot_start, '%Y-%m-%d %H:%M:%S') || '+00')) AS availability_pk,
       client_code, source_system, court_id, slot_start, slot_end,
       epoch(slot_end - slot_start) / 60 AS duration_minutes, created_at,
       coalesce(court_label, court_name) AS court_name,
       coalesce(calculated, period_type) AS period_type
FROM calc
WHERE slot_start >= TIMESTAMP '2024-01-01' AND slot_start <= TIMESTAMP '2024-01-01' + INTERVAL 30 DAY"""


@register("peak_label", PEAK_SQL)
def peak_label(spark, sf_dir):
    """Peak / off-peak label of every slot from its tenant's hour ranges."""
    return _labelled(spark, sf_dir)


@register("peak_bitmap", PEAK_SQL)
def peak_bitmap(spark, sf_dir):
    """P11 from minute bitmaps compiled once a tenant: the rows of ``peak_label``."""
    return _labelled(spark, sf_dir, bitmaps=True)


def _labelled(spark, sf_dir, bitmaps: bool = False) -> DataFrame:
    zones = S.known_zone_names(spark)
    t = tenants_view(spark, sf_dir).select("client_code", "peak_hours", "operating_hours")
    return K.label_periods(slots_view(spark, sf_dir), t, courts_view(spark, sf_dir), zones,
                           as_of="2024-01-01", horizon_days=30, bitmaps=bitmaps)


def busy_sources(spark, sf_dir):
    """Events and reservations as one frame (one scan): click/view/purchase
    rows are events (never cancelled), signup rows active reservations,
    error rows cancelled reservations."""
    ev = read_table(spark, sf_dir, "events")
    label = F.concat(F.lit("Court #"), (F.col("user_id") % 4 + 1).cast("string"))
    text = F.when(F.col("event_type") == "purchase", F.concat(F.lit("Court #1, "), label)).otherwise(label)
    return ev.select(
        F.concat(F.lit("nation_"), (F.col("user_id") % 25).cast("string")).alias("client_code"),
        S.parse_courts_text(text).alias("courts"),
        F.col("ts").alias("start"),
        F.timestamp_add("MINUTE", F.round("value").cast("bigint"), F.col("ts")).alias("end"),
        F.when(F.col("event_type") == "error", F.col("ts")).alias("cancelled"),
    )


GRID_CTES = f"""
days AS (
  SELECT c.client_code, c.court_id, c.court_label,
         coalesce(json_extract_string(t.operating_hours, '$.timezone'), 'America/New_York') AS tz,
         json_extract_string(t.operating_hours, '$.' || lower(dayname(d)) || '.open') AS o,
         json_extract_string(t.operating_hours, '$.' || lower(dayname(d)) || '.close') AS cl,
         CAST(d AS TIMESTAMP) AS d
  FROM courts c JOIN tenants t ON c.client_code = t.client_code,
       generate_series(TIMESTAMP '{DATE_FROM}', TIMESTAMP '{DATE_TO}', INTERVAL 1 DAY) g(d)
  WHERE t.operating_hours IS NOT NULL
),
bounds AS (
  SELECT client_code, court_id, court_label,
         timezone('UTC', timezone(tz, d + to_seconds({_sec('o')}))) AS op,
         timezone('UTC', timezone(tz, d + to_seconds({_sec('cl')})
             + CASE WHEN CAST(split_part(cl, ':', 1) AS INTEGER) < CAST(split_part(o, ':', 1) AS INTEGER)
                    THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END)) AS cl
  FROM days WHERE o IS NOT NULL AND cl IS NOT NULL
),
grid AS (
  SELECT client_code, court_id, court_label, s AS slot_start, s + INTERVAL 30 MINUTE AS slot_end
  FROM bounds, unnest(generate_series(op, cl - INTERVAL 30 MINUTE, INTERVAL 30 MINUTE)) u(s)
  WHERE cl - INTERVAL 30 MINUTE >= op
)"""

FREE_SQL = f"""
WITH {TENANTS_SQL.strip()},
{GRID_CTES},
ev AS (
  SELECT 'nation_' || CAST(user_id % 25 AS VARCHAR) AS client_code,
         CASE WHEN event_type = 'purchase' THEN 'Court #1, ' ELSE '' END || 'Court #' || CAST(user_id % 4 + 1 AS VARCHAR) AS courts,
         ts AS bstart, ts + to_minutes(CAST(round(value) AS BIGINT)) AS bend, event_type
  FROM events
),
busy AS (
  SELECT client_code, trim(lbl) AS court_label, bstart, bend
  FROM ev, unnest(string_split(courts, ',')) u(lbl)
  WHERE event_type <> 'error' AND trim(lbl) <> ''
)
SELECT g.client_code, 'courtreserve' AS source_system, g.court_id, g.court_label AS court_name,
       g.slot_start, g.slot_end, CAST(NULL AS VARCHAR) AS period_type
FROM grid g
WHERE NOT EXISTS (SELECT 1 FROM busy b WHERE b.client_code = g.client_code AND b.court_label = g.court_label
                  AND g.slot_start < b.bend AND g.slot_end > b.bstart)"""


@register("free_slots", FREE_SQL)
def free_slots(spark, sf_dir):
    """V1–V5: opening grid of every court minus busy intervals."""
    zones = S.known_zone_names(spark)
    t = tenants_view(spark, sf_dir).select("client_code", "operating_hours")
    return V.free_slots(courts_view(spark, sf_dir), t, None, busy_sources(spark, sf_dir), DATE_FROM, DATE_TO, zones)


@register("free_slots_islands", FREE_SQL)
def free_slots_islands(spark, sf_dir):
    """V1–V5 from busy islands: the rows of ``free_slots``, joined by court-day instead of by slot."""
    zones = S.known_zone_names(spark)
    t = tenants_view(spark, sf_dir).select("client_code", "operating_hours")
    return islands.free_slots(courts_view(spark, sf_dir), t, None, busy_sources(spark, sf_dir), DATE_FROM, DATE_TO, zones)


@register("opening_grid", f"""
WITH {TENANTS_SQL.strip()},
{GRID_CTES}
SELECT client_code, court_id, court_label, slot_start, slot_end FROM grid""")
def opening_grid(spark, sf_dir):
    """V1–V3: the opening grid alone (every tenant, court and date)."""
    zones = S.known_zone_names(spark)
    t = tenants_view(spark, sf_dir).select("client_code", "operating_hours")
    return V.opening_grid(courts_view(spark, sf_dir), t, DATE_FROM, DATE_TO, zones)
