"""Catalogue: remaining load operators — cancellation load (M2), watermark
write (T2), update-from copy (J12) and null repair (M13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merge as M
from ..operators import watermark as T
from ..sources.tables import read_table
from . import merge_queries as MQ
from . import payload_queries as PQ
from .facility_queries import tenants_view
from .model_queries import NOW, RESOLVED_SQL
from .registry import register

LOAD_TIME = "2024-02-01 00:00:00"
CUT_PROD, CUT_BATCH = "1999-01-01", "1998-07-01"
CANCEL_COLS = ["client_code", "source_system", "event_id", "reservation_id", "member_id", "reservation_type",
               "reservation_created_at", "reservation_start_at", "reservation_end_at", "cancelled_on", "day_of_week",
               "is_program", "program_name", "player_name", "player_first_name", "player_last_name", "player_email",
               "player_phone", "fee", "is_team_event", "event_category_name", "event_category_id", "created_at"]


@register("merge_cancellations", f"""
WITH norm AS ({PQ.ORACLE_CANCEL_A}),
c AS (SELECT *, TIMESTAMP '{LOAD_TIME}' AS created_at, CAST(reservation_id AS BIGINT) AS _pos FROM norm),
cur AS (SELECT * FROM c WHERE reservation_start_at < TIMESTAMP '{CUT_PROD}'),
inc AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY client_code, event_id, reservation_start_at, cancelled_on, member_id
                               ORDER BY cancelled_on DESC NULLS LAST, created_at DESC, _pos) AS rn
  FROM c WHERE reservation_start_at >= TIMESTAMP '{CUT_BATCH}') WHERE rn = 1)
SELECT {", ".join(CANCEL_COLS)} FROM cur
UNION ALL
SELECT {", ".join(CANCEL_COLS)} FROM inc i WHERE NOT EXISTS (
  SELECT 1 FROM cur p WHERE i.client_code IS NOT DISTINCT FROM p.client_code AND i.event_id IS NOT DISTINCT FROM p.event_id
    AND i.reservation_start_at IS NOT DISTINCT FROM p.reservation_start_at
    AND i.cancelled_on IS NOT DISTINCT FROM p.cancelled_on AND i.member_id IS NOT DISTINCT FROM p.member_id)""")
def merge_cancellations(spark, sf_dir):
    """M2: W2 dedupe of the batch, null-safe anti join on the 5-key, append."""
    c = PQ.json_cancellations_a(spark, sf_dir).withColumn("created_at", F.lit(LOAD_TIME).cast("timestamp")) \
        .withColumn("_pos", F.col("reservation_id").cast("bigint"))
    cur = c.filter(F.col("reservation_start_at") < F.lit(CUT_PROD).cast("timestamp")).select(*CANCEL_COLS)
    inc = c.filter(F.col("reservation_start_at") >= F.lit(CUT_BATCH).cast("timestamp"))
    return M.merge_cancellations(cur, inc, pos="_pos")


@register("watermark_record", f"""
WITH {MQ.BOOKINGS_SQL.strip()},{MQ.PROD_SQL},{RESOLVED_SQL},
loaded AS (SELECT 'reservations__' || client_code AS source_name, max(reservation_created_at) AS last_record_created_at
           FROM batch GROUP BY client_code),
cur AS (SELECT source_name, last_loaded_at, CAST(NULL AS TIMESTAMP) AS last_record_created_at FROM wm)
SELECT source_name, last_loaded_at, last_record_created_at FROM cur
WHERE source_name NOT IN (SELECT source_name FROM loaded)
UNION ALL
SELECT source_name, TIMESTAMP '{NOW}', last_record_created_at FROM loaded""")
def watermark_record(spark, sf_dir):
    """After a load, every loaded source's watermark becomes the wall
    clock (not the newest record), with the newest record time kept aside."""
    b = MQ.bookings_view(spark, sf_dir)
    prod = MQ._production(b)
    wm = prod.groupBy(T.source_name("reservations", F.col("client_code")).alias("source_name")).agg(
        F.max("created_at").alias("last_loaded_at"), F.lit(None).cast("timestamp").alias("last_record_created_at"))
    loaded = MQ._batch(b).withColumn("source_name", T.source_name("reservations", F.col("client_code")))
    return T.record(wm, loaded, NOW, record_created="reservation_created_at")


@register("copy_place_ids", """
WITH t AS (SELECT lower(n_name) AS client_code, n_nationkey FROM nation),
src AS (SELECT 'nation_' || CAST(s_nationkey AS VARCHAR) AS client_code, 'place' || CAST(min(s_suppkey) AS VARCHAR) AS google_place_id
        FROM supplier GROUP BY s_nationkey)
SELECT t.client_code, coalesce(s.google_place_id, CASE WHEN t.n_nationkey % 3 = 0 THEN 'kept' || CAST(t.n_nationkey AS VARCHAR) END)
         AS google_place_id
FROM t LEFT JOIN src s ON t.client_code = s.client_code""")
def copy_place_ids(spark, sf_dir):
    """``UPDATE target SET col = source.col FROM source WHERE key = key``
    (one source row per key; targets without a source row keep their value)."""
    t = tenants_view(spark, sf_dir).select(
        "client_code", F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("kept"), F.col("n_nationkey").cast("string")))
        .alias("google_place_id"))
    s = read_table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.min("s_suppkey").alias("k")).select(
        F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("client_code"),
        F.concat(F.lit("place"), F.col("k").cast("string")).alias("google_place_id"))
    return M.copy_column(t, s, "client_code", "google_place_id")


@register("fill_event_start", """
SELECT event_id, coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('hour', ts) END, ts) AS event_start_time,
       ts AS created_at FROM events""")
def fill_event_start(spark, sf_dir):
    """``event_start_time = created_at`` where it is null."""
    e = read_table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.date_trunc("hour", "ts")).alias("event_start_time"),
        F.col("ts").alias("created_at"))
    return M.fill_start_from_created(e)
