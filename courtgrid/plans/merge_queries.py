"""Catalogue: first-per-group, anti joins and merges.

Derived inputs (same formula on both sides):

* ``bookings`` from ``orders`` — one reservation row per order: tenant =
  lower(order status), reservation = customer, event = priority, member =
  order key mod 3 (null for '5-LOW'), start = order date, created a few
  days earlier, updated a few days later (null for every fifth order),
  cancelled for urgent pending orders; position = order key.
* production = bookings placed before 1999 (deduplicated); the incoming
  batch = bookings from mid-1998 on, so the two overlap (late-data re-read).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bucketed as BU
from ..operators import merge as M
from ..sources.tables import read_table
from ..streaming.stream import job_dir
from .registry import ORACLE_SQL, register

PROD_BEFORE = "1999-01-01"
BATCH_FROM = "1998-07-01"

BOOKING_COLS = ["client_code", "reservation_id", "event_id", "member_id", "reservation_created_at",
                "reservation_updated_at", "reservation_start_at", "reservation_end_at",
                "reservation_cancelled_at", "created_at"]


def _days(n, ts):
    return F.timestamp_add("DAY", n if not isinstance(n, int) else F.lit(n), ts)


def bookings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    return o.select(
        F.lower("o_orderstatus").alias("client_code"),
        F.col("o_custkey").cast("string").alias("reservation_id"),
        F.col("o_orderpriority").alias("event_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", (k % 3).cast("string")).alias("member_id"),
        _days(-(k % 3), d).alias("reservation_created_at"),
        F.when(k % 5 != 0, _days(k % 7, d)).alias("reservation_updated_at"),
        d.alias("reservation_start_at"),
        (d + F.expr("INTERVAL 90 MINUTES")).alias("reservation_end_at"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P"), _days(1, d))
        .alias("reservation_cancelled_at"),
        _days(2, d).alias("created_at"),
        k.alias("_pos"),
    )


BOOKINGS_SQL = """
bookings AS (
  SELECT lower(o_orderstatus) AS client_code,
         CAST(o_custkey AS VARCHAR) AS reservation_id,
         o_orderpriority AS event_id,
         CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderkey % 3 AS VARCHAR) END AS member_id,
         o_orderdate - to_days(CAST(o_orderkey % 3 AS INTEGER)) AS reservation_created_at,
         CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + to_days(CAST(o_orderkey % 7 AS INTEGER)) END AS reservation_updated_at,
         o_orderdate AS reservation_start_at,
         o_orderdate + INTERVAL 90 MINUTE AS reservation_end_at,
         CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN o_orderdate + INTERVAL 1 DAY END AS reservation_cancelled_at,
         o_orderdate + INTERVAL 2 DAY AS created_at,
         o_orderkey AS _pos
  FROM orders
)"""

_BCOLS = ", ".join(BOOKING_COLS)
_LATEST_ORDER = ("reservation_updated_at DESC NULLS LAST, "
                 "CASE WHEN reservation_updated_at IS NULL THEN -_pos ELSE _pos END")


def _production(b: DataFrame) -> DataFrame:
    prod = b.filter(F.col("reservation_start_at") < F.lit(PROD_BEFORE).cast("timestamp"))
    return M.dedupe_latest(prod, M.RES_BATCH_KEY, "reservation_updated_at", "_pos").select(*BOOKING_COLS)


def _batch(b: DataFrame) -> DataFrame:
    return b.filter(F.col("reservation_start_at") >= F.lit(BATCH_FROM).cast("timestamp"))


PROD_SQL = f"""
production AS (
  SELECT {_BCOLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY client_code, reservation_id, member_id ORDER BY {_LATEST_ORDER}) AS rn
    FROM bookings WHERE reservation_start_at < TIMESTAMP '{PROD_BEFORE}') WHERE rn = 1
),
batch AS (SELECT * FROM bookings WHERE reservation_start_at >= TIMESTAMP '{BATCH_FROM}')"""


@register("dedupe_latest", f"""
WITH {BOOKINGS_SQL.strip()}
SELECT {_BCOLS}, _pos FROM (
  SELECT *, row_number() OVER (PARTITION BY client_code, reservation_id, member_id ORDER BY {_LATEST_ORDER}) AS rn
  FROM bookings) WHERE rn = 1""")
def dedupe_latest(spark, sf_dir):
    """W5 on all bookings."""
    return M.dedupe_latest(bookings_view(spark, sf_dir), M.RES_BATCH_KEY, "reservation_updated_at", "_pos")


@register("dedupe_stage", f"""
WITH {BOOKINGS_SQL.strip()}
SELECT {_BCOLS}, _pos FROM (
  SELECT *, row_number() OVER (PARTITION BY client_code, event_id, reservation_start_at, reservation_created_at, member_id
                               ORDER BY reservation_updated_at DESC NULLS LAST, created_at DESC, _pos) AS rn
  FROM bookings) WHERE rn = 1""")
def dedupe_stage(spark, sf_dir):
    """Stage dedupe on (tenant, event, start, created, member)."""
    return M.stage_dedupe(bookings_view(spark, sf_dir), M.RES_STAGE_KEY, "reservation_updated_at",
                          "created_at", tie="_pos")


@register("dedupe_first", """
SELECT client_code, member_id, membership_type_name, _pos FROM (
  SELECT CAST(o_custkey % 25 AS VARCHAR) AS client_code, CAST(o_custkey AS VARCHAR) AS member_id,
         o_orderpriority AS membership_type_name, o_orderkey AS _pos,
         row_number() OVER (PARTITION BY o_custkey % 25, o_custkey ORDER BY o_orderkey) AS rn
  FROM orders) WHERE rn = 1""")
def dedupe_first(spark, sf_dir):
    """Member rows from orders, first occurrence per (tenant, member)."""
    o = read_table(spark, sf_dir, "orders")
    m = o.select((F.col("o_custkey") % 25).cast("string").alias("client_code"),
                 F.col("o_custkey").cast("string").alias("member_id"),
                 F.col("o_orderpriority").alias("membership_type_name"),
                 F.col("o_orderkey").alias("_pos"))
    return M.dedupe_first(m, ["client_code", "member_id"], "_pos")


EVENTS_RAW_SQL = """
events_raw AS (
  SELECT 'tenant_' || CAST(user_id % 5 AS VARCHAR) AS client_code,
         CASE WHEN event_type IN ('click', 'view') THEN 'podplay' ELSE 'courtreserve' END AS source_system,
         CAST(user_id AS VARCHAR) AS event_id,
         date_trunc('hour', ts) AS event_start_time,
         event_type AS event_name, value AS admission_rate_regular, ts AS created_at,
         event_id AS _pos
  FROM events
)"""


def events_raw_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("tenant_"), (F.col("user_id") % 5).cast("string")).alias("client_code"),
        F.when(F.col("event_type").isin("click", "view"), "podplay").otherwise("courtreserve").alias("source_system"),
        F.col("user_id").cast("string").alias("event_id"),
        F.date_trunc("hour", "ts").alias("event_start_time"),
        F.col("event_type").alias("event_name"),
        F.col("value").alias("admission_rate_regular"),
        F.col("ts").alias("created_at"),
        F.col("event_id").alias("_pos"),
    )


EVENT_KEY = ["client_code", "source_system", "event_id", "event_start_time"]


@register("dedupe_last", f"""
WITH {EVENTS_RAW_SQL.strip()}
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY client_code, source_system, event_id, event_start_time ORDER BY _pos DESC) AS rn
  FROM events_raw) WHERE rn = 1""")
def dedupe_last(spark, sf_dir):
    """Events, last occurrence per (tenant, system, event, start)."""
    return M.dedupe_last(events_raw_view(spark, sf_dir), EVENT_KEY, "_pos")


@register("dedupe_max_id", """
SELECT l_suppkey, l_returnflag, review_id, l_quantity FROM (
  SELECT l_suppkey, l_returnflag, l_orderkey * 10 + l_linenumber AS review_id, l_quantity,
         row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_orderkey * 10 + l_linenumber DESC) AS rn
  FROM lineitem) WHERE rn = 1""")
def dedupe_max_id(spark, sf_dir):
    """Keep the highest id per key."""
    li = read_table(spark, sf_dir, "lineitem")
    r = li.select("l_suppkey", "l_returnflag",
                  (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("review_id"), "l_quantity")
    return M.dedupe_max_id(r, ["l_suppkey", "l_returnflag"], "review_id")


@register("anti_existing_null_safe", f"""
WITH {BOOKINGS_SQL.strip()},{PROD_SQL}
SELECT {_BCOLS}, _pos FROM batch b WHERE NOT EXISTS (
  SELECT 1 FROM production p
  WHERE b.client_code IS NOT DISTINCT FROM p.client_code AND b.event_id IS NOT DISTINCT FROM p.event_id
    AND b.reservation_start_at IS NOT DISTINCT FROM p.reservation_start_at
    AND b.reservation_created_at IS NOT DISTINCT FROM p.reservation_created_at
    AND b.member_id IS NOT DISTINCT FROM p.member_id)""")
def anti_existing_null_safe(spark, sf_dir):
    """Batch rows not already in production, nulls matching nulls."""
    b = bookings_view(spark, sf_dir)
    return M.anti_existing(_batch(b), _production(b), M.RES_STAGE_KEY, null_safe=True)


@register("delete_cancelled_orders", f"""
WITH {BOOKINGS_SQL.strip()},{PROD_SQL},
cancelled AS (SELECT DISTINCT lower(client_code) AS cc, reservation_id FROM batch WHERE reservation_cancelled_at IS NOT NULL)
SELECT {_BCOLS} FROM production p
WHERE NOT EXISTS (SELECT 1 FROM cancelled c WHERE c.cc = lower(p.client_code) AND c.reservation_id = p.reservation_id)""")
def delete_cancelled_orders(spark, sf_dir):
    """Remove cancelled (tenant, reservation) from production."""
    b = bookings_view(spark, sf_dir)
    _, cancelled = M.split_cancelled(_batch(b))
    prod, _ = M.apply_cancellations(_production(b), _batch(b), cancelled)
    return prod


@register("merge_bookings", f"""
WITH {BOOKINGS_SQL.strip()},{PROD_SQL},
cancelled AS (SELECT DISTINCT lower(client_code) AS cc, reservation_id FROM batch WHERE reservation_cancelled_at IS NOT NULL),
prod2 AS (SELECT * FROM production p WHERE NOT EXISTS (
  SELECT 1 FROM cancelled c WHERE c.cc = lower(p.client_code) AND c.reservation_id = p.reservation_id)),
active AS (SELECT * FROM batch b WHERE reservation_cancelled_at IS NULL AND NOT EXISTS (
  SELECT 1 FROM cancelled c WHERE c.cc = lower(b.client_code) AND c.reservation_id = b.reservation_id)),
w5 AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY client_code, reservation_id, member_id ORDER BY {_LATEST_ORDER}) AS rn
  FROM active) WHERE rn = 1),
w1 AS (SELECT * EXCLUDE (rn2) FROM (
  SELECT *, row_number() OVER (PARTITION BY client_code, event_id, reservation_start_at, reservation_created_at, member_id
                               ORDER BY reservation_updated_at DESC NULLS LAST, created_at DESC, _pos) AS rn2
  FROM w5) WHERE rn2 = 1),
fresh AS (SELECT * FROM w1 b WHERE NOT EXISTS (
  SELECT 1 FROM prod2 p
  WHERE b.client_code IS NOT DISTINCT FROM p.client_code AND b.event_id IS NOT DISTINCT FROM p.event_id
    AND b.reservation_start_at IS NOT DISTINCT FROM p.reservation_start_at
    AND b.reservation_created_at IS NOT DISTINCT FROM p.reservation_created_at
    AND b.member_id IS NOT DISTINCT FROM p.member_id))
SELECT {_BCOLS} FROM prod2 p WHERE NOT EXISTS (
  SELECT 1 FROM fresh f WHERE f.client_code = p.client_code AND f.reservation_id = p.reservation_id AND f.member_id = p.member_id)
UNION ALL
SELECT {_BCOLS} FROM fresh""")
def merge_bookings(spark, sf_dir):
    """M8 then M1: the whole system-A reservation load as one plan."""
    b = bookings_view(spark, sf_dir)
    batch = _batch(b)
    active, cancelled = M.split_cancelled(batch)
    prod, active = M.apply_cancellations(_production(b), active, cancelled)
    return M.merge_reservations(prod, active, pos="_pos")


@register("merge_bookings_bucketed", ORACLE_SQL["merge_bookings"])
def merge_bookings_bucketed(spark, sf_dir):
    """M8, M1, J9 on bucketed tables: ``merge_bookings`` without a shuffle of production."""
    b = bookings_view(spark, sf_dir)
    folder = job_dir(spark, "bucketed")
    name = "bookings_" + folder.rsplit("-", 1)[1]
    active, cancelled = M.split_cancelled(_batch(b))
    BU.create(_production(b), f"{name}_v1", folder, int(spark.conf.get("spark.sql.shuffle.partitions")))
    BU.merge(spark, f"{name}_v1", f"{name}_v2", folder, active, cancelled)
    return BU.rows(spark, f"{name}_v2")


MEMBERS_CUR_SQL = """
members_cur AS (
  SELECT CAST(c_custkey AS VARCHAR) AS member_id, c_name AS first_name, c_mktsegment AS membership_type_name,
         c_acctbal AS balance FROM customer
),
members_in AS (
  SELECT member_id, membership_type_name, balance FROM (
    SELECT CAST(o_custkey AS VARCHAR) AS member_id, o_orderpriority AS membership_type_name, o_totalprice AS balance,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
    FROM orders) WHERE rn = 1
)"""


def _members(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("member_id"), F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("membership_type_name"), F.col("c_acctbal").alias("balance"))
    o = read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("member_id"),
        F.col("o_orderpriority").alias("membership_type_name"),
        F.col("o_totalprice").alias("balance"), F.col("o_orderkey").alias("_pos"))
    return c, o


@register("upsert_customers", f"""
WITH {MEMBERS_CUR_SQL.strip()}
SELECT c.member_id, c.first_name,
       CASE WHEN i.member_id IS NOT NULL THEN i.membership_type_name ELSE c.membership_type_name END AS membership_type_name,
       CASE WHEN i.member_id IS NOT NULL THEN i.balance ELSE c.balance END AS balance
FROM members_cur c LEFT JOIN members_in i ON c.member_id = i.member_id
UNION ALL
SELECT i.member_id, NULL AS first_name, i.membership_type_name, i.balance
FROM members_in i WHERE NOT EXISTS (SELECT 1 FROM members_cur c WHERE c.member_id = i.member_id)""")
def upsert_customers(spark, sf_dir):
    """M3 (+ W7 batch dedupe): orders update the member's type and balance;
    the name is not in the batch and keeps its current value."""
    cur, inc = _members(spark, sf_dir)
    return M.upsert(cur, inc, ["member_id"], update_cols=["membership_type_name", "balance"], pos="_pos")


@register("insert_ignore_orders", """
WITH cur AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN 'old ' ELSE '' END || CAST(c_custkey AS VARCHAR) AS member_id,
                    c_name AS first_name, c_mktsegment AS membership_type_name FROM customer),
inc AS (SELECT member_id, first_name, membership_type_name FROM (
  SELECT CAST(o_custkey AS VARCHAR) AS member_id, 'order ' || CAST(o_orderkey AS VARCHAR) AS first_name,
         o_orderpriority AS membership_type_name,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1)
SELECT * FROM cur
UNION ALL
SELECT * FROM inc i WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE c.member_id = i.member_id)""")
def insert_ignore_orders(spark, sf_dir):
    """M4: insert-ignore of member rows derived from orders into a member
    table derived from customers, a fifth of whom have other ids there."""
    k = F.col("c_custkey")
    cur = read_table(spark, sf_dir, "customer").select(
        F.concat(F.when(k % 5 == 0, "old ").otherwise(""), k.cast("string")).alias("member_id"), F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("membership_type_name"))
    o = read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("member_id"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("first_name"),
        F.col("o_orderpriority").alias("membership_type_name"), F.col("o_orderkey").alias("_pos"))
    return M.insert_ignore(cur, o, ["member_id"], pos="_pos")


@register("replace_group_events", f"""
WITH {EVENTS_RAW_SQL.strip()},
cur AS (SELECT * FROM events_raw WHERE created_at < TIMESTAMP '2024-01-20' OR created_at IS NULL OR client_code = 'tenant_4'),
inc AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY client_code, source_system, event_id, event_start_time ORDER BY _pos DESC) AS rn
  FROM events_raw WHERE created_at >= TIMESTAMP '2024-01-15' AND client_code <> 'tenant_4') WHERE rn = 1)
SELECT * FROM cur c WHERE NOT EXISTS (
  SELECT 1 FROM inc i WHERE i.client_code = c.client_code AND i.source_system = c.source_system)
UNION ALL
SELECT * FROM inc""")
def replace_group_events(spark, sf_dir):
    """M5: a reload replaces each (tenant, system) it covers; others stay.  Every row is
    in the table or the reload, many in both; one tenant is not reloaded."""
    ev = events_raw_view(spark, sf_dir)
    alone, made = F.col("client_code") == "tenant_4", F.col("created_at")
    cur = ev.filter((made < F.lit("2024-01-20").cast("timestamp")) | made.isNull() | alone)
    inc = ev.filter((made >= F.lit("2024-01-15").cast("timestamp")) & ~alone)
    inc = M.dedupe_last(inc, EVENT_KEY, "_pos")
    return M.replace_groups(cur, inc, ["client_code", "source_system"])
