"""Catalogue: the load jobs' merge rules, rejects, rosters, seeds and the
declared model checks.

Each load query deals all rows of a normaliser's query to a current state and
a batch that repeats rows, and merges them by the rule of ``plans.loads``.  As in the
jobs, the normalised rows are a written table, so payloads are parsed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import merge as M
from ..operators import roster as R
from ..operators import watermark as T
from ..sources import payloads as PL
from ..sources import places as PLC
from ..sources.scratch import job_dir, stored, stored_parts
from ..sources.tables import read_table
from . import checks as CK
from . import loads as LO
from . import model_queries as MO
from . import models as P
from . import payload_queries as PQ
from .facility_queries import peak_label
from .load_queries import CANCEL_COLS
from .registry import ORACLE_SQL, register

OLD, NOW = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
MEMBER_COLS = ["client_code", "member_id", "first_name", "last_name", "gender", "phone_number", "date_of_birth",
               "email", "membership_type_name", "is_premium_member", "member_since"]
EVENT_COLS = ["client_code", "source_system", "event_id", "event_name", "event_description", "event_type",
              "event_start_time", "event_end_time", "num_registrants", "max_registrants", "admission_rate_regular",
              "admission_rate_member"]
SESSION_COLS = ["client_code", "source_system", "court_id", "court_name", "slot_start", "slot_end", "period_type"]
RES_COLS = ["client_code", "reservation_id", "event_id", "member_id", "reservation_created_at",
            "reservation_updated_at", "reservation_start_at", "reservation_end_at", "reservation_cancelled_at"]


def _at(text):
    return F.lit(text).cast("timestamp")


def _batch(rows: DataFrame, cols, change: str) -> DataFrame:
    """The rows, then all of them once more with column ``change`` rewritten;
    ``_pos`` = (time in the batch, all columns), a whole order."""
    first = rows.select(*cols, F.struct(F.lit(0).alias("n"), *cols).alias("_pos"))
    again = rows.select(*[F.lit("second").alias(c) if c == change else F.col(c) for c in cols],
                        F.struct(F.lit(1).alias("n"), *cols).alias("_pos"))
    return first.unionByName(again)


def _up(cols):
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


def _down(cols):
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


# ---------------------------------------------------------------------------
# Members (M3, M7): current, batch or both by the last character of the id
# ---------------------------------------------------------------------------
def _members_sql(source: str) -> str:
    m, same = ", ".join(MEMBER_COLS), [c for c in MEMBER_COLS if c != "first_name"]
    pick = f"QUALIFY row_number() OVER (PARTITION BY client_code, member_id ORDER BY {_up(MEMBER_COLS)}) = 1"
    return f"""
WITH r AS (SELECT {m}, coalesce(right(member_id, 1), '') AS d FROM ({ORACLE_SQL[source]})
           WHERE client_code IS NOT NULL AND member_id IS NOT NULL),
cur AS (SELECT * FROM r WHERE d NOT IN ('3', '4') {pick}),
inc AS (SELECT * FROM r WHERE d NOT IN ('0', '1', '2') {pick})
SELECT {m}, TIMESTAMP '{NOW}' AS created_at FROM inc
UNION ALL BY NAME
SELECT {", ".join(same)}, 'old ' || first_name AS first_name, TIMESTAMP '{OLD}' AS created_at FROM cur c
WHERE NOT EXISTS (SELECT 1 FROM inc i WHERE i.client_code = c.client_code AND i.member_id = c.member_id)"""


def _load_members(rows: DataFrame, name: str) -> DataFrame:
    load = LO.LOADS[name]
    rows, _ = LO.keyed(load, stored(rows.select(*MEMBER_COLS), f"load-{name}"))
    d = F.coalesce(F.right("member_id", F.lit(1)), F.lit(""))
    whole = F.struct(*MEMBER_COLS)
    cur = M.dedupe_first(rows.filter(~d.isin("3", "4")).withColumn("_pos", whole), LO.MEMBER_KEY, "_pos").select(
        *[F.concat(F.lit("old "), F.col(c)).alias(c) if c == "first_name" else F.col(c) for c in MEMBER_COLS],
        _at(OLD).alias("created_at"))
    inc = _batch(rows.filter(~d.isin("0", "1", "2")), MEMBER_COLS, "last_name").withColumn("created_at", _at(NOW))
    return load.merge(cur, inc, None)


@register("load_members_a", _members_sql("json_members_a"))
def load_members_a(spark, sf_dir):
    """M3 + M7: members of system A; a repeated member's first row stays."""
    return _load_members(PQ.json_members_a(spark, sf_dir), "members_a")


@register("load_members_b", _members_sql("json_members_b"))
def load_members_b(spark, sf_dir):
    """M3 + M7: members of system B; a repeated member's first row stays."""
    return _load_members(PQ.json_members_b(spark, sf_dir), "members_b")


# ---------------------------------------------------------------------------
# Events (W6, M5)
# ---------------------------------------------------------------------------
def _events_sql(source: str) -> str:
    e, same = ", ".join(EVENT_COLS), [c for c in EVENT_COLS if c not in ("client_code", "event_id")]
    return f"""
WITH r AS (SELECT {e} FROM ({ORACLE_SQL[source]}) WHERE event_start_time IS NOT NULL),
last AS (SELECT * FROM r QUALIFY row_number() OVER (
  PARTITION BY client_code, source_system, event_id, event_start_time ORDER BY {_down(EVENT_COLS)}) = 1)
SELECT * REPLACE ('second' AS event_name), TIMESTAMP '{NOW}' AS created_at FROM last
UNION ALL BY NAME
SELECT 'other_' || client_code AS client_code, 'gone-' || event_id AS event_id, {", ".join(same)},
       TIMESTAMP '{OLD}' AS created_at FROM r"""


def _load_events(rows: DataFrame, name: str) -> DataFrame:
    load = LO.LOADS[name]
    rows, _ = LO.keyed(load, stored(rows.select(*EVENT_COLS), f"load-{name}"))
    stale = rows.withColumn("event_id", F.concat(F.lit("gone-"), "event_id")).withColumn("created_at", _at(OLD))
    cur = stale.withColumn("client_code", F.explode(F.array("client_code", F.concat(F.lit("other_"), "client_code"))))
    inc = _batch(rows, EVENT_COLS, "event_name").withColumn("created_at", _at(NOW))

    def last(batch, keys, pos):
        return stored_parts(lambda part: M.dedupe_last(part, keys, pos), [batch], keys, job_dir(batch.sparkSession, f"last-{name}"))
    return load.merge(cur, inc, None, last)


@register("load_events_a", _events_sql("json_events_a"))
def load_events_a(spark, sf_dir):
    """W6 + M5: events of system A replace their tenants' events; the last
    occurrence of an event stays, tenants without a batch are left."""
    return _load_events(PQ.json_events_a(spark, sf_dir), "events_a")


@register("load_events_b", _events_sql("json_events_b"))
def load_events_b(spark, sf_dir):
    """W6 + M5: the same for system B."""
    return _load_events(PQ.json_events_b(spark, sf_dir), "events_b")


# ---------------------------------------------------------------------------
# Sessions (M6, Q10), cancellations (M2), reservations of system B (M1), reviews
# ---------------------------------------------------------------------------
@register("load_sessions_b", f"""
WITH r AS (SELECT {", ".join(SESSION_COLS)} FROM ({ORACLE_SQL["json_sessions_fanout"]}))
SELECT * FROM r
UNION ALL
SELECT * REPLACE ('other_' || client_code AS client_code, 'stale' AS court_name) FROM r WHERE client_code <> 'nation_1'""")
def load_sessions_b(spark, sf_dir):
    """M6 + Q10: court sessions; every tenant that was read is replaced, also
    one that has no sessions left (``other_nation_1``)."""
    rows = stored(PQ.json_sessions_fanout(spark, sf_dir).select(*SESSION_COLS), "load-sessions_b")
    cur = rows.withColumn("court_name", F.lit("stale")).withColumn(
        "client_code", F.explode(F.array("client_code", F.concat(F.lit("other_"), "client_code"))))
    read = rows.select("client_code").unionByName(spark.range(1).select(F.lit("other_nation_1").alias("client_code")))
    return LO.LOADS["sessions_b"].merge(cur, rows, read)


_CANCEL_ROWS = [c for c in CANCEL_COLS if c != "created_at"]
_CANCEL_KEY = "client_code, event_id, reservation_start_at, cancelled_on, member_id"


@register("load_cancellations_a", f"""
WITH r AS (SELECT {", ".join(_CANCEL_ROWS)} FROM ({ORACLE_SQL["json_cancellations_a"]})),
cur AS (SELECT * FROM r WHERE reservation_start_at < TIMESTAMP '1999-01-01'),
inc AS (SELECT * FROM r WHERE reservation_start_at IS NULL OR reservation_start_at >= TIMESTAMP '1998-07-01'
        QUALIFY row_number() OVER (PARTITION BY {_CANCEL_KEY} ORDER BY {_up(_CANCEL_ROWS)}) = 1)
SELECT *, TIMESTAMP '{OLD}' AS created_at FROM cur
UNION ALL
SELECT *, TIMESTAMP '{NOW}' AS created_at FROM inc i WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE
  {" AND ".join(f"i.{k} IS NOT DISTINCT FROM c.{k}" for k in _CANCEL_KEY.split(", "))})""")
def load_cancellations_a(spark, sf_dir):
    """M2: cancellations, of which some are in the table already and all come
    twice; new keys are appended, equal null parts count as equal."""
    rows = stored(PQ.json_cancellations_a(spark, sf_dir).select(*_CANCEL_ROWS), "load-cancellations_a")
    start = F.col("reservation_start_at")
    cur = rows.filter(start < _at("1999-01-01")).withColumn("created_at", _at(OLD)).select(*CANCEL_COLS)
    inc = rows.filter(start.isNull() | (start >= _at("1998-07-01")))
    return LO.LOADS["cancellations_a"].merge(
        cur, _batch(inc, _CANCEL_ROWS, "player_name").withColumn("created_at", _at(NOW)), None)


_RES_CUT = "1995-06-01"


@register("load_reservations_b", f"""
WITH r AS (SELECT {", ".join(RES_COLS)} FROM ({ORACLE_SQL["json_participants"]})),
w AS (SELECT *, coalesce(reservation_updated_at < TIMESTAMP '{_RES_CUT}', false) AS old FROM r),
first AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY old, client_code, reservation_id, member_id
  ORDER BY reservation_updated_at DESC NULLS LAST, {_up(RES_COLS)}) = 1),
cur AS (SELECT * EXCLUDE (old), TIMESTAMP '{OLD}' AS created_at FROM first WHERE old),
staged AS (SELECT * EXCLUDE (old), TIMESTAMP '{NOW}' AS created_at FROM first WHERE NOT old
  QUALIFY row_number() OVER (PARTITION BY client_code, event_id, reservation_start_at, reservation_created_at, member_id
                             ORDER BY reservation_updated_at DESC NULLS LAST, {_up(RES_COLS)}) = 1),
inc AS (SELECT * FROM staged s WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE
  {" AND ".join(f"s.{k} IS NOT DISTINCT FROM c.{k}" for k in M.RES_STAGE_KEY)}))
SELECT * FROM inc
UNION ALL
SELECT * FROM cur c WHERE NOT EXISTS (SELECT 1 FROM inc i WHERE
  {" AND ".join(f"i.{k} = c.{k}" for k in M.RES_BATCH_KEY)})""")
def load_reservations_b(spark, sf_dir):
    """M1: reservations of system B, one row per participant, merged with the
    table; every participant row is in the table or in the batch."""
    rows = stored(PQ.json_participants(spark, sf_dir).select(*RES_COLS), "load-reservations_b") \
        .withColumn("_pos", F.struct(*RES_COLS))
    old = F.coalesce(F.col("reservation_updated_at") < _at(_RES_CUT), F.lit(False))

    def table(part):
        cur = M.dedupe_latest(part, M.RES_BATCH_KEY, "reservation_updated_at", "_pos").drop("_pos")
        return cur.withColumn("created_at", _at(OLD))

    def merge(cur, part):
        return LO.LOADS["reservations_b"].merge(cur, part, None)
    cur = stored_parts(table, [rows.filter(old)], M.RES_APART, job_dir(spark, "load-reservations_b-table"))
    inc = rows.filter(~old).withColumn("created_at", _at(NOW))
    return stored_parts(merge, [cur, inc], M.RES_APART, job_dir(spark, "load-reservations_b-merged"))


@register("load_reviews", f"""
WITH f AS (SELECT 'nation_' || CAST(s_nationkey AS VARCHAR) AS client_code, min(s_suppkey) AS k FROM supplier
           WHERE s_nationkey % 4 <> 0 GROUP BY s_nationkey),
inc AS (SELECT f.client_code, 'google' AS review_service, CAST(k % 300 AS INTEGER) AS num_reviews, s_acctbal / 2000 AS avg_review,
               'https://www.google.com/maps/place/?q=place_id:place' || CAST(k AS VARCHAR) AS link_to_reviews
        FROM f JOIN supplier ON s_suppkey = k QUALIFY row_number() OVER (PARTITION BY client_code ORDER BY s_acctbal DESC) = 1),
cur AS (SELECT lower(n_name) AS client_code, unnest(['google', 'yelp']) AS review_service, -1 AS num_reviews,
               CAST(NULL AS DOUBLE) AS avg_review, 'old' AS link_to_reviews FROM nation)
SELECT *, TIMESTAMP '{NOW}' AS last_updated_at, TIMESTAMP '{NOW}' AS updated_at FROM inc
UNION ALL
SELECT *, TIMESTAMP '{OLD}' AS last_updated_at, TIMESTAMP '{OLD}' AS updated_at FROM cur c
WHERE NOT EXISTS (SELECT 1 FROM inc i WHERE i.client_code = c.client_code AND i.review_service = c.review_service)""")
def load_reviews(spark, sf_dir):
    """S13 + N18 + M3: reviews of the tenants that have a place id, upserted
    by tenant and service; the last poll of a place stays."""
    places = PQ._places(spark, sf_dir)
    orgs = read_table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.min("s_suppkey").alias("k")).select(
        F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("client_code"),
        F.when(F.col("s_nationkey") % 4 != 0, F.concat(F.lit("place"), F.col("k").cast("string"))).alias("google_place_id"))
    f = R.place_roster(orgs).withColumnRenamed("google_place_id", "id")
    real = PLC.review_aggregate(places.join(f, ["client_code", "id"], "left_semi"))
    first = real.withColumn("num_reviews", F.lit(-2)).withColumn("_pos", F.struct(F.lit(0).alias("n"), F.col("avg_review")))
    rows = first.unionByName(real.withColumn("_pos", F.struct(F.lit(1).alias("n"), F.col("avg_review"))))
    cur = read_table(spark, sf_dir, "nation").select(
        F.lower("n_name").alias("client_code"), F.explode(F.array(F.lit("google"), F.lit("yelp"))).alias("review_service"),
        F.lit(-1).alias("num_reviews"), F.lit(None).cast("double").alias("avg_review"), F.lit("old").alias("link_to_reviews"),
        _at(OLD).alias("last_updated_at"), _at(OLD).alias("updated_at"))
    return LO.LOADS["reviews"].merge(cur, rows.withColumn("last_updated_at", _at(NOW)).withColumn("updated_at", _at(NOW)),
                                     None)


# ---------------------------------------------------------------------------
# Rejects: responses (S1–S3), time texts (C6, T7), keys (F7), old rows (F8)
# ---------------------------------------------------------------------------
_TEXTS = ["not a time", "31.12.2024 10:00", "2024-01-05T10:00:00Z", "", None, "2024-01-05 10:00"]


@register("json_rejects", """
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'time text' WHEN 1 THEN 'time text' ELSE 'loaded' END AS outcome,
       CASE WHEN o_orderkey % 6 IN (2, 5) THEN TIMESTAMP '2024-01-05 10:00:00' END AS start_at
FROM orders""")
def json_rejects(spark, sf_dir):
    """C6 + T7: a record with a time text that is no time goes to the rejects;
    absent and empty texts are loaded as null.  All records are in one of the two."""
    o = read_table(spark, sf_dir, "orders")
    text = F.element_at(F.array(*[F.lit(t).cast("string") for t in _TEXTS]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    src = o.select("o_orderkey", F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("id"),
                                                    text.alias("startTime"))).alias("payload"))
    recs = PL.parse_records(src, "payload", PL.B_EVENT, keep=("o_orderkey",))
    good, bad = PL.split_bad_times(recs, ["startTime", "endTime"])
    start = PQ.S.parse_iso_utc(F.nullif(F.col("startTime"), F.lit("")))
    return good.select("o_orderkey", F.lit("loaded").alias("outcome"), start.alias("start_at")).unionByName(
        bad.select("o_orderkey", F.lit("time text").alias("outcome"), F.lit(None).cast("timestamp").alias("start_at")))


@register("envelope_status", """
SELECT c_custkey, 'good' AS outcome, CAST(p AS INTEGER) AS pos, 'm' || CAST(p AS VARCHAR) AS member_id
FROM customer, range(0, 2) r(p) WHERE c_custkey % 6 = 4
UNION ALL SELECT c_custkey, 'rejected', NULL, NULL FROM customer WHERE c_custkey % 6 <> 4""")
def envelope_status(spark, sf_dir):
    """Responses without a flag, with a null or false one, with an error
    text, good ones and truncated ones; each is unwrapped or rejected."""
    data = '"Data": {"Members": [{"MembershipNumber": "m0"}, {"MembershipNumber": "m1"}]}}'
    bodies = ["{" + data, '{"IsSuccessStatusCode": null, ' + data, '{"IsSuccessStatusCode": false, ' + data,
              '{"ErrorMessage": "boom", "IsSuccessStatusCode": true, ' + data, '{"IsSuccessStatusCode": true, ' + data,
              '{"IsSuccessStatusCode": tru']
    src = read_table(spark, sf_dir, "customer").select("c_custkey", F.element_at(
        F.array(*[F.lit(b) for b in bodies]), (F.col("c_custkey") % 6 + 1).cast("int")).alias("payload"))
    env = PL.parse_records(src, "payload", PL.envelope_a(PL.A_MEMBER, members=True), keep=("c_custkey",))
    good, bad = PL.split_status_a(env)
    recs = PL.unwrap_a(good, members=True, keep=("c_custkey",))
    return recs.select("c_custkey", F.lit("good").alias("outcome"), F.col("_pos").alias("pos"),
                       F.col("MembershipNumber").alias("member_id")).unionByName(
        bad.select("c_custkey", F.lit("rejected").alias("outcome"), F.lit(None).cast("int").alias("pos"),
                   F.lit(None).cast("string").alias("member_id")))


@register("stage_filters", """
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority END AS client_code,
                  CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS updated_at FROM orders)
SELECT *, 'missing key' AS outcome FROM s WHERE client_code IS NULL
UNION ALL SELECT *, 'kept' FROM s WHERE client_code IS NOT NULL AND (updated_at IS NULL OR updated_at > TIMESTAMP '1996-01-01')""")
def stage_filters(spark, sf_dir):
    """F7 + F8: staged rows without a key are set apart, rows at or before the
    watermark go, rows without a time stay."""
    k = F.col("o_orderkey")
    s = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(k % 9 != 0, F.col("o_orderpriority")).alias("client_code"),
        F.when(k % 7 != 0, F.col("o_orderdate")).alias("updated_at"))
    ok, missing = M.split_missing_keys(s, ["client_code", "o_orderkey"])
    return missing.withColumn("outcome", F.lit("missing key")).unionByName(
        M.drop_at_or_before(ok, "updated_at", "1996-01-01").withColumn("outcome", F.lit("kept")))


# ---------------------------------------------------------------------------
# Summaries (M9–M11, W3), watermark reset (M15), rosters and seeds, reviews
# ---------------------------------------------------------------------------
_SUM_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]


@register("event_summaries", f"""
WITH s AS (SELECT CASE WHEN l_partkey % 50 <> 0 THEN 'p' || CAST(l_partkey % 50 AS VARCHAR) END AS event_id,
                  l_shipdate AS program_date_time, {", ".join(_SUM_COLS)}, coalesce(l_linestatus = 'F', false) AS old FROM lineitem),
cur AS (SELECT * EXCLUDE (old) FROM s WHERE old),
inc AS (SELECT * EXCLUDE (old) FROM s WHERE NOT old
        QUALIFY row_number() OVER (PARTITION BY event_id, program_date_time ORDER BY {_down(_SUM_COLS)}) = 1)
SELECT * FROM inc
UNION ALL SELECT * FROM cur c WHERE NOT EXISTS (
  SELECT 1 FROM inc i WHERE i.event_id = c.event_id AND i.program_date_time = c.program_date_time)""")
def event_summaries(spark, sf_dir):
    """M9–M11 + W3 + F9: summaries by event and date; the batch's last row of a
    key replaces the table's rows of it."""
    cols = ["event_id", "program_date_time", *_SUM_COLS]
    s = read_table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_partkey") % 50 != 0, F.concat(F.lit("p"), (F.col("l_partkey") % 50).cast("string"))).alias("event_id"),
        F.col("l_shipdate").alias("program_date_time"), *_SUM_COLS,
        F.coalesce(F.col("l_linestatus") == "F", F.lit(False)).alias("_old"))
    return M.event_summary_merge(s.filter("_old").select(*cols),
                                 s.filter("not _old").select(*cols, F.struct(*_SUM_COLS).alias("_pos")))


@register("watermark_reset", """
SELECT 'reservations__nation_' || CAST(o_custkey % 25 AS VARCHAR) AS source_name,
       CASE WHEN o_custkey % 25 = 3 THEN TIMESTAMP '2024-01-01' ELSE max(o_orderdate) END AS last_loaded_at,
       max(o_orderdate) AS last_record_created_at
FROM orders GROUP BY o_custkey % 25""")
def watermark_reset(spark, sf_dir):
    """One source's watermark is set back, the others stay."""
    wm = read_table(spark, sf_dir, "orders").groupBy(
        T.source_name("reservations", F.concat(F.lit("nation_"), (F.col("o_custkey") % 25).cast("string"))).alias("source_name")
    ).agg(F.max("o_orderdate").alias("last_loaded_at"), F.max("o_orderdate").alias("last_record_created_at"))
    return T.reset(wm, "reservations__nation_3", "2024-01-01")


@register("tenant_roster", """
SELECT lower(s_name) AS client_code, CASE WHEN s_suppkey % 2 = 1 THEN 'pod' || CAST(s_suppkey AS VARCHAR) END AS pod_id
FROM supplier WHERE s_nationkey % 2 = 1 AND s_suppkey % 5 NOT IN (0, 4)""")
def tenant_roster(spark, sf_dir):
    """Customers of one system, code stripped and lower-cased; null and
    false customers out, an empty pod id is none."""
    k = F.col("s_suppkey")
    orgs = read_table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("  "), F.upper("s_name"), F.lit(" ")).alias("client_code"),
        F.when(F.col("s_nationkey") % 2 == 0, "courtreserve").otherwise("podplay").alias("source_system_code"),
        F.when(k % 5 == 4, F.lit(None)).otherwise(k % 5 != 0).alias("is_customer"),
        F.when(k % 2 == 1, F.concat(F.lit("pod"), k.cast("string"))).otherwise(F.lit("")).alias("podplay_pod_id"))
    return R.tenant_roster(orgs, "podplay")


@register("seed_courts", """
WITH seeds AS (SELECT CAST(s_suppkey * 10 + k AS BIGINT) AS court_id, lower(s_name) AS client_code,
                      'Court #' || CAST(k AS VARCHAR) AS court_label, 'indoor' AS court_type, CAST(9 - k AS INTEGER) AS order_index
               FROM supplier, range(1, 4) r(k)),
cur AS (SELECT CAST(s_suppkey * 10 + k AS BIGINT), lower(s_name), 'Old', 'outdoor', CAST(k AS INTEGER)
        FROM supplier, range(3, 6) r(k) WHERE k <> 3)
SELECT *, TIMESTAMP '2024-01-01' AS created_at, TIMESTAMP '2024-01-01' AS updated_at FROM seeds
UNION ALL SELECT *, TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-01' FROM cur""")
def seed_courts(spark, sf_dir):
    """S11 + O2 + P1: seed courts upserted by id, in order, as the staging model."""
    n = read_table(spark, sf_dir, "supplier")

    def courts(first, last, label, kind, index):
        k = F.col("k")
        return n.select("*", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("k")).select(
            (F.col("s_suppkey") * 10 + k).cast("bigint").alias("id"), F.lower("s_name").alias("client_code"),
            label(k).alias("label"), F.lit(kind).alias("type_name"), index(k).cast("int").alias("order_index"),
            _at("2024-01-01").alias("created_at"), _at("2024-01-01").alias("updated_at"))
    seeds = courts(1, 3, lambda k: F.concat(F.lit("Court #"), k.cast("string")), "indoor", lambda k: 9 - k)
    cur = courts(3, 5, lambda k: F.lit("Old"), "outdoor", lambda k: k)
    return P.stg_courts(R.courts_in_order(R.seed(cur, seeds, ["id"])))


@register("member_count", "SELECT count(*) AS n_members FROM customer")
def member_count(spark, sf_dir):
    """Number of member rows."""
    return R.member_count(read_table(spark, sf_dir, "customer"))


@register("place_review_rows", """
SELECT 'nation_' || CAST(s_nationkey AS VARCHAR) AS client_code, 'place' || CAST(s_suppkey AS VARCHAR) AS place_id,
       'r' || CAST(i AS VARCHAR) || '-' || CAST(s_suppkey AS VARCHAR) AS name, CAST((s_suppkey + i) % 5 + 1 AS DOUBLE) AS rating,
       'review ' || CAST(i AS VARCHAR) AS review_text, '2024-01-01T00:00:00Z' AS publish_time
FROM supplier, range(1, 3) r(i) WHERE s_suppkey % 3 <> 0""")
def place_review_rows(spark, sf_dir):
    """One row per review of a place."""
    return PLC.reviews(PQ._places(spark, sf_dir)).select(
        "client_code", "place_id", "name", "rating", F.col("text.text").alias("review_text"),
        F.col("publishTime").alias("publish_time"))


# ---------------------------------------------------------------------------
# The declared model checks
# ---------------------------------------------------------------------------
def _model_checks_sql() -> str:
    parts = []
    for name, (unique, not_null, rel) in CK.MODEL_CHECKS.items():
        for c in not_null:
            parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, 'not_null' AS check_name, "
                         f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failing_rows FROM {name}")
        for c in unique:
            parts.append(f"SELECT '{name}', '{c}', 'unique', CAST(count(*) AS BIGINT) FROM (SELECT {c} FROM {name} "
                         f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
        for c, parent, pc in rel:
            parts.append(f"SELECT '{name}', '{c}', 'relationships:{parent}.{pc}', CAST(count(*) AS BIGINT) FROM {name} x "
                         f"WHERE x.{c} IS NOT NULL AND x.{c} NOT IN (SELECT {pc} FROM {parent})")
    return f"""
WITH dim_clients AS ({ORACLE_SQL["dim_tenant"]}),
stg_organizations AS (SELECT lower(n_name) AS client_code FROM nation),
dim_members AS ({ORACLE_SQL["stg_members_keys"]}), stg_members AS (SELECT * FROM dim_members),
fct_reservations AS ({ORACLE_SQL["stg_union_tenant"]}), stg_reservations AS (SELECT * FROM fct_reservations),
stg_reservations_a AS (SELECT * FROM fct_reservations WHERE source_system_code = 'courtreserve'),
stg_reservations_b AS (SELECT * FROM fct_reservations WHERE source_system_code = 'podplay'),
fct_events AS ({ORACLE_SQL["fct_events_mapped"]}),
fct_court_availability AS ({ORACLE_SQL["peak_label"]})
""" + "\nUNION ALL\n".join(parts)


@register("model_checks", _model_checks_sql())
def model_checks(spark, sf_dir):
    """The 44 declared checks over the staging models and marts."""
    orgs = P.stg_organizations(MO.organizations_view(spark, sf_dir))
    members = P.stg_members(MO.members_raw_view(spark, sf_dir), orgs)
    raw = MO.reservations_raw_view(spark, sf_dir)
    stg = P.stg_reservations(raw, orgs)
    return CK.model_checks({
        "dim_clients": P.dim_clients(orgs), "stg_organizations": orgs, "stg_members": members,
        "dim_members": P.dim_members(members), "stg_reservations": stg, "fct_reservations": P.fct_reservations(stg),
        "stg_reservations_a": P.stg_reservations_a(raw, orgs), "stg_reservations_b": P.stg_reservations_b(raw, orgs),
        "fct_events": MO.fct_events_mapped(spark, sf_dir), "fct_court_availability": peak_label(spark, sf_dir)})
