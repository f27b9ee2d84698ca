"""Catalogue: loads over several polls, and records as VARIANT.

A poll query lands the records of a driver table as responses (a page of records a
line) in three polls and runs the load after the first, after the other two together,
and once more with nothing new.  Landing, ledger and table live under the session's
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import payloads as PL
from ..sources import snapshot as SN
from ..sources import variants as VA
from ..sources.tables import read_table
from ..streaming import stream as ST
from . import jobs as J
from . import loads as LO
from .payload_queries import SESSION_END, _txt
from .registry import register

NOW = "2024-01-22 00:00:00"  # seven days before SESSION_END
PAGE = 500
TENANT_SQL = "'nation_' || CAST(user_id % 25 AS VARCHAR)"


def _tenant(key: str) -> Column:
    return F.concat(F.lit("nation_"), (F.col(key) % 25).cast("string"))


def _land(records: DataFrame, landing: str, polls: list[int], before: Column | None = None) -> None:
    """``records``: poll, client_code, page, at (order in the page), rec (JSON text; null: the page is
    empty); ``before`` is the response up to its list."""
    pages = records.filter(F.col("poll").isin(polls)).groupBy("poll", "client_code", "page").agg(
        F.sort_array(F.collect_list(F.struct("at", "rec"))).alias("own"))  # a page holds PAGE records at most
    items = F.array_join("own.rec", ", ")  # leaves null elements out
    head = F.lit('{"items": [') if before is None else before
    pages.select("poll", "client_code", F.concat(head, items, F.lit("]}")).alias("value")) \
        .write.mode("append").partitionBy("poll", "client_code").text(landing)


def _organizations(spark, sf_dir, system: str) -> DataFrame:
    return read_table(spark, sf_dir, "nation").select(
        F.concat(F.lit(" Nation_"), F.col("n_nationkey").cast("string")).alias("client_code"), F.lit(True).alias("is_customer"),
        F.lit(system).alias("source_system_code"), F.lit("").alias("podplay_pod_id"))


def _three_polls(spark, sf_dir, name: str, records: DataFrame) -> DataFrame:
    base = ST.job_dir(spark, f"polls-{name}")
    landing, table = os.path.join(base, "landing"), os.path.join(base, "table")
    orgs = _organizations(spark, sf_dir, LO.LOADS[name].system)
    for polls in ([1], [2, 3], []):
        if polls:
            _land(records, landing, polls)
        LO.run(spark, name, landing, table, NOW, orgs, multiline=False)
    return SN.read_latest(spark, table)


def _in_polls(df: DataFrame, key: str) -> DataFrame:
    """Every row in two of three polls, a page for each 500 keys."""
    return df.withColumn("poll", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))) \
        .filter((F.col(key) + F.col("poll")) % 3 != 0).withColumn("page", F.floor(F.col(key) / PAGE))


@register("load_members_polls", """
SELECT 'nation_' || CAST(c_nationkey AS VARCHAR) AS client_code, CAST(c_custkey AS VARCHAR) AS member_id,
       'poll ' || CASE WHEN c_custkey % 3 = 0 THEN '2' ELSE '3' END AS first_name, c_name AS last_name
FROM customer""")
def load_members_polls(spark, sf_dir):
    """M3 + M7 + S1 over three polls: a member's newest poll stays, the first of its rows
    there; a member that is not in the newest poll stays.  Ids are numbers and texts."""
    c = _in_polls(read_table(spark, sf_dir, "customer"), "c_custkey")
    k = F.col("c_custkey")

    def user(again: bool):
        name = F.lit("again") if again else F.concat(F.lit("poll "), F.col("poll").cast("string"))
        return F.to_json(F.struct(k.cast("string").alias("id"), name.alias("firstName"), F.col("c_name").alias("lastName")))

    def row(n, rec):
        return F.struct(F.struct(k.alias("k"), F.lit(n).alias("n")).alias("at"), rec.alias("rec"))
    number = F.replace(user(False), F.concat(F.lit('"id":"'), k.cast("string"), F.lit('"')),
                       F.concat(F.lit('"id":'), k.cast("string")))
    rows = F.filter(F.array(row(0, F.when(k % 5 == 0, number).otherwise(user(False))),
                            row(1, F.when(k % 7 == 0, user(True)))), lambda r: r["rec"].isNotNull())
    recs = c.select("poll", F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("client_code"), "page",
                    F.inline(rows))
    return _three_polls(spark, sf_dir, "members_b", recs).select("client_code", "member_id", "first_name", "last_name")


def _of_events(spark, sf_dir, rec: Column, empty: bool) -> DataFrame:
    """Records of the events; ``nation_1`` is not in poll 3, ``nation_2`` has no record there
    (an empty response where ``empty``)."""
    e = _in_polls(read_table(spark, sf_dir, "events"), "event_id").withColumn("client_code", _tenant("user_id"))
    last = F.col("poll") == 3
    e = e.filter(~(last & (F.col("client_code") == "nation_1")))
    gone = last & (F.col("client_code") == "nation_2")
    rec = F.when(~gone, F.to_json(rec))
    if not empty:
        e = e.filter(~gone)
    return e.select("poll", "client_code", "page", F.col("event_id").alias("at"), rec.alias("rec"))


_LAST_POLL_SQL = f"""
e AS (SELECT *, {TENANT_SQL} AS client_code FROM events),
p AS (SELECT e.*, poll FROM e, range(1, 4) r(poll) WHERE (event_id + poll) % 3 <> 0
      AND NOT (poll = 3 AND client_code IN ('nation_1', 'nation_2')))"""


@register("load_sessions_polls", f"""
WITH {_LAST_POLL_SQL.strip()}
SELECT client_code, 'podplay' AS source_system, CAST(user_id % 4 AS VARCHAR) AS court_id,
       'poll ' || CAST(poll AS VARCHAR) AS court_name, ts AS slot_start, ts + INTERVAL 30 MINUTE AS slot_end,
       CAST(event_id AS VARCHAR) AS period_type
FROM p WHERE poll = CASE WHEN client_code = 'nation_1' THEN 2 ELSE 3 END AND ts <= TIMESTAMP '{SESSION_END}'""")
def load_sessions_polls(spark, sf_dir):
    """M6 + Q10 + S1 over three polls: a tenant's newest poll is all its sessions, an empty
    one clears it, a tenant without one keeps its own."""
    ts = F.col("ts")
    tab = F.struct(F.lit("FIXED_TABLE").alias("type"), F.struct(
        (F.col("user_id") % 4).cast("string").alias("id"),
        F.concat(F.lit("poll "), F.col("poll").cast("string")).alias("displayName")).alias("table"))
    rec = F.struct(F.lit("AVAILABLE").alias("status"), _txt(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("startTime"),
                   _txt(ts + F.expr("INTERVAL 30 MINUTES"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("endTime"),
                   F.col("event_id").cast("string").alias("periodType"),
                   F.struct(F.array(tab).alias("items")).alias("availableTables"))
    return _three_polls(spark, sf_dir, "sessions_b", _of_events(spark, sf_dir, rec, empty=True))


@register("load_events_polls", f"""
WITH {_LAST_POLL_SQL.strip()}
SELECT client_code, CAST(event_id AS VARCHAR) AS event_id, 'poll ' || CAST(poll AS VARCHAR) AS event_name,
       ts AS event_start_time
FROM p WHERE poll = CASE WHEN client_code IN ('nation_1', 'nation_2') THEN 2 ELSE 3 END""")
def load_events_polls(spark, sf_dir):
    """M5 + W6 + S1 over three polls: a tenant's newest poll replaces its events, vanished
    ones go; a tenant without events in it keeps its own."""
    rec = F.struct(F.col("event_id").cast("string").alias("id"), F.lit("EVENT").alias("type"),
                   F.concat(F.lit("poll "), F.col("poll").cast("string")).alias("name"),
                   _txt(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("startTime"))
    return _three_polls(spark, sf_dir, "events_b", _of_events(spark, sf_dir, rec, empty=False)).select(
        "client_code", "event_id", "event_name", "event_start_time")


@register("json_variant_records", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'not json' WHEN o_orderkey % 7 = 1 THEN 'record'
                        WHEN o_orderkey % 7 = 2 THEN 'field type' ELSE 'good' END AS outcome,
       CASE WHEN o_orderkey % 7 > 2 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'R-' ELSE '' END || CAST(o_orderkey AS VARCHAR)
       END AS reservation_id,
       CASE WHEN o_orderkey % 7 > 2 THEN 'low ' || CAST(o_custkey AS VARCHAR) END AS lower_id,
       CASE WHEN o_orderkey % 7 > 2 THEN CAST(o_custkey AS VARCHAR) END AS member_id
FROM orders""")
def json_variant_records(spark, sf_dir):
    """S1–S3 + N1–N3 + C26: records as VARIANT: ids as numbers and texts, keys that differ by
    case, unknown keys, values of a wrong type, no object, no JSON."""
    k, c = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    ident = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit('"R-'), k, F.lit('"'))).otherwise(k)
    players = F.when(F.col("o_orderkey") % 7 == 2, F.lit('"none"')).otherwise(
        F.concat(F.lit('[{"OrganizationMemberId": '), c, F.lit('}]')))
    good = F.concat(F.lit('{"Id": '), ident, F.lit(', "id": "low '), c, F.lit('", "Unknown": {"a": [1, null]}, "Players": '),
                    players, F.lit("}"))
    text = F.when(F.col("o_orderkey") % 7 == 0, F.left(good, F.length(good) - 1)) \
        .when(F.col("o_orderkey") % 7 == 1, F.concat(F.lit("["), good, F.lit("]"))).otherwise(good)
    src = read_table(spark, sf_dir, "orders").select("o_orderkey", F.inline(F.array(F.struct(F.try_parse_json(text).alias("v")))))
    recs = VA.records(src, PL.A_RESERVATION, "id STRING")
    ok = F.col("fault").isNull()
    return recs.select("o_orderkey", F.when(F.col("v").isNull(), "not json").otherwise(F.coalesce("fault", F.lit("good"))).alias("outcome"),
                       F.when(ok, F.col("f.Id")).alias("reservation_id"), F.when(ok, F.col("f._alt.id")).alias("lower_id"),
                       F.when(ok, F.col("f.Players")[0]["OrganizationMemberId"]).alias("member_id"))


_TIMES = ["2024-01-05T10:00:00", "soon", "2024-01-05T10:00:00", "20240105T100000", "", "31.12.2024 10:00"]


@register("load_reservation_rejects", f"""
WITH o AS (SELECT *, 'nation_' || CAST(o_custkey % 25 AS VARCHAR) AS client_code,
                  o_orderkey // {PAGE} AS page, list_extract({_TIMES}, o_orderkey % 6 + 1) AS start_text FROM orders),
w AS (SELECT client_code, page, CASE WHEN page % 10 = 9 THEN 'response' WHEN client_code = 'nation_3' THEN 'tenant not in roster'
             WHEN start_text IN ('soon', '31.12.2024 10:00') THEN 'time text' ELSE 'loaded' END AS outcome FROM o)
SELECT client_code, outcome, CASE WHEN outcome = 'response' THEN count(DISTINCT page) ELSE count(*) END AS n
FROM w GROUP BY client_code, outcome""")
def load_reservation_rejects(spark, sf_dir):
    """C6 + T7 + S3 + S12 in the reservation load: every record is in the table or, with a
    reason, in the rejects; a response that names an error is one reject."""
    base = ST.job_dir(spark, "reservation-rejects")
    landing, table, rejects = (os.path.join(base, x) for x in ("landing", "table", "rejects"))
    k = F.col("o_orderkey")
    at = F.element_at(F.array(*[F.lit(t) for t in _TIMES]), (k % 6 + 1).cast("int"))
    rec = F.struct(k.alias("Id"), k.alias("ReservationTypeId"), F.lit("Court Reservation").alias("ReservationTypeName"),
                   at.alias("StartTime"), F.lit("2024-01-01T00:00:00Z").alias("CreatedOnUtc"),
                   F.array(F.struct(F.col("o_custkey").alias("OrganizationMemberId"))).alias("Players"))
    page = F.floor(k / PAGE)
    o = read_table(spark, sf_dir, "orders").select(F.lit(1).alias("poll"), _tenant("o_custkey").alias("client_code"),
                                                   page.alias("page"), k.alias("at"), F.to_json(rec).alias("rec"))
    error = F.when(F.col("page") % 10 == 9, '"boom"').otherwise("null")
    _land(o, landing, [1], F.concat(F.lit('{"ErrorMessage": '), error, F.lit(', "IsSuccessStatusCode": true, "Data": [')))
    orgs = _organizations(spark, sf_dir, "courtreserve").filter("client_code <> ' Nation_3'")
    J.reservations_load(spark, landing, table, os.path.join(base, "marks"), NOW, mode="full", organizations=orgs,
                        rejects=rejects, multiline=False)
    rows = SN.read_latest(spark, table).select("client_code", F.lit("loaded").alias("outcome"))
    lost = SN.read_latest(spark, rejects).select("client_code", F.col("reason").alias("outcome"))
    return rows.unionByName(lost).groupBy("client_code", "outcome").agg(F.count(F.lit(1)).alias("n"))
