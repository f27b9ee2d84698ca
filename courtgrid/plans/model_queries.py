"""Catalogue: scalar rules, classifier, model chain, quality checks, watermarks.

Derived inputs (same formula on both sides):

* contact texts from ``customer`` keys (phone and e-mail variants that hit
  every rule branch);
* ISO time texts from ``orders`` (naive, 'Z', offsets with and without
  colon, date only, junk);
* event titles from ``part`` names and sizes;
* ``organizations`` from ``nation``; ``members_raw`` from ``customer``;
  ``reservations_raw`` from ``orders``; ``facility_events_raw`` from
  ``events`` (its JSON ``props`` gives the title).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import scalars as S
from ..operators import merge as M
from ..operators import quality as Q
from ..operators import watermark as T
from ..sources.tables import read_table, write_clustered
from ..streaming.stream import job_dir
from . import merge_queries as MQ
from . import models as P
from .facility_queries import HOURS_DOCS, PEAK_DOCS, _doc_col, _doc_sql
from .registry import ORACLE_SQL, local_to_utc_sql, register

# ---------------------------------------------------------------------------
# Contacts (C1–C4, C22)
# ---------------------------------------------------------------------------


def _pad(n, width, ch):
    return F.lpad(n.cast("string"), width, ch)


def contacts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    phone = (
        F.when(k % 8 == 0, _pad(k, 10, "2"))
        .when(k % 8 == 1, F.concat(F.lit("1"), _pad(k, 10, "3")))
        .when(k % 8 == 2, F.concat(F.lit("+1"), _pad(k, 10, "4")))
        .when(k % 16 == 3, F.concat(F.lit("+1 (234) 567-"), _pad(k, 4, "0")))
        .when(k % 8 == 3, F.concat(F.lit("(234) 567-"), _pad(k, 4, "0")))
        .when(k % 8 == 4, F.concat(F.lit("+44 20 "), _pad(k, 8, "7")))
        .when(k % 8 == 5, F.concat(F.lit("1"), _pad(k, 12, "5")))
        .when(k % 8 == 6, F.concat(F.lit("  "), _pad(k, 11, "9"), F.lit(" ")))
        .when(k % 16 == 7, F.lit(""))
        .otherwise(_pad(k, 6, "8"))
    )
    email = (
        F.when(k % 6 == 0, F.concat(F.col("c_name"), F.lit("@Example.COM")))
        .when(k % 6 == 1, F.concat(F.lit("  "), F.lower("c_name"), F.lit("@mail.org  ")))
        .when(k % 6 == 2, F.concat(F.lit("a@b@"), k.cast("string")))
        .when(k % 6 == 3, F.concat(F.lit("@"), k.cast("string")))
        .when(k % 6 == 4, F.concat(k.cast("string"), F.lit("@")))
        .when(k % 12 == 5, F.lit("   "))
    )
    return c.select("c_custkey", phone.alias("phone_raw"), email.alias("email_raw"))


CONTACTS_SQL = """
contacts AS (
  SELECT c_custkey,
    CASE WHEN c_custkey % 8 = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 10, '2')
         WHEN c_custkey % 8 = 1 THEN '1' || lpad(CAST(c_custkey AS VARCHAR), 10, '3')
         WHEN c_custkey % 8 = 2 THEN '+1' || lpad(CAST(c_custkey AS VARCHAR), 10, '4')
         WHEN c_custkey % 16 = 3 THEN '+1 (234) 567-' || lpad(CAST(c_custkey AS VARCHAR), 4, '0')
         WHEN c_custkey % 8 = 3 THEN '(234) 567-' || lpad(CAST(c_custkey AS VARCHAR), 4, '0')
         WHEN c_custkey % 8 = 4 THEN '+44 20 ' || lpad(CAST(c_custkey AS VARCHAR), 8, '7')
         WHEN c_custkey % 8 = 5 THEN '1' || lpad(CAST(c_custkey AS VARCHAR), 12, '5')
         WHEN c_custkey % 8 = 6 THEN '  ' || lpad(CAST(c_custkey AS VARCHAR), 11, '9') || ' '
         WHEN c_custkey % 16 = 7 THEN ''
         ELSE lpad(CAST(c_custkey AS VARCHAR), 6, '8') END AS phone_raw,
    CASE WHEN c_custkey % 6 = 0 THEN c_name || '@Example.COM'
         WHEN c_custkey % 6 = 1 THEN '  ' || lower(c_name) || '@mail.org  '
         WHEN c_custkey % 6 = 2 THEN 'a@b@' || CAST(c_custkey AS VARCHAR)
         WHEN c_custkey % 6 = 3 THEN '@' || CAST(c_custkey AS VARCHAR)
         WHEN c_custkey % 6 = 4 THEN CAST(c_custkey AS VARCHAR) || '@'
         WHEN c_custkey % 12 = 5 THEN '   ' END AS email_raw
  FROM customer
)"""


def phone_ingest_sql(x: str) -> str:
    s = f"trim({x})"
    clean = f"regexp_replace({s}, '[\\s\\-\\(\\)\\.]', '', 'g')"
    d = f"regexp_replace({clean}, '\\D', '', 'g')"
    n = f"length({d})"
    return (f"CASE WHEN {x} IS NULL OR {x} = '' OR {s} = '' THEN NULL "
            f"WHEN starts_with({clean}, '+1') AND length({clean}) = 12 THEN {clean} "
            f"WHEN starts_with({clean}, '+') AND NOT starts_with({clean}, '+1') THEN {clean} "
            f"WHEN {n} = 0 THEN NULL "
            f"WHEN {n} = 11 AND starts_with({d}, '1') THEN '+' || {d} "
            f"WHEN {n} = 10 THEN '+1' || {d} "
            f"WHEN starts_with({d}, '1') AND {n} > 11 THEN '+' || left({d}, 11) "
            f"WHEN {n} = 11 THEN '+' || {d} "
            f"WHEN {n} < 10 THEN NULL "
            f"ELSE '+1' || right({d}, 10) END")


def phone_model_sql(x: str) -> str:
    d = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    n = f"length({d})"
    return (f"CASE WHEN {x} IS NULL OR trim({x}) = '' THEN NULL "
            f"WHEN {x} LIKE '+%' AND NOT ({x} LIKE '+1%') THEN {x} "
            f"WHEN {x} LIKE '+1%' AND {n} = 11 AND {d} LIKE '1%' THEN {x} "
            f"WHEN {n} = 11 AND {d} LIKE '1%' THEN '+' || {d} "
            f"WHEN {n} = 10 THEN '+1' || {d} "
            f"WHEN {n} > 10 THEN '+1' || right({d}, 10) "
            f"ELSE NULL END")


def email_ingest_sql(x: str) -> str:
    e = f"lower(trim({x}))"
    return (f"CASE WHEN {x} IS NULL OR {e} = '' THEN NULL "
            f"WHEN len(string_split({e}, '@')) = 2 AND split_part({e}, '@', 1) <> '' "
            f"AND split_part({e}, '@', 2) <> '' THEN {e} END")


def email_model_sql(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR trim({x}) = '' THEN NULL "
            f"WHEN {x} NOT LIKE '%@%' THEN NULL "
            f"WHEN position('@' IN {x}) = 1 THEN NULL "
            f"WHEN position('@' IN {x}) = length({x}) THEN NULL "
            f"ELSE lower(trim({x})) END")


def _contact_query(name, raw, fn, sql_fn, out):
    @register(name, f"WITH {CONTACTS_SQL.strip()}\nSELECT c_custkey, {raw}, {sql_fn(raw)} AS {out} FROM contacts")
    def q(spark, sf_dir):
        c = contacts_view(spark, sf_dir)
        return c.select("c_custkey", raw, fn(F.col(raw)).alias(out))
    q.__doc__ = f"{name}: {fn.__doc__}"
    return q


_contact_query("normalize_phone_ingest", "phone_raw", S.normalize_phone_ingest, phone_ingest_sql, "phone")
_contact_query("normalize_phone_model", "phone_raw", S.normalize_phone_model, phone_model_sql, "phone")
_contact_query("normalize_email_ingest", "email_raw", S.normalize_email_ingest, email_ingest_sql, "email")
_contact_query("normalize_email_model", "email_raw", S.normalize_email_model, email_model_sql, "email")


@register("normalize_phone_pipeline", f"""
WITH {CONTACTS_SQL.strip()}
SELECT c_custkey, phone_raw, {phone_model_sql(f'({phone_ingest_sql("phone_raw")})')} AS phone FROM contacts""")
def normalize_phone_pipeline(spark, sf_dir):
    """Q11: ingest rules then model rules, as the data flows."""
    c = contacts_view(spark, sf_dir)
    return c.select("c_custkey", "phone_raw",
                    S.normalize_phone_model(S.normalize_phone_ingest(F.col("phone_raw"))).alias("phone"))


# ---------------------------------------------------------------------------
# ISO times and zones
# ---------------------------------------------------------------------------


def iso_view(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    t = F.timestamp_add("MINUTE", (k % 1440), F.col("o_orderdate"))
    base = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(k % 6 == 0, base)
        .when(k % 6 == 1, F.concat(base, F.lit("Z")))
        .when(k % 6 == 2, F.concat(base, F.lit("+05:30")))
        .when(k % 6 == 3, F.concat(base, F.lit("-0400")))
        .when(k % 6 == 4, F.date_format(t, "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("not a date "), k.cast("string")))
    )
    return o.select("o_orderkey", text.alias("iso_text"))


ISO_SQL = """
iso AS (
  SELECT o_orderkey,
    CASE o_orderkey % 6
      WHEN 0 THEN strftime(o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)), '%Y-%m-%dT%H:%M:%S')
      WHEN 1 THEN strftime(o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)), '%Y-%m-%dT%H:%M:%S') || 'Z'
      WHEN 2 THEN strftime(o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)), '%Y-%m-%dT%H:%M:%S') || '+05:30'
      WHEN 3 THEN strftime(o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)), '%Y-%m-%dT%H:%M:%S') || '-0400'
      WHEN 4 THEN strftime(o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)), '%Y-%m-%d')
      ELSE 'not a date ' || CAST(o_orderkey AS VARCHAR) END AS iso_text
  FROM orders
),
iso2 AS (
  SELECT *,
    CASE WHEN regexp_matches(iso_text, '^\\d{4}-\\d{2}-\\d{2}$') THEN CAST(iso_text AS TIMESTAMP)
         WHEN regexp_matches(iso_text, '^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}')
         THEN CAST(replace(substr(iso_text, 1, 19), 'T', ' ') AS TIMESTAMP) END AS wall,
    CASE WHEN iso_text LIKE '%Z' THEN 0
         WHEN regexp_matches(iso_text, '[+-]\\d{2}:?\\d{2}$') AND length(iso_text) > 19
         THEN (CASE WHEN substr(iso_text, 20, 1) = '-' THEN -1 ELSE 1 END)
              * (CAST(substr(iso_text, 21, 2) AS INTEGER) * 60 + CAST(right(iso_text, 2) AS INTEGER)) END AS off_min
  FROM iso
)"""


@register("parse_iso_mixed", f"""
WITH {ISO_SQL.strip()}
SELECT o_orderkey, iso_text,
  CASE WHEN off_min IS NOT NULL THEN wall - to_minutes(CAST(off_min AS BIGINT)) ELSE wall END AS parsed_utc,
  CASE WHEN off_min IS NOT NULL THEN wall - to_minutes(CAST(off_min AS BIGINT))
       WHEN wall IS NOT NULL THEN {local_to_utc_sql('wall', "'America/New_York'")} END AS parsed_new_york,
  CASE WHEN regexp_matches(iso_text, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN CAST(iso_text AS DATE) END AS parsed_date,
  CASE WHEN off_min IS NOT NULL THEN dayname(wall - to_minutes(CAST(off_min AS BIGINT)))
       WHEN wall IS NOT NULL THEN dayname(wall) END AS weekday_utc
FROM iso2""".replace("{{", "{").replace("}}", "}"))
def parse_iso_mixed(spark, sf_dir):
    """ISO texts with and without zone; naive read as UTC or
    as New York; date-only texts as dates; junk -> null."""
    v = iso_view(spark, sf_dir)
    utc = S.parse_iso_utc(F.col("iso_text"))
    return v.select(
        "o_orderkey", "iso_text", utc.alias("parsed_utc"),
        S.parse_event_time(F.col("iso_text")).alias("parsed_new_york"),
        S.parse_iso_date(F.col("iso_text")).alias("parsed_date"),
        S.weekday_name(utc).alias("weekday_utc"),
    )


ZONE_CANDIDATES = ["America/New_York", "Mars/Olympus", None, "Europe/Paris", "", "Asia/Tokyo"]


@register("resolve_zone", """
SELECT s_suppkey, explicit_zone,
  CASE WHEN explicit_zone IN (SELECT name FROM pg_timezone_names()) THEN explicit_zone
       ELSE 'America/Chicago' END AS zone
FROM (SELECT s_suppkey,
        CASE s_suppkey % 6 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'Mars/Olympus' WHEN 2 THEN NULL
             WHEN 3 THEN 'Europe/Paris' WHEN 4 THEN '' ELSE 'Asia/Tokyo' END AS explicit_zone
      FROM supplier)""")
def resolve_zone(spark, sf_dir):
    """Payload zone, else default; unknown names are skipped."""
    s = read_table(spark, sf_dir, "supplier")
    expr = None
    for i, z in enumerate(ZONE_CANDIDATES):
        v = F.lit(z).cast("string")
        expr = F.when(F.col("s_suppkey") % 6 == i, v) if expr is None else expr.when(F.col("s_suppkey") % 6 == i, v)
    zones = S.known_zone_names(spark)
    v = s.select("s_suppkey", expr.alias("explicit_zone"))
    return v.select("s_suppkey", "explicit_zone",
                    S.resolve_zone(zones, F.col("explicit_zone"), F.lit("America/Chicago")).alias("zone"))


# ---------------------------------------------------------------------------
# Classifier
# ---------------------------------------------------------------------------
# Fixed test vocabulary (not reference values): title suffixes by part size.
TITLE_SUFFIXES = [
    "Beginner 101", "Advanced Intermediate", "Open Play 3.75+", "Experienced Beginner Clinic", "Adv Beg Drill",
    "201 Skills", "Advanced 401", "4.0+ Round Robin", "Intermediate Drill Hour", "Intro to Paddle",
    "Try-It Night", "All Levels Beginner", "Paddle Battle", "Live Match Play", "Social Mixer", "  ",
    "Exp Beg Ladder", "High Intermediate 3.5", "Fixed Partner League", "Expert Session", "2.5 Ladies",
    "Advanced Intermediates", "3.0+ Night", "Advanced Beginners Only", "Drill Hour", "5.0 Open",
]


def _vocab_col(key, words):
    expr = None
    n = len(words)
    for i, w in enumerate(words):
        cond = (key % n) == i
        expr = F.when(cond, F.lit(w)) if expr is None else expr.when(cond, F.lit(w))
    return expr


def _vocab_sql(key: str, words) -> str:
    n = len(words)
    return "CASE " + " ".join(f"WHEN {key} % {n} = {i} THEN '{w}'" for i, w in enumerate(words)) + " END"


TITLES_SQL = f"""
titles AS (
  SELECT p_partkey,
         CASE WHEN p_size % 50 = 0 THEN NULL
              WHEN p_partkey % 7 = 0 THEN {_vocab_sql('p_size', TITLE_SUFFIXES)}
              ELSE p_name || ' ' || {_vocab_sql('p_size', TITLE_SUFFIXES)} END AS title
  FROM part
)"""


@register("classify_titles", f"""
WITH {TITLES_SQL.strip()}
SELECT p_partkey, title, {R.skill_level_sql('title')} AS skill_level FROM titles""")
def classify_titles(spark, sf_dir):
    """Skill level of titles built from part names and sizes."""
    p = read_table(spark, sf_dir, "part")
    suffix = _vocab_col(F.col("p_size"), TITLE_SUFFIXES)
    title = (F.when(F.col("p_size") % 50 == 0, F.lit(None).cast("string"))
             .when(F.col("p_partkey") % 7 == 0, suffix)
             .otherwise(F.concat(F.col("p_name"), F.lit(" "), suffix)))
    t = p.select("p_partkey", title.alias("title"))
    return t.select("p_partkey", "title", R.skill_level(F.col("title")).alias("skill_level"))


# ---------------------------------------------------------------------------
# Model chain
# ---------------------------------------------------------------------------


def organizations_view(spark, sf_dir) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.when(F.col("n_regionkey") % 2 == 0, "courtreserve").otherwise("podplay").alias("source_system_code"),
        F.lower("n_name").alias("client_code"),
        F.lit(None).cast("string").alias("login_link"),
        F.concat(F.lit("City "), F.col("n_nationkey").cast("string")).alias("city"),
        (F.col("n_regionkey") != 4).alias("is_customer"),
        (F.col("n_nationkey") * 2 + 40).alias("hourly_rate_non_member"),
        (F.col("n_nationkey") + 30).alias("hourly_rate_member"),
        F.lit(None).cast("int").alias("hourly_rate_non_member_off_peak"),
        F.lit(None).cast("int").alias("hourly_rate_member_off_peak"),
        F.initcap(F.regexp_replace("n_name", "_", " ")).alias("facility_display_name"),
        _doc_col(PEAK_DOCS).alias("peak_hours"),
        F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")).alias("location_display_name"),
        F.lit(None).cast("string").alias("podplay_pod"),
        F.lit(None).cast("string").alias("podplay_pod_id"),
        _doc_col(HOURS_DOCS).alias("operating_hours"),
    )


ORGS_SQL = f"""
orgs AS (
  SELECT CAST(n_nationkey AS BIGINT) AS organization_id,
         CASE WHEN n_regionkey % 2 = 0 THEN 'courtreserve' ELSE 'podplay' END AS source_system_code,
         lower(n_name) AS client_code, CAST(NULL AS VARCHAR) AS login_link,
         'City ' || CAST(n_nationkey AS VARCHAR) AS city, n_regionkey <> 4 AS is_customer,
         n_nationkey * 2 + 40 AS hourly_rate_non_member, n_nationkey + 30 AS hourly_rate_member,
         CAST(NULL AS INTEGER) AS hourly_rate_non_member_off_peak, CAST(NULL AS INTEGER) AS hourly_rate_member_off_peak,
         'Nation ' || CAST(n_nationkey AS VARCHAR) AS facility_display_name,
         {_doc_sql(PEAK_DOCS)} AS peak_hours,
         'Region ' || CAST(n_regionkey AS VARCHAR) AS location_display_name,
         CAST(NULL AS VARCHAR) AS podplay_pod, CAST(NULL AS VARCHAR) AS podplay_pod_id,
         {_doc_sql(HOURS_DOCS)} AS operating_hours
  FROM nation
)"""


@register("dim_tenant", f"""
WITH {ORGS_SQL.strip()}
SELECT client_code, facility_display_name AS client_name, location_display_name,
       CAST(NULL AS VARCHAR) AS timezone, is_customer AS is_active, CAST(NULL AS VARCHAR) AS notes,
       source_system_code AS reservation_system_code,
       CASE WHEN source_system_code = 'courtreserve' THEN 'CourtReserve'
            WHEN source_system_code = 'podplay' THEN 'Podplay' ELSE source_system_code END AS reservation_system_name,
       CAST(NULL AS VARCHAR) AS api_base_url, CAST(NULL AS VARCHAR) AS auth_method,
       CAST(NULL AS VARCHAR) AS reservation_system_notes
FROM orgs""")
def dim_tenant(spark, sf_dir):
    """P2 + P7: tenant dimension."""
    return P.dim_clients(P.stg_organizations(organizations_view(spark, sf_dir)))


def members_raw_view(spark, sf_dir) -> DataFrame:
    c = contacts_view(spark, sf_dir)
    cu = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    j = cu.join(c, "c_custkey")
    return j.select(
        F.concat(F.when(k % 3 == 0, F.lit("NATION_")).otherwise(F.lit("nation_")),
                 F.col("c_nationkey").cast("string")).alias("client_code"),
        k.cast("string").alias("member_id"),
        F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name"),
        F.lit(None).cast("string").alias("gender"),
        F.date_add(F.lit("1970-01-01").cast("date"), (k % 15000).cast("int")).alias("date_of_birth"),
        F.col("phone_raw").alias("phone_number"), F.col("email_raw").alias("email"),
        F.col("c_mktsegment").alias("membership_type_name"),
        F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("is_premium_member"),
        F.date_add(F.lit("2020-01-01").cast("date"), (k % 1000).cast("int")).alias("member_since"),
        F.timestamp_add("HOUR", k, F.lit("2024-01-01").cast("timestamp")).alias("created_at"),
    )


@register("stg_members_keys", f"""
WITH {ORGS_SQL.strip()},{CONTACTS_SQL},
m AS (
  SELECT CASE WHEN c.c_custkey % 3 = 0 THEN 'NATION_' ELSE 'nation_' END || CAST(c.c_nationkey AS VARCHAR) AS client_code,
         CAST(c.c_custkey AS VARCHAR) AS member_id, c.c_name AS first_name, c.c_mktsegment AS last_name,
         CAST(NULL AS VARCHAR) AS gender,
         DATE '1970-01-01' + CAST(c.c_custkey % 15000 AS INTEGER) AS date_of_birth,
         k.phone_raw AS phone_number, k.email_raw AS email, c.c_mktsegment AS membership_type_name,
         CASE WHEN c.c_acctbal > 0 THEN 1 ELSE 0 END AS is_premium_member,
         DATE '2020-01-01' + CAST(c.c_custkey % 1000 AS INTEGER) AS member_since,
         TIMESTAMP '2024-01-01' + to_hours(c.c_custkey) AS created_at
  FROM customer c JOIN contacts k ON c.c_custkey = k.c_custkey
)
SELECT md5(concat_ws('||', coalesce(o.source_system_code, m.client_code), m.client_code, m.member_id)) AS member_pk,
       m.client_code, m.member_id AS external_member_id, m.first_name, m.last_name, m.gender,
       m.date_of_birth AS birthday, {phone_model_sql('m.phone_number')} AS phone,
       {email_model_sql('m.email')} AS email, m.membership_type_name, m.is_premium_member, m.member_since,
       m.created_at, coalesce(o.source_system_code, m.client_code) AS reservation_system_code
FROM m LEFT JOIN orgs o ON lower(m.client_code) = o.client_code""")
def stg_members_keys(spark, sf_dir):
    """P3 + P8: member dimension with keys and model-rule contacts."""
    orgs = P.stg_organizations(organizations_view(spark, sf_dir))
    return P.dim_members(P.stg_members(members_raw_view(spark, sf_dir), orgs))


def reservations_raw_view(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    return o.select(
        F.concat(F.when(k % 2 == 0, F.lit("NATION_")).otherwise(F.lit("nation_")),
                 (F.col("o_custkey") % 25).cast("string")).alias("client_code"),
        F.when(k % 10 != 0, k.cast("string")).alias("reservation_id"),
        F.when(k % 20 != 0, F.col("o_orderpriority")).alias("event_id"),
        F.col("o_custkey").cast("string").alias("member_id"),
        d.alias("reservation_created_at"),
        F.timestamp_add("HOUR", k % 48, d).alias("reservation_updated_at"),
        F.timestamp_add("SECOND", k % 86400, d).alias("reservation_start_at"),
        F.timestamp_add("SECOND", k % 86400 + 5400, d).alias("reservation_end_at"),
        F.when(F.col("o_orderstatus") == "P", d).alias("reservation_cancelled_at"),
        F.timestamp_add("DAY", F.lit(1), d).alias("created_at"),
    )


def _pg_text_sql(x):
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S') || '+00'"


@register("stg_union_tenant", f"""
WITH {ORGS_SQL.strip()},
r AS (
  SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'NATION_' ELSE 'nation_' END || CAST(o_custkey % 25 AS VARCHAR) AS client_code,
         CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS reservation_id,
         CASE WHEN o_orderkey % 20 <> 0 THEN o_orderpriority END AS event_id,
         CAST(o_custkey AS VARCHAR) AS member_id,
         o_orderdate AS reservation_created_at,
         o_orderdate + to_hours(CAST(o_orderkey % 48 AS BIGINT)) AS reservation_updated_at,
         o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS reservation_start_at,
         o_orderdate + to_seconds(CAST(o_orderkey % 86400 + 5400 AS BIGINT)) AS reservation_end_at,
         o_orderdate + INTERVAL 1 DAY AS created_at
  FROM orders
),
a AS (
  SELECT md5(concat_ws('||', 'courtreserve', r.client_code, coalesce(r.reservation_id, r.event_id, r.member_id),
                       coalesce({_pg_text_sql('r.reservation_start_at')}, ''))) AS reservation_pk,
         'courtreserve' AS source_system_code, r.*
  FROM r JOIN orgs o ON lower(r.client_code) = o.client_code WHERE o.source_system_code = 'courtreserve'
),
b AS (
  SELECT md5(concat_ws('||', 'podplay', r.client_code, coalesce(r.reservation_id, r.event_id),
                       coalesce({_pg_text_sql('r.reservation_start_at')}, ''))) AS reservation_pk,
         'podplay' AS source_system_code, r.*
  FROM r JOIN orgs o ON lower(r.client_code) = o.client_code WHERE o.source_system_code = 'podplay'
),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT u.reservation_pk, u.client_code, coalesce(o.source_system_code, u.source_system_code) AS reservation_system_code,
       u.source_system_code, u.reservation_id, u.event_id, u.member_id, u.reservation_created_at,
       u.reservation_updated_at, u.reservation_start_at, u.reservation_end_at, u.created_at AS ingested_at
FROM u LEFT JOIN orgs o ON u.client_code = o.client_code""")
def stg_union_tenant(spark, sf_dir):
    """P4–P6 + P9: reservations of both systems with keys and system code."""
    orgs = P.stg_organizations(organizations_view(spark, sf_dir))
    return P.fct_reservations(P.stg_reservations(reservations_raw_view(spark, sf_dir), orgs))


MART_FILES = 32


@register("mart_clustered", ORACLE_SQL["stg_union_tenant"])
def mart_clustered(spark, sf_dir):
    """The reservation mart written in ranges of (tenant, start) and read back."""
    path = os.path.join(job_dir(spark, "mart_clustered"), "fct_reservations")
    write_clustered(stg_union_tenant(spark, sf_dir), path, ["client_code", "reservation_start_at"], MART_FILES)
    return spark.read.parquet(path)


# Fixed test vocabulary: raw event types by props k % 8.
RAW_EVENT_TYPES = ["ADULT_CLASS", " drop-in ", "League Night", "Party", "Private Event", "Social", "OPEN_PLAY", None]


def events_raw_view(spark, sf_dir) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    k = F.from_json("props", "k BIGINT")["k"]
    etype = None
    for i, t in enumerate(RAW_EVENT_TYPES):
        v = F.lit(t).cast("string")
        etype = F.when(k % 8 == i, v) if etype is None else etype.when(k % 8 == i, v)
    return e.select(
        F.concat(F.lit("nation_"), (F.col("user_id") % 25).cast("string")).alias("client_code"),
        F.when(F.col("event_type").isin("click", "view"), "podplay").otherwise("courtreserve").alias("source_system"),
        F.col("event_id").cast("string").alias("event_id"),
        _vocab_col(k, TITLE_SUFFIXES).alias("event_name"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Session "), k.cast("string"))).alias("event_description"),
        etype.alias("event_type"),
        F.col("ts").alias("event_start_time"),
        F.timestamp_add("MINUTE", F.round("value").cast("bigint"), F.col("ts")).alias("event_end_time"),
        (k % 20).cast("int").alias("num_registrants"),
        F.when(F.col("user_id") % 7 != 0, F.lit(10)).cast("int").alias("max_registrants"),
        F.col("value").alias("admission_rate_regular"),
        (F.col("value") * 0.8).alias("admission_rate_member"),
        F.col("ts").alias("created_at"),
    )


def _raw_types_sql(k: str) -> str:
    parts = []
    for i, t in enumerate(RAW_EVENT_TYPES):
        parts.append(f"WHEN {k} % 8 = {i} THEN " + ("NULL" if t is None else f"'{t}'"))
    return "CASE " + " ".join(parts) + " END"


EVENTS_RAW_SQL = f"""
er AS (
  SELECT 'nation_' || CAST(user_id % 25 AS VARCHAR) AS client_code,
         CASE WHEN event_type IN ('click', 'view') THEN 'podplay' ELSE 'courtreserve' END AS source_system,
         CAST(event_id AS VARCHAR) AS event_id,
         {_vocab_sql("CAST(json_extract(props, '$.k') AS BIGINT)", TITLE_SUFFIXES)} AS event_name,
         CASE WHEN event_type = 'error' THEN NULL
              ELSE 'Session ' || CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) END AS event_description,
         {_raw_types_sql("CAST(json_extract(props, '$.k') AS BIGINT)")} AS event_type,
         ts AS event_start_time, ts + to_minutes(CAST(round(value) AS BIGINT)) AS event_end_time,
         CAST(CAST(json_extract(props, '$.k') AS BIGINT) % 20 AS INTEGER) AS num_registrants,
         CASE WHEN user_id % 7 <> 0 THEN 10 END AS max_registrants,
         value AS admission_rate_regular, value * 0.8 AS admission_rate_member, ts AS created_at
  FROM events
)"""


@register("fct_events_mapped", f"""
WITH {EVENTS_RAW_SQL.strip()}
SELECT md5(concat_ws('||', coalesce(client_code, ''), coalesce(event_id, ''), coalesce(source_system, ''),
                     coalesce(strftime(event_start_time, '%Y-%m-%d %H:%M:%S')
                       || CASE WHEN microsecond(event_start_time) % 1000000 = 0 THEN ''
                               ELSE '.' || rtrim(lpad(CAST(microsecond(event_start_time) % 1000000 AS VARCHAR), 6, '0'), '0') END
                       || '+00', ''))) AS event_pk,
       client_code, source_system, event_id, event_name, event_description, event_type AS event_type_original,
       CASE WHEN upper(trim(event_type)) IN ('ADULT_CLASS', 'PKLYN ACADEMY', 'PKLYN SPECIAL EVENTS', 'CLASSES') THEN 'Class'
            WHEN upper(trim(event_type)) IN ('OPEN_PLAY', 'DROP-IN', 'DROPIN') THEN 'Open Play'
            WHEN upper(trim(event_type)) IN ('COMPETE', 'LEAGUE NIGHT', 'TOURNAMENT') THEN 'Compete'
            ELSE event_type END AS event_type,
       {R.skill_level_sql('event_name')} AS skill_level,
       event_start_time, event_end_time, num_registrants, max_registrants,
       coalesce(num_registrants >= max_registrants, false) AS is_full,
       admission_rate_regular, admission_rate_member, created_at
FROM er
WHERE upper(trim(event_type)) NOT IN ('PARTY', 'PRIVATE EVENT', 'PRIVATEEVENT')""")
def fct_events_mapped(spark, sf_dir):
    """P10 + C23 + C24 + C25 + F1: events mart with in-pipeline skill level."""
    return P.fct_events(P.classify_events(events_raw_view(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Quality (D1–D3, A5–A9)
# ---------------------------------------------------------------------------


def quality_specs(spark, sf_dir):
    t = {n: read_table(spark, sf_dir, n) for n in ("customer", "orders", "lineitem", "part", "supplier", "nation")}
    return [
        Q.TableChecks("customer", t["customer"], unique=["c_custkey"], not_null=["c_custkey", "c_name"],
                      relationships=[("c_nationkey", "nation", "n_nationkey")]),
        Q.TableChecks("orders", t["orders"], unique=["o_orderkey", "o_custkey"],
                      not_null=["o_orderkey", "o_custkey", "o_orderdate"],
                      relationships=[("o_custkey", "customer", "c_custkey")]),
        Q.TableChecks("lineitem", t["lineitem"], unique=["l_orderkey"],
                      not_null=["l_orderkey", "l_partkey", "l_shipdate"],
                      relationships=[("l_orderkey", "orders", "o_orderkey"), ("l_partkey", "part", "p_partkey"),
                                     ("l_suppkey", "supplier", "s_suppkey")]),
        Q.TableChecks("part", t["part"], unique=["p_partkey", "p_name"], not_null=["p_partkey", "p_name"]),
        Q.TableChecks("supplier", t["supplier"], unique=["s_suppkey"], not_null=["s_suppkey"],
                      relationships=[("s_nationkey", "nation", "n_nationkey")]),
        Q.TableChecks("nation", t["nation"], unique=["n_nationkey", "n_name"], not_null=["n_name"]),
    ]


def _quality_sql():
    parts = []
    for s in [("customer", ["c_custkey"], ["c_custkey", "c_name"], [("c_nationkey", "nation", "n_nationkey")]),
              ("orders", ["o_orderkey", "o_custkey"], ["o_orderkey", "o_custkey", "o_orderdate"],
               [("o_custkey", "customer", "c_custkey")]),
              ("lineitem", ["l_orderkey"], ["l_orderkey", "l_partkey", "l_shipdate"],
               [("l_orderkey", "orders", "o_orderkey"), ("l_partkey", "part", "p_partkey"),
                ("l_suppkey", "supplier", "s_suppkey")]),
              ("part", ["p_partkey", "p_name"], ["p_partkey", "p_name"], []),
              ("supplier", ["s_suppkey"], ["s_suppkey"], [("s_nationkey", "nation", "n_nationkey")]),
              ("nation", ["n_nationkey", "n_name"], ["n_name"], [])]:
        name, uniq, nn, rel = s
        for c in nn:
            parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, 'not_null' AS check_name, "
                         f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failing_rows FROM {name}")
        for c in uniq:
            parts.append(f"SELECT '{name}', '{c}', 'unique', CAST(count(*) AS BIGINT) FROM "
                         f"(SELECT {c} FROM {name} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
        for c, parent, pc in rel:
            parts.append(f"SELECT '{name}', '{c}', 'relationships:{parent}.{pc}', CAST(count(*) AS BIGINT) "
                         f"FROM {name} x WHERE x.{c} IS NOT NULL AND NOT EXISTS "
                         f"(SELECT 1 FROM {parent} p WHERE p.{pc} = x.{c})")
    return "\nUNION ALL\n".join(parts)


@register("quality_checks", _quality_sql())
def quality_checks(spark, sf_dir):
    """Unique, not_null and relationships checks over six tables."""
    return Q.run_checks(quality_specs(spark, sf_dir))


@register("duplicate_keys", """
SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1
ORDER BY n_rows DESC, l_orderkey LIMIT 10""")
def duplicate_keys(spark, sf_dir):
    """A5: the ten most repeated keys (the report size is the feature)."""
    return Q.duplicate_keys(read_table(spark, sf_dir, "lineitem"), ["l_orderkey"], limit=10)


@register("duplicate_report", """
SELECT o.o_custkey, o.o_orderpriority, o.o_orderkey, o.o_orderdate, d.n_rows
FROM orders o JOIN (SELECT o_custkey, o_orderpriority, count(*) AS n_rows FROM orders
                    GROUP BY o_custkey, o_orderpriority HAVING count(*) > 1) d
  ON o.o_custkey = d.o_custkey AND o.o_orderpriority = d.o_orderpriority""")
def duplicate_report(spark, sf_dir):
    """Every row of a duplicated key, with the key's row count."""
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderkey", "o_orderdate")
    return Q.duplicate_report(o, ["o_custkey", "o_orderpriority"])


@register("booking_span", f"""
WITH {MQ.BOOKINGS_SQL.strip()}
SELECT client_code, min(reservation_start_at) AS min_reservation_start_at,
       max(reservation_start_at) AS max_reservation_start_at, count(*) AS rows
FROM bookings GROUP BY client_code""")
def booking_span(spark, sf_dir):
    """Earliest / latest start per tenant."""
    return Q.min_max(MQ.bookings_view(spark, sf_dir), "reservation_start_at", ["client_code"])


@register("load_audit", f"""
WITH {MQ.BOOKINGS_SQL.strip()},{MQ.PROD_SQL},
w5 AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY client_code, reservation_id, member_id
                               ORDER BY {MQ._LATEST_ORDER}) AS rn FROM batch) WHERE rn = 1),
w1 AS (SELECT * EXCLUDE (rn2) FROM (
  SELECT *, row_number() OVER (PARTITION BY client_code, event_id, reservation_start_at, reservation_created_at, member_id
                               ORDER BY reservation_updated_at DESC NULLS LAST, created_at DESC, _pos) AS rn2
  FROM w5) WHERE rn2 = 1),
fresh AS (SELECT * FROM w1 b WHERE NOT EXISTS (
  SELECT 1 FROM production p
  WHERE b.client_code IS NOT DISTINCT FROM p.client_code AND b.event_id IS NOT DISTINCT FROM p.event_id
    AND b.reservation_start_at IS NOT DISTINCT FROM p.reservation_start_at
    AND b.reservation_created_at IS NOT DISTINCT FROM p.reservation_created_at
    AND b.member_id IS NOT DISTINCT FROM p.member_id))
SELECT 'incoming' AS step, count(*) AS rows FROM batch
UNION ALL SELECT 'batch_dedupe', count(*) FROM w5
UNION ALL SELECT 'stage_dedupe', count(*) FROM w1
UNION ALL SELECT 'new_vs_production', count(*) FROM fresh
UNION ALL SELECT 'production_before', count(*) FROM production""")
def load_audit(spark, sf_dir):
    """Row counts before/after each load step."""
    b = MQ.bookings_view(spark, sf_dir)
    batch = MQ._batch(b)
    prod = MQ._production(b)
    w5 = M.dedupe_latest(batch, M.RES_BATCH_KEY, "reservation_updated_at", "_pos")
    w1 = M.stage_dedupe(w5, M.RES_STAGE_KEY, "reservation_updated_at", "created_at", tie="_pos")
    fresh = M.anti_existing(w1, prod, M.RES_STAGE_KEY, null_safe=True)
    return M.audit_counts({"incoming": batch, "batch_dedupe": w5, "stage_dedupe": w1,
                           "new_vs_production": fresh, "production_before": prod})


# ---------------------------------------------------------------------------
# Watermarks and windows
# ---------------------------------------------------------------------------
NOW = "2001-09-01"


def _resolved(spark, sf_dir):
    b = MQ.bookings_view(spark, sf_dir)
    prod = MQ._production(b)
    wm = prod.groupBy(T.source_name("reservations", F.col("client_code")).alias("source_name")).agg(
        F.max("created_at").alias("last_loaded_at"))
    roster = b.select(T.source_name("reservations", F.col("client_code")).alias("source_name")).unionByName(
        read_table(spark, sf_dir, "nation").select(
            T.source_name("reservations", F.lower("n_name")).alias("source_name")))
    return b, T.resolve(wm, roster, NOW)


RESOLVED_SQL = f"""
wm AS (SELECT 'reservations__' || client_code AS source_name, max(created_at) AS last_loaded_at
       FROM production GROUP BY client_code),
roster AS (SELECT DISTINCT source_name FROM (
  SELECT 'reservations__' || client_code AS source_name FROM bookings
  UNION ALL SELECT 'reservations__' || lower(n_name) FROM nation)),
resolved AS (
  SELECT r.source_name, coalesce(w.last_loaded_at, TIMESTAMP '{NOW}' - INTERVAL 30 DAY) AS watermark
  FROM roster r LEFT JOIN wm w ON r.source_name = w.source_name)"""


@register("watermark_resolve", f"""
WITH {MQ.BOOKINGS_SQL.strip()},{MQ.PROD_SQL},{RESOLVED_SQL}
SELECT source_name, watermark FROM resolved""")
def watermark_resolve(spark, sf_dir):
    """Last load per source, else now - 30 days."""
    return _resolved(spark, sf_dir)[1]


@register("incremental_window", f"""
WITH {MQ.BOOKINGS_SQL.strip()},{MQ.PROD_SQL},{RESOLVED_SQL}
SELECT {MQ._BCOLS}, b._pos FROM bookings b JOIN resolved r ON 'reservations__' || b.client_code = r.source_name
WHERE b.reservation_start_at >= date_trunc('day', r.watermark) AND b.reservation_start_at <= TIMESTAMP '{NOW}'""")
def incremental_window(spark, sf_dir):
    """Rows since midnight of the watermark day, up to now."""
    b, r = _resolved(spark, sf_dir)
    return T.incremental(b, r, "reservation_start_at", T.source_name("reservations", F.col("client_code")),
                         overlap="midnight", until=NOW)


@register("load_windows", f"""
WITH {MQ.BOOKINGS_SQL.strip()},{MQ.PROD_SQL},{RESOLVED_SQL},
win AS (
  SELECT source_name, ws AS window_start, least(ws + INTERVAL 7 DAY, TIMESTAMP '{NOW}') AS window_end
  FROM resolved, unnest(generate_series(watermark, TIMESTAMP '{NOW}', INTERVAL 7 DAY)) u(ws)
  WHERE ws < TIMESTAMP '{NOW}'
)
SELECT w.source_name, w.window_start, w.window_end, count(b._pos) AS n_records
FROM win w LEFT JOIN bookings b ON 'reservations__' || b.client_code = w.source_name
  AND b.reservation_start_at >= w.window_start AND b.reservation_start_at <= w.window_end
GROUP BY w.source_name, w.window_start, w.window_end""")
def load_windows(spark, sf_dir):
    """7-day load windows from the watermark to now, with the records
    each window fetches (shared edges count in both)."""
    b, r = _resolved(spark, sf_dir)
    wins = T.load_windows(r, NOW, 7)
    assigned = T.assign_windows(b, r, "reservation_start_at", T.source_name("reservations", F.col("client_code")),
                                NOW, 7)
    counts = assigned.groupBy(T.source_name("reservations", F.col("client_code")).alias("source_name"),
                              "window_start").agg(F.count(F.lit(1)).alias("n_records"))
    return wins.join(counts, ["source_name", "window_start"], "left").select(
        "source_name", "window_start", "window_end",
        F.coalesce("n_records", F.lit(0)).cast("bigint").alias("n_records"))
