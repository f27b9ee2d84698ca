"""Catalogue: payload normalisers (N1–N20) over JSON built from the tables.

Each query turns every row of a driver table into one API record as JSON
text (the landed form, S1), parses it back with the payload schema and
runs the normaliser.  No grouping is used to build payloads — nested
lists are made per row — so the fixture adds no shuffle of its own.  The
DuckDB oracle computes the expected rows straight from the table columns,
which checks the JSON round trip and the normaliser together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources import payloads as PL
from ..sources import places as PLC
from ..sources import system_a as A
from ..sources import system_b as B
from ..sources.tables import read_table
from .model_queries import CONTACTS_SQL, contacts_view, email_ingest_sql, phone_ingest_sql
from .registry import local_to_utc_sql, register


def _txt(ts: Column, fmt: str = "yyyy-MM-dd'T'HH:mm:ss") -> Column:
    return F.date_format(ts, fmt)


def _txt_sql(x: str, fmt: str = "%Y-%m-%dT%H:%M:%S") -> str:
    return f"strftime({x}, '{fmt}')"


def _ny_sql(wall: str) -> str:
    return local_to_utc_sql(wall, "'America/New_York'")


def _parse(df: DataFrame, schema: str, keep=("client_code",)) -> DataFrame:
    return PL.parse_records(df, "payload", schema, keep=keep)


def _lineitem(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", spread_scan=True)
    return li.withColumn("_start", F.timestamp_add("HOUR", F.col("l_linenumber"), F.col("l_shipdate")))


# ---------------------------------------------------------------------------
# N1 + N2: system-A reservations
# ---------------------------------------------------------------------------
A_RES_TYPE = {"A": "Court Reservation", "N": " Court Reservation ", "R": "Lesson"}


def _a_res_payload(spark, sf_dir) -> DataFrame:
    li = _lineitem(spark, sf_dir)
    st = F.col("_start")
    rtype = (F.when(F.col("l_returnflag") == "A", A_RES_TYPE["A"])
             .when(F.col("l_returnflag") == "N", A_RES_TYPE["N"]).otherwise(A_RES_TYPE["R"]))
    player = "struct<OrganizationMemberId:bigint>"
    players = (F.when(F.col("l_linenumber") % 4 == 0, F.lit(None).cast(f"array<{player}>"))
               .when(F.col("l_linenumber") % 4 == 1, F.array().cast(f"array<{player}>"))
               .otherwise(F.array(F.struct(F.col("l_suppkey").alias("OrganizationMemberId")),
                                  F.struct(F.lit(None).cast("bigint").alias("OrganizationMemberId")))))
    rec = F.struct(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("Id"),
        (F.col("l_partkey") % 5).alias("ReservationTypeId"),
        rtype.alias("ReservationTypeName"),
        _txt(st).alias("StartTime"),
        _txt(st + F.expr("INTERVAL 90 MINUTES")).alias("EndTime"),
        F.concat(_txt(st - F.expr("INTERVAL 2 DAYS")), F.lit("Z")).alias("CreatedOnUtc"),
        _txt(st - F.expr("INTERVAL 1 DAY")).alias("UpdatedOnUtc"),
        F.when(F.col("l_linestatus") == "F", F.concat(_txt(st - F.expr("INTERVAL 3 HOURS")), F.lit("Z")))
        .alias("CancelledOnUtc"),
        F.when(F.col("l_linenumber") == 3, _txt(st - F.expr("INTERVAL 5 HOURS"))).alias("CancelledOn"),
        F.concat(F.lit("Court #"), F.col("l_linenumber").cast("string")).alias("Courts"),
        players.alias("Players"),
    )
    return li.select(F.concat(F.lit("NATION_"), (F.col("l_suppkey") % 25).cast("string")).alias("client_code"),
                     F.to_json(rec).alias("payload"))


ORACLE_RES_A = f"""
WITH li AS (SELECT *, l_shipdate + to_hours(CAST(l_linenumber AS BIGINT)) AS st FROM lineitem),
p AS (SELECT li.*, u.m FROM li, unnest([l_suppkey, NULL]) u(m) WHERE l_linenumber % 4 IN (2, 3))
SELECT 'nation_' || CAST(l_suppkey % 25 AS VARCHAR) AS client_code,
       CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS reservation_id,
       CAST(l_partkey % 5 AS VARCHAR) AS event_id,
       st - INTERVAL 2 DAY AS reservation_created_at,
       st - INTERVAL 1 DAY AS reservation_updated_at,
       {_ny_sql('st')} AS reservation_start_at,
       {_ny_sql('st + INTERVAL 90 MINUTE')} AS reservation_end_at,
       CASE WHEN l_linestatus = 'F' THEN st - INTERVAL 3 HOUR
            WHEN l_linenumber = 3 THEN st - INTERVAL 5 HOUR END AS reservation_cancelled_at,
       CAST(m AS VARCHAR) AS member_id, CAST(m AS VARCHAR) AS club_member_key
FROM p WHERE l_returnflag IN ('A', 'N')"""


@register("json_reservations_a", ORACLE_RES_A)
def json_reservations_a(spark, sf_dir):
    """N1 + N2 + C6: court reservations fanned out per player."""
    recs = _parse(_a_res_payload(spark, sf_dir), PL.A_RESERVATION)
    return A.normalize_reservations(recs)


# ---------------------------------------------------------------------------
# System-A cancellations
# ---------------------------------------------------------------------------
ORACLE_CANCEL_A = f"""
WITH o AS (SELECT *, o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS st FROM orders)
SELECT 'nation_' || CAST(o_custkey % 25 AS VARCHAR) AS client_code, 'courtreserve' AS source_system,
       CAST(o_custkey % 97 AS VARCHAR) AS event_id, CAST(o_orderkey AS VARCHAR) AS reservation_id,
       CAST(o_custkey AS VARCHAR) AS member_id, o_orderpriority AS reservation_type,
       st - INTERVAL 7 DAY AS reservation_created_at, {_ny_sql('st')} AS reservation_start_at,
       {_ny_sql('st + INTERVAL 1 HOUR')} AS reservation_end_at,
       CASE WHEN o_orderstatus = 'F' THEN st - INTERVAL 1 DAY END AS cancelled_on,
       dayname({_ny_sql('st')}) AS day_of_week, true AS is_program, 'Program ' || o_orderstatus AS program_name,
       concat_ws(' ', CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'First' || CAST(o_custkey AS VARCHAR) END,
                      CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'Last' END) AS player_name,
       CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'First' || CAST(o_custkey AS VARCHAR) END AS player_first_name,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'Last' END AS player_last_name,
       'p' || CAST(o_custkey AS VARCHAR) || '@mail.org' AS player_email, CAST(NULL AS VARCHAR) AS player_phone,
       o_totalprice AS fee, o_orderstatus = 'O' AS is_team_event,
       o_orderpriority AS event_category_name, o_custkey % 7 AS event_category_id
FROM o"""


@register("json_cancellations_a", ORACLE_CANCEL_A)
def json_cancellations_a(spark, sf_dir):
    """Cancellation rows with weekday and player name."""
    o = read_table(spark, sf_dir, "orders", spread_scan=True)
    st = F.timestamp_add("MINUTE", F.col("o_orderkey") % 1440, F.col("o_orderdate"))
    k = F.col("o_orderkey")
    rec = F.struct(
        (F.col("o_custkey") % 97).alias("EventId"), k.alias("EventDateId"),
        F.col("o_custkey").alias("OrganizationMemberId"),
        _txt(st).alias("StartTime"), _txt(st + F.expr("INTERVAL 1 HOUR")).alias("EndTime"),
        F.concat(_txt(st - F.expr("INTERVAL 7 DAYS")), F.lit("Z")).alias("SignedUpOnUtc"),
        F.when(F.col("o_orderstatus") == "F", _txt(st - F.expr("INTERVAL 1 DAY"))).alias("CancelledOnUtc"),
        F.lit(None).cast("string").alias("CancelledOn"),
        F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("First"), F.col("o_custkey").cast("string")))
        .alias("FirstName"),
        F.when(k % 5 != 0, F.lit("Last")).alias("LastName"),
        F.concat(F.lit("p"), F.col("o_custkey").cast("string"), F.lit("@mail.org")).alias("Email"),
        F.lit(None).cast("string").alias("Phone"),
        F.concat(F.lit("Program "), F.col("o_orderstatus")).alias("EventName"),
        F.col("o_orderpriority").alias("EventCategoryName"),
        (F.col("o_custkey") % 7).alias("EventCategoryId"),
        F.col("o_totalprice").alias("PriceToPay"),
        (F.col("o_orderstatus") == "O").alias("IsTeamEvent"),
    )
    src = o.select(F.concat(F.lit("nation_"), (F.col("o_custkey") % 25).cast("string")).alias("client_code"),
                   F.to_json(rec).alias("payload"))
    return A.normalize_cancellations(_parse(src, PL.A_CANCELLATION))


# ---------------------------------------------------------------------------
# Members of both systems
# ---------------------------------------------------------------------------
@register("json_members_a", f"""
WITH {CONTACTS_SQL.strip()},
c AS (SELECT cu.*, k.phone_raw, k.email_raw FROM customer cu JOIN contacts k ON cu.c_custkey = k.c_custkey),
m AS (
  SELECT c.*,
    CASE WHEN c_custkey % 10 = 0 OR c_custkey % 15 = 0 THEN 'Staff'
         WHEN c_custkey % 4 = 0 OR c_mktsegment = '' THEN 'Non-Member Account'
         ELSE c_mktsegment END AS mt,
    CASE WHEN c_custkey % 5 = 0 OR phone_raw = '' THEN lpad(CAST(c_custkey AS VARCHAR), 10, '6') ELSE phone_raw END AS ph
  FROM c
)
SELECT 'nation_' || CAST(c_nationkey AS VARCHAR) AS client_code,
       CAST(c_custkey AS VARCHAR) AS member_id, CAST(c_custkey AS VARCHAR) AS club_member_key,
       c_name AS first_name, c_mktsegment AS last_name, CAST(NULL AS VARCHAR) AS gender,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE DATE '1970-01-01' + CAST(c_custkey % 15000 AS INTEGER) END AS date_of_birth,
       {email_ingest_sql('email_raw')} AS email,
       {phone_ingest_sql('ph')} AS phone_number,
       mt AS membership_type_name, CASE WHEN mt <> 'Non-Member Account' THEN 1 ELSE 0 END AS is_premium_member,
       DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS member_since
FROM m""")
def json_members_a(spark, sf_dir):
    """System-A members with ingest-rule contacts and membership flags."""
    c = read_table(spark, sf_dir, "customer", spread_scan=True).join(contacts_view(spark, sf_dir), "c_custkey")
    k = F.col("c_custkey")
    dob = F.date_add(F.lit("1970-01-01").cast("date"), (k % 15000).cast("int"))
    rec = F.struct(
        k.cast("string").alias("MembershipNumber"), F.col("c_name").alias("FirstName"),
        F.col("c_mktsegment").alias("LastName"), F.lit(None).cast("string").alias("Gender"),
        F.when(k % 7 == 0, F.lit("31/12/1990"))
        .when(k % 2 == 0, F.concat(F.date_format(dob, "yyyy-MM-dd"), F.lit("T23:30:00-05:00")))
        .otherwise(F.date_format(dob, "yyyy-MM-dd")).alias("DateOfBirth"),
        F.col("email_raw").alias("Email"),
        F.when(k % 5 == 0, F.lit("")).otherwise(F.col("phone_raw")).alias("PhoneNumber"),
        F.lpad(k.cast("string"), 10, "6").alias("MobilePhone"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("MembershipTypeName"),
        F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (k % 1000).cast("int")), "yyyy-MM-dd")
        .alias("MembershipStartDate"),
        F.when(k % 10 == 0, F.lit(True)).alias("Staff"),
        F.when(k % 15 == 0, F.lit(True)).when(k % 2 == 1, F.lit(False)).alias("IsStaff"),
    )
    src = c.select(F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("client_code"),
                   F.to_json(rec).alias("payload"))
    return A.normalize_members(_parse(src, PL.A_MEMBER)).drop("_file", "_pos")


@register("json_members_b", f"""
WITH {CONTACTS_SQL.strip()},
c AS (SELECT cu.*, k.phone_raw, k.email_raw FROM customer cu JOIN contacts k ON cu.c_custkey = k.c_custkey),
m AS (SELECT c.*, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE upper(c_mktsegment) END AS mt FROM c)
SELECT 'nation_' || CAST(c_nationkey AS VARCHAR) AS client_code,
       'u' || CAST(c_custkey AS VARCHAR) AS member_id, 'u' || CAST(c_custkey AS VARCHAR) AS club_member_key,
       c_name AS first_name, c_mktsegment AS last_name, 'x' AS gender,
       CAST(TIMESTAMP '1980-01-01 20:00:00' + to_days(CAST(c_custkey % 9000 AS INTEGER)) + INTERVAL 5 HOUR AS DATE) AS date_of_birth,
       {email_ingest_sql('email_raw')} AS email,
       {phone_ingest_sql('phone_raw')} AS phone_number,
       coalesce(mt, 'NONE') AS membership_type_name, CASE WHEN coalesce(mt, 'NONE') <> 'NONE' THEN 1 ELSE 0 END AS is_premium_member,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE DATE '2021-06-01' + CAST(c_custkey % 500 AS INTEGER) END AS member_since,
       CASE WHEN c_custkey % 2 = 0 THEN 'm2' ELSE 'm1' END AS newest_membership_id
FROM m""")
def json_members_b(spark, sf_dir):
    """N5 + N6: system-B users; phone as text or object; newest membership."""
    c = read_table(spark, sf_dir, "customer", spread_scan=True).join(contacts_view(spark, sf_dir), "c_custkey")
    k = F.col("c_custkey")
    bday = F.timestamp_add("DAY", (k % 9000), F.lit("1980-01-01 20:00:00").cast("timestamp"))
    since = F.date_add(F.lit("2021-06-01").cast("date"), (k % 500).cast("int"))
    ms_t = "struct<createdAt:string,startedAt:string,membership:struct<id:string,createdAt:string>>"

    def ms(mid, created, started, mcreated):
        return F.struct(created.cast("string").alias("createdAt"), started.cast("string").alias("startedAt"),
                        F.struct(F.lit(mid).alias("id"), mcreated.cast("string").alias("createdAt"))
                        .alias("membership"))
    newer = F.when(k % 2 == 0, F.lit("2023-05-01T00:00:00Z")).otherwise(F.lit("2021-05-01T00:00:00Z"))
    items = F.array(
        ms("m1", F.lit(None), F.lit("2022-01-01T10:00:00"), F.lit(None)),
        ms("m2", F.lit(None), F.lit(None), newer),
    ).cast(f"array<{ms_t}>")
    common = [
        F.concat(F.lit("u"), k.cast("string")).alias("id"), F.col("c_name").alias("firstName"),
        F.col("c_mktsegment").alias("lastName"), F.lit("x").alias("gender"),
        F.concat(_txt(bday), F.lit("-05:00")).alias("birthday"), F.col("email_raw").alias("email"),
        F.when(k % 3 != 0, F.upper("c_mktsegment")).alias("membershipType"),
    ]
    tail = [F.struct(F.when(k % 4 != 0, F.date_format(since, "yyyy-MM-dd")).alias("memberSince")).alias("profile"),
            F.struct(items.alias("items")).alias("memberships")]
    as_text = F.to_json(F.struct(*common, F.col("phone_raw").alias("phoneNumber"), *tail))
    as_obj = F.to_json(F.struct(*common, F.struct(
        F.when(k % 4 == 1, F.lit("")).otherwise(F.col("phone_raw")).alias("phoneNumber"),
        F.col("phone_raw").alias("id")).alias("phoneNumber"), *tail))
    src = c.select(F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("client_code"),
                   F.when(k % 2 == 0, as_text).otherwise(as_obj).alias("payload"))
    out = B.normalize_members(_parse(src, PL.B_USER))
    return out.withColumn("newest_membership_id", F.col("newest_membership.membership.id")).drop(
        "newest_membership", "_file", "_pos")


# ---------------------------------------------------------------------------
# System-A events
# ---------------------------------------------------------------------------
_PRICE_T = "struct<MembershipTypeName:string,DailyPrice:double,EntireEventPrice:double>"


def _a_event_payload(spark, sf_dir) -> DataFrame:
    li = _lineitem(spark, sf_dir)
    ln = F.col("l_linenumber")
    st = F.col("_start")

    def price(t, daily, entire):
        return F.struct(F.lit(t).alias("MembershipTypeName"), daily.cast("double").alias("DailyPrice"),
                        entire.cast("double").alias("EntireEventPrice"))
    prices = F.array(
        price("Non-Member Account", F.col("l_quantity"),
              F.when(ln % 3 == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice") / 1000)),
        price("Premium", F.lit(None), F.col("l_extendedprice") / 2000),
        price("Founder", F.col("l_discount") * 100, F.col("l_tax") * 100),
        price("Non-Member Account", F.when(ln % 2 == 0, F.col("l_quantity") + 1), F.lit(None)),
    ).cast(f"array<{_PRICE_T}>")
    court_t = "struct<Id:bigint,Label:string,TypeName:string,OrderIndex:int>"

    def court(label):
        return F.struct(F.lit(None).cast("bigint").alias("Id"), label.alias("Label"),
                        F.lit(None).cast("string").alias("TypeName"), F.lit(None).cast("int").alias("OrderIndex"))
    courts = F.array(court(F.lit("Court #1")), court(F.concat(F.lit("  Court #"), ln.cast("string"), F.lit(" "))),
                     court(F.lit(""))).cast(f"array<{court_t}>")
    rec = F.struct(
        F.when(ln != 7, (F.col("l_orderkey") * 10 + ln).cast("string")).alias("Id"),
        F.when(ln % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("Event "), F.col("l_partkey").cast("string")))
        .alias("Name"),
        F.concat(F.lit("Named "), F.col("l_suppkey").cast("string")).alias("EventName"),
        (F.col("l_partkey") % 60).alias("EventCategoryId"),
        F.when(ln % 2 == 1, F.col("l_returnflag")).alias("CategoryName"),
        F.concat(F.lit("Type "), F.col("l_linestatus")).alias("EventType"),
        F.when(ln % 4 == 0, F.lit("America/Chicago")).when(ln % 4 == 1, F.lit("Not/AZone"))
        .when(ln % 4 == 2, F.lit("")).alias("TimeZone"),
        _txt(st).alias("StartDateTime"), _txt(st + F.expr("INTERVAL 2 HOURS")).alias("EndDateTime"),
        F.col("l_quantity").cast("int").cast("string").alias("RegisteredCount"),
        F.when(ln == 1, F.lit("n/a")).otherwise(F.lit("30")).alias("MaxRegistrants"),
        prices.alias("PriceInfo"), courts.alias("Courts"),
    )
    # Keys differing only by case ('id' next to 'Id') are written by one
    # to_json of a struct that holds both.
    rec = F.struct(*[rec[f] for f in _A_EVENT_FIELDS],
                   F.concat(F.lit("x"), F.col("l_orderkey").cast("string")).alias("id"),
                   F.when(ln % 4 == 2, F.lit("Europe/Paris")).alias("Timezone"))
    return li.select(F.concat(F.lit("nation_"), (F.col("l_suppkey") % 25).cast("string")).alias("client_code"),
                     F.to_json(rec).alias("payload"))


_A_EVENT_FIELDS = ["Id", "Name", "EventName", "EventCategoryId", "CategoryName", "EventType", "TimeZone",
                   "StartDateTime", "EndDateTime", "RegisteredCount", "MaxRegistrants", "PriceInfo", "Courts"]


def _categories(spark, sf_dir) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.groupBy("p_size").agg(F.min("p_type").alias("event_category_name")).select(
        F.concat(F.lit("nation_"), (F.col("p_size") % 25).cast("string")).alias("client_code"),
        F.lit("courtreserve").alias("source_system"), F.col("p_size").cast("bigint").alias("id"),
        "event_category_name")


@register("json_events_a", f"""
WITH li AS (SELECT *, l_shipdate + to_hours(CAST(l_linenumber AS BIGINT)) AS st FROM lineitem),
cat AS (SELECT 'nation_' || CAST(p_size % 25 AS VARCHAR) AS client_code, p_size AS id, min(p_type) AS name
        FROM part GROUP BY p_size),
e AS (
  SELECT li.*, 'nation_' || CAST(l_suppkey % 25 AS VARCHAR) AS client_code,
    CASE l_linenumber % 4 WHEN 0 THEN 'America/Chicago' WHEN 2 THEN 'Europe/Paris' ELSE 'America/New_York' END AS tz
  FROM li
),
pr AS (
  SELECT e.*,
    coalesce(nullif(CASE WHEN l_linenumber % 3 = 0 THEN 0.0 ELSE l_extendedprice / 1000 END, 0), l_quantity) AS p1,
    nullif(l_extendedprice / 2000, 0) AS p2,
    coalesce(nullif(l_tax * 100, 0), l_discount * 100) AS p3,
    CASE WHEN l_linenumber % 2 = 0 THEN l_quantity + 1 END AS p4
  FROM e
)
SELECT pr.client_code, 'courtreserve' AS source_system,
       CASE WHEN l_linenumber <> 7 THEN CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) ELSE 'x' || CAST(l_orderkey AS VARCHAR) END AS event_id,
       CASE WHEN l_linenumber % 3 = 0 THEN 'Named ' || CAST(l_suppkey AS VARCHAR) ELSE 'Event ' || CAST(l_partkey AS VARCHAR) END AS event_name,
       CAST(NULL AS VARCHAR) AS event_description,
       coalesce(nullif(cat.name, ''), CASE WHEN l_linenumber % 2 = 1 THEN l_returnflag END, 'Type ' || l_linestatus) AS event_type,
       {local_to_utc_sql('st', 'tz')} AS event_start_time,
       {local_to_utc_sql('st + INTERVAL 2 HOUR', 'tz')} AS event_end_time,
       CAST(CAST(l_quantity AS INTEGER) AS BIGINT) AS num_registrants,
       CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(30 AS BIGINT) END AS max_registrants,
       coalesce(p4, p1) AS admission_rate_regular,
       least(p2, p3) AS admission_rate_member,
       'Court #1|Court #' || CAST(l_linenumber AS VARCHAR) AS courts
FROM pr LEFT JOIN cat ON cat.client_code = pr.client_code AND cat.id = pr.l_partkey % 60""")
def json_events_a(spark, sf_dir):
    """N12 + N13 + N14 + N17 + C7: events with category lookup, prices,
    court labels and payload zones (unknown zone -> default)."""
    recs = PL.parse_records(_a_event_payload(spark, sf_dir), "payload", PL.A_EVENT, keep=("client_code",),
                            alt_schema=PL.A_EVENT_ALT)
    out = A.normalize_events(recs, _categories(spark, sf_dir), S.known_zone_names(spark))
    return out.withColumn("courts", F.array_join("courts", "|"))


# ---------------------------------------------------------------------------
# System-B events
# ---------------------------------------------------------------------------
@register("json_events_b", f"""
WITH o AS (SELECT *, o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS st FROM orders)
SELECT 'nation_' || CAST(o_custkey % 25 AS VARCHAR) AS client_code, 'podplay' AS source_system,
       'e' || CAST(o_orderkey AS VARCHAR) AS event_id,
       CASE WHEN o_orderkey % 4 = 0 THEN 'Title ' || o_orderpriority ELSE 'Event ' || CAST(o_orderkey AS VARCHAR) END AS event_name,
       CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'Line one' || chr(10) || 'Line two' END AS event_description,
       CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE upper(o_orderpriority) END AS event_type,
       CASE WHEN o_orderkey % 2 = 0 THEN {local_to_utc_sql('st', "'Europe/Berlin'")} ELSE st END AS event_start_time,
       CASE WHEN o_orderkey % 2 = 0 THEN {local_to_utc_sql('st + INTERVAL 2 HOUR', "'Europe/Berlin'")}
            ELSE st + INTERVAL 2 HOUR END AS event_end_time,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey % 40 AS BIGINT) END AS num_registrants,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(4 * (o_custkey % 10 + 1) AS BIGINT) END AS max_registrants,
       o_totalprice / 1000 AS admission_rate_regular,
       CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_totalprice / 2000 END AS admission_rate_member
FROM o WHERE o_orderkey % 11 <> 0""")
def json_events_b(spark, sf_dir):
    """System-B events; blank id skipped, payload zone or UTC, safe casts."""
    o = read_table(spark, sf_dir, "orders", spread_scan=True)
    k = F.col("o_orderkey")
    st = F.timestamp_add("MINUTE", k % 1440, F.col("o_orderdate"))
    rec = F.struct(
        F.when(k % 11 != 0, F.concat(F.lit("e"), k.cast("string"))).otherwise(F.lit("")).alias("id"),
        F.lit("REGULAR").alias("type"),
        F.when(k % 6 != 0, F.upper("o_orderpriority")).alias("subtype"),
        F.when(k % 4 != 0, F.concat(F.lit("Event "), k.cast("string"))).alias("name"),
        F.concat(F.lit("Title "), F.col("o_orderpriority")).alias("title"),
        F.when(k % 5 != 0, F.lit("Line one\nLine two")).alias("description"),
        _txt(st).alias("startTime"), _txt(st + F.expr("INTERVAL 2 HOURS")).alias("endTime"),
        F.when(k % 2 == 0, F.lit("Europe/Berlin")).when(k % 3 == 0, F.lit("Bad/Zone")).alias("timezone"),
        F.when(k % 9 != 0, F.lit("4")).otherwise(F.lit("four")).alias("teamSize"),
        ((F.col("o_custkey") % 10) + 1).cast("string").alias("totalTeams"),
        F.struct(F.when(k % 7 != 0, (F.col("o_custkey") % 40).cast("string")).alias("_total")).alias("signups"),
        F.struct((F.col("o_totalprice") / 1000).cast("string").alias("regular"),
                 F.when(k % 8 != 0, (F.col("o_totalprice") / 2000).cast("string")).otherwise(F.lit("free"))
                 .alias("member")).alias("admissionRate"),
    )
    src = o.select(F.concat(F.lit("nation_"), (F.col("o_custkey") % 25).cast("string")).alias("client_code"),
                   F.to_json(rec).alias("payload"))
    return B.normalize_events(_parse(src, PL.B_EVENT), S.known_zone_names(spark))


# ---------------------------------------------------------------------------
# System-B reservations and participants
# ---------------------------------------------------------------------------
_PERSON = ("struct<id:string,email:string,phoneNumber:string,firstName:string,lastName:string,"
           "displayName:string,fullName:string>")


def _person(id_=None, email=None, phone=None, first=None, last=None, display=None):
    def s(x):
        return (x if isinstance(x, Column) else F.lit(x)).cast("string")
    return F.struct(s(id_).alias("id"), s(email).alias("email"), s(phone).alias("phoneNumber"),
                    s(first).alias("firstName"), s(last).alias("lastName"), s(display).alias("displayName"),
                    F.lit(None).cast("string").alias("fullName"))


@register("json_participants", f"""
WITH li AS (SELECT *, l_shipdate + to_hours(CAST(l_linenumber AS BIGINT)) AS st FROM lineitem
            WHERE l_returnflag <> 'R'),
cand AS (
  SELECT li.*, 'u' || CAST(l_suppkey AS VARCHAR) AS pid FROM li
  UNION ALL SELECT li.*, 'e' || CAST(l_partkey % 30 AS VARCHAR) || '@x.org' FROM li
  UNION ALL SELECT li.*, CASE l_linenumber % 3 WHEN 1 THEN 'u' || CAST(l_suppkey AS VARCHAR)
      ELSE 'b' || CAST(l_partkey % 40 AS VARCHAR) END FROM li
)
SELECT DISTINCT 'nation_' || CAST(l_suppkey % 25 AS VARCHAR) AS client_code,
       CASE WHEN l_linenumber % 2 = 0 THEN 'c' || CAST(l_linenumber AS VARCHAR) ELSE 'r' || CAST(l_orderkey AS VARCHAR) END AS reservation_id,
       'ev' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS event_id,
       pid AS member_id,
       st - INTERVAL 3 DAY AS reservation_created_at,
       CASE WHEN l_linenumber % 2 = 1 THEN st - INTERVAL 3 DAY ELSE st - INTERVAL 1 DAY END AS reservation_updated_at,
       CASE WHEN l_linenumber % 3 = 0 THEN st - INTERVAL 30 MINUTE ELSE st END AS reservation_start_at,
       st + INTERVAL 1 HOUR AS reservation_end_at,
       CASE WHEN l_linestatus = 'F' THEN st - INTERVAL 2 HOUR END AS reservation_cancelled_at
FROM cand""")
def json_participants(spark, sf_dir):
    """N7 + N8 + N9: REGULAR events -> reservations -> participants (declined
    skipped, ids stripped, first-seen order, booker appended if absent)."""
    li = _lineitem(spark, sf_dir)
    ln = F.col("l_linenumber")
    st = F.col("_start")
    inv_t = ("struct<status:string,inviteeProfile:struct<id:string>,"
             "invitee:struct<email:string,phoneNumber:string>>")

    def inv(status, pid, email, phone=None):
        return F.struct(F.lit(status).cast("string").alias("status"),
                        F.struct(pid.cast("string").alias("id")).alias("inviteeProfile"),
                        F.struct(email.cast("string").alias("email"), F.lit(phone).cast("string").alias("phoneNumber"))
                        .alias("invitee"))
    u_supp = F.concat(F.lit("u"), F.col("l_suppkey").cast("string"))
    invitations = F.array(
        inv("ACCEPTED", u_supp, F.lit("s@x.org")),
        inv("declined", F.concat(F.lit("u"), (F.col("l_partkey") % 50).cast("string")), F.lit(None)),
        inv(None, F.lit(None), F.concat(F.lit(" e"), (F.col("l_partkey") % 30).cast("string"), F.lit("@x.org ")), "555"),
        inv("PENDING", u_supp, F.lit(None)),
        inv("ACCEPTED", F.lit("  "), F.lit(None)),
    ).cast(f"array<{inv_t}>")
    direct = (F.when(ln % 3 == 0, F.lit(None).cast(_PERSON))
              .when(ln % 3 == 1, _person(u_supp, first="A", last="B"))
              .otherwise(_person(None, display="Shown")))
    embedded = _person(None, email=F.concat(F.lit("emb"), (F.col("l_orderkey") % 9).cast("string")))
    reservation = F.struct(
        F.when(ln % 2 == 1, F.concat(F.lit("r"), F.col("l_orderkey").cast("string"))).alias("id"),
        F.concat(F.lit("c"), ln.cast("string")).alias("code"),
        F.when(ln % 3 != 0, F.concat(_txt(st), F.lit("Z"))).alias("startTime"),
        F.lit(None).cast("string").alias("endTime"),
        F.concat(_txt(st - F.expr("INTERVAL 3 DAYS")), F.lit("Z")).alias("createdAt"),
        F.when(ln % 2 == 0, _txt(st - F.expr("INTERVAL 1 DAY"))).alias("updatedAt"),
        F.when(F.col("l_linestatus") == "F", _txt(st - F.expr("INTERVAL 2 HOURS"))).alias("cancelledAt"),
        F.concat(F.lit("b"), (F.col("l_partkey") % 40).cast("string")).alias("bookedById"),
        direct.alias("bookedBy"),
        F.struct(F.when(ln % 3 == 2, embedded).otherwise(F.lit(None).cast(_PERSON)).alias("bookedBy")).alias("_embedded"),
    )
    rec = F.struct(
        F.concat(F.lit("ev"), F.col("l_orderkey").cast("string"), F.lit("-"), ln.cast("string")).alias("id"),
        F.when(F.col("l_returnflag") == "R", F.lit("PRIVATE")).when(F.col("l_returnflag") == "A", F.lit("regular"))
        .otherwise(F.lit("REGULAR")).alias("type"),
        F.concat(_txt(st - F.expr("INTERVAL 30 MINUTES")), F.lit("Z")).alias("startTime"),
        F.concat(_txt(st + F.expr("INTERVAL 1 HOUR")), F.lit("Z")).alias("endTime"),
        F.struct(invitations.alias("items")).alias("invitations"),
        F.struct(F.array(reservation).alias("items")).alias("reservations"),
    )
    src = li.select(F.concat(F.lit("nation_"), (F.col("l_suppkey") % 25).cast("string")).alias("client_code"),
                    F.to_json(rec).alias("payload"))
    return B.normalize_event_reservations(_parse(src, PL.B_EVENT))


# ---------------------------------------------------------------------------
# N15 + N16: sessions
# ---------------------------------------------------------------------------
SESSION_END = "2024-01-29 00:00:00"


def _sessions_payload(spark, sf_dir) -> DataFrame:
    e = read_table(spark, sf_dir, "events", spread_scan=True)
    ts = F.col("ts")
    court = (F.col("user_id") % 4).cast("string")
    tab_t = "struct<type:string,table:struct<id:string,displayName:string,displayNameShort:string>>"

    def tab(kind, tid, name, short):
        return F.struct(F.lit(kind).alias("type"), F.struct(
            tid.cast("string").alias("id"), name.cast("string").alias("displayName"),
            short.cast("string").alias("displayNameShort")).alias("table"))
    tables = F.array(
        tab("FIXED_TABLE", court, F.when(F.col("user_id") % 3 != 0, F.concat(F.lit("Table "), court)).otherwise(F.lit("")),
            F.concat(F.lit("T"), court)),
        F.struct(F.lit("AUTO").alias("type"), F.lit(None).cast(
            "struct<id:string,displayName:string,displayNameShort:string>").alias("table")),
        tab("FIXED_TABLE", F.lit(""), F.lit("blank id"), F.lit(None)),
    ).cast(f"array<{tab_t}>")
    start_txt = F.when(F.col("event_id") % 2 == 0, _txt(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).otherwise(
        F.concat(_txt(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
    rec = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.when(F.col("event_type") == "signup", F.lit(None).cast("string")).otherwise(start_txt).alias("startTime"),
        _txt(ts + F.expr("INTERVAL 30 MINUTES"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("endTime"),
        F.when(F.col("event_type") == "click", F.lit("PEAK")).otherwise(F.lit("OFF_PEAK")).alias("periodType"),
        F.when(F.col("event_type") == "error", F.lit("FULL")).otherwise(F.lit("AVAILABLE")).alias("status"),
        F.struct(tables.alias("items")).alias("availableTables"),
    )
    return e.select(F.concat(F.lit("nation_"), (F.col("user_id") % 25).cast("string")).alias("client_code"),
                    F.to_json(rec).alias("payload"))


@register("json_sessions_fanout", f"""
SELECT 'nation_' || CAST(user_id % 25 AS VARCHAR) AS client_code, 'podplay' AS source_system,
       CAST(user_id % 4 AS VARCHAR) AS court_id,
       CASE WHEN user_id % 3 <> 0 THEN 'Table ' || CAST(user_id % 4 AS VARCHAR) ELSE 'T' || CAST(user_id % 4 AS VARCHAR) END AS court_name,
       ts AS slot_start, ts + INTERVAL 30 MINUTE AS slot_end,
       CASE WHEN event_type = 'click' THEN 'PEAK' ELSE 'OFF_PEAK' END AS period_type
FROM events
WHERE event_type NOT IN ('error', 'signup') AND ts <= TIMESTAMP '{SESSION_END}'""")
def json_sessions_fanout(spark, sf_dir):
    """Available sessions up to the end time, one row per fixed court."""
    recs = _parse(_sessions_payload(spark, sf_dir), PL.B_SESSION)
    return B.normalize_sessions(recs, SESSION_END)


@register("session_counts", f"""
SELECT CASE WHEN event_type = 'error' THEN 'FULL' ELSE 'AVAILABLE' END AS status,
       count(*) AS sessions,
       CAST(sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS BIGINT) AS available,
       CAST(sum(CASE WHEN event_type NOT IN ('error', 'signup') AND ts > TIMESTAMP '{SESSION_END}' THEN 1 ELSE 0 END) AS BIGINT) AS beyond_end,
       CAST(sum(CASE WHEN event_type NOT IN ('error', 'signup') AND ts <= TIMESTAMP '{SESSION_END}' THEN 1 ELSE 0 END) AS BIGINT) AS with_tables
FROM events GROUP BY 1""")
def session_counts(spark, sf_dir):
    """Session run counts by status."""
    recs = _parse(_sessions_payload(spark, sf_dir), PL.B_SESSION, keep=())
    out = B.session_counts(recs, SESSION_END)
    return out.select("status", "sessions", *[F.col(c).cast("bigint").alias(c)
                                              for c in ("available", "beyond_end", "with_tables")])


# ---------------------------------------------------------------------------
# Place details (one place per supplier)
# ---------------------------------------------------------------------------
def _places(spark, sf_dir) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", spread_scan=True)
    k = F.col("s_suppkey")
    rv_t = "struct<name:string,rating:double,text:struct<text:string>,publishTime:string>"

    def review(i):
        return F.struct(F.concat(F.lit(f"r{i}-"), k.cast("string")).alias("name"),
                        ((k + i) % 5 + 1).cast("double").alias("rating"),
                        F.struct(F.lit(f"review {i}").alias("text")).alias("text"),
                        F.lit("2024-01-01T00:00:00Z").alias("publishTime"))
    rec = F.struct(
        F.concat(F.lit("place"), k.cast("string")).alias("id"),
        (F.col("s_acctbal") / 2000).alias("rating"),
        (k % 300).cast("int").alias("userRatingCount"),
        F.when(k % 3 == 0, F.array().cast(f"array<{rv_t}>")).otherwise(F.array(review(1), review(2))).alias("reviews"),
        F.when(k % 4 == 0, F.lit(None).cast("array<struct<name:string>>"))
        .otherwise(F.array(F.struct(F.concat(F.lit("places/p"), k.cast("string"), F.lit("/photos/a")).alias("name")),
                           F.struct(F.lit("second").alias("name")))).alias("photos"),
    )
    src = s.select(F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("client_code"),
                   F.to_json(rec).alias("payload"))
    return _parse(src, PL.PLACE)


@register("place_reviews", """
SELECT 'nation_' || CAST(s_nationkey AS VARCHAR) AS client_code, 'google' AS review_service,
       CAST(s_suppkey % 300 AS INTEGER) AS num_reviews, s_acctbal / 2000 AS avg_review,
       'https://www.google.com/maps/place/?q=place_id:place' || CAST(s_suppkey AS VARCHAR) AS link_to_reviews,
       CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'places/p' || CAST(s_suppkey AS VARCHAR) || '/photos/a' END AS photo_name,
       CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'https://places.googleapis.com/v1/places/p' || CAST(s_suppkey AS VARCHAR)
            || '/photos/a/media?maxWidthPx=800' END AS photo_url,
       CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE 2 END AS n_reviews
FROM supplier""")
def place_reviews(spark, sf_dir):
    """N18 + N19 + N20: review aggregate, first photo and review count per place."""
    p = _places(spark, sf_dir)
    # One pass over the parsed places: the place operators' columns side by
    # side (N20's row count is the size of the review list).
    return p.select("client_code", *PLC.review_columns(), *PLC.photo_columns(),
                    F.greatest(F.size("reviews"), F.lit(0)).cast("int").alias("n_reviews"))
