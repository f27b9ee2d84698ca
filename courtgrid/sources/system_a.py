"""System-A payload normalisers (N1–N4, N12–N14, N17) as DataFrame projections.

Each normaliser takes a DataFrame of payload records (columns as in
``payloads``) with a ``client_code`` column, and returns the flat rows of
the raw table.  Python truthiness (``a or b``) is reproduced with
``truthy_or`` (empty text falls through, not only null).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

# Fixed values that must equal the reference's.
COURT_RESERVATION = "Court Reservation"
NON_MEMBER = "Non-Member Account"
STAFF = "Staff"
MEMBER_PRICE_TYPES = ["Premium", "Founder"]
SYSTEM_A = "courtreserve"


def _tenant(df: DataFrame, client_code) -> Column:
    if client_code is None:
        return F.lower(F.col("client_code"))
    return F.lower(F.lit(client_code))


def _str(c: Column) -> Column:
    return c.cast("string")


def normalize_reservations(res: DataFrame, client_code=None) -> DataFrame:
    """N1 + N2: court reservations only, one row per player (no players -> no
    rows); start/end naive = New York, created/updated/cancelled naive = UTC."""
    keep = S.py_strip(F.col("ReservationTypeName")) == COURT_RESERVATION
    cancelled_raw = S.truthy_or(F.col("CancelledOnUtc"), F.col("CancelledOn"))
    base = res.filter(keep).select(
        _tenant(res, client_code).alias("client_code"),
        _str(F.col("Id")).alias("reservation_id"),
        _str(F.col("ReservationTypeId")).alias("event_id"),
        S.parse_iso_utc(S.truthy_or(F.col("CreatedOnUtc"), F.lit(None))).alias("reservation_created_at"),
        S.parse_iso_utc(S.truthy_or(F.col("UpdatedOnUtc"), F.lit(None))).alias("reservation_updated_at"),
        S.parse_event_time(S.truthy_or(F.col("StartTime"), F.lit(None))).alias("reservation_start_at"),
        S.parse_event_time(S.truthy_or(F.col("EndTime"), F.lit(None))).alias("reservation_end_at"),
        S.parse_iso_utc(cancelled_raw).alias("reservation_cancelled_at"),
        F.explode("Players").alias("_player"),
        *[c for c in ("_file", "_pos") if c in res.columns],
    )
    member = _str(F.col("_player.OrganizationMemberId"))
    return base.select(
        "client_code", "reservation_id", "event_id", "reservation_created_at", "reservation_updated_at",
        "reservation_start_at", "reservation_end_at", "reservation_cancelled_at",
        member.alias("member_id"), member.alias("club_member_key"),
        *[c for c in ("_file", "_pos") if c in res.columns],
    )


def normalize_cancellations(c: DataFrame, client_code=None) -> DataFrame:
    """22 columns per cancelled program sign-up."""
    start = S.parse_event_time(S.truthy_or(F.col("StartTime"), F.lit(None)))
    first, last = F.col("FirstName"), F.col("LastName")
    return c.select(
        _tenant(c, client_code).alias("client_code"),
        F.lit(SYSTEM_A).alias("source_system"),
        _str(F.col("EventId")).alias("event_id"),
        _str(F.col("EventDateId")).alias("reservation_id"),
        _str(F.col("OrganizationMemberId")).alias("member_id"),
        F.col("EventCategoryName").alias("reservation_type"),
        S.parse_iso_utc(S.truthy_or(F.col("SignedUpOnUtc"), F.lit(None))).alias("reservation_created_at"),
        start.alias("reservation_start_at"),
        S.parse_event_time(S.truthy_or(F.col("EndTime"), F.lit(None))).alias("reservation_end_at"),
        S.parse_iso_utc(S.truthy_or(F.col("CancelledOnUtc"), F.col("CancelledOn"))).alias("cancelled_on"),
        S.weekday_name(start).alias("day_of_week"),
        F.lit(True).alias("is_program"),
        F.col("EventName").alias("program_name"),
        F.concat_ws(" ", F.nullif(first, F.lit("")), F.nullif(last, F.lit(""))).alias("player_name"),
        first.alias("player_first_name"), last.alias("player_last_name"),
        F.col("Email").alias("player_email"), F.col("Phone").alias("player_phone"),
        F.col("PriceToPay").alias("fee"), F.col("IsTeamEvent").alias("is_team_event"),
        F.col("EventCategoryName").alias("event_category_name"),
        F.col("EventCategoryId").alias("event_category_id"),
        *[x for x in ("_file", "_pos") if x in c.columns],
    )


def parse_date_prefix(x: Column) -> Column:
    """``datetime.fromisoformat(v).date()``: the date written in the text, for
    any valid ISO date or date-time text; else null."""
    ok = x.rlike(S.ISO_ANY_RE)
    return F.when(ok & S.parse_iso_utc(x).isNotNull(), F.substring(x, 1, 10).try_cast("date"))


def normalize_members(m: DataFrame, client_code=None) -> DataFrame:
    """Member rows; 'Staff' first, else membership name, else non-member."""
    staff = F.coalesce(F.col("Staff"), F.lit(False)) | F.coalesce(F.col("IsStaff"), F.lit(False))
    membership = F.when(staff, F.lit(STAFF)).otherwise(
        S.truthy_or(F.col("MembershipTypeName"), F.lit(NON_MEMBER)))
    member = _str(F.col("MembershipNumber"))
    return m.select(
        _tenant(m, client_code).alias("client_code"),
        member.alias("member_id"), member.alias("club_member_key"),
        F.col("FirstName").alias("first_name"), F.col("LastName").alias("last_name"),
        F.col("Gender").alias("gender"),
        parse_date_prefix(F.col("DateOfBirth")).alias("date_of_birth"),
        S.normalize_email_ingest(F.col("Email")).alias("email"),
        S.normalize_phone_ingest(S.truthy_or(F.col("PhoneNumber"), F.col("MobilePhone"))).alias("phone_number"),
        membership.alias("membership_type_name"),
        F.when(membership != NON_MEMBER, 1).otherwise(0).alias("is_premium_member"),
        parse_date_prefix(F.col("MembershipStartDate")).alias("member_since"),
        *[c for c in ("_file", "_pos") if c in m.columns],
    )


def price_rates(price_info: Column) -> tuple[Column, Column]:
    """(regular, member) rates from a PriceInfo array.

    price = EntireEventPrice, or DailyPrice when that is 0/absent; regular =
    the last 'Non-Member Account' price; member = the lowest Premium/Founder.
    """
    priced = F.transform(price_info, lambda p: F.struct(
        p["MembershipTypeName"].alias("t"),
        S.nonzero_or(p["EntireEventPrice"], p["DailyPrice"]).cast("double").alias("v")))
    priced = F.filter(priced, lambda p: p["v"].isNotNull())
    regular = F.try_element_at(F.filter(priced, lambda p: p["t"] == NON_MEMBER), F.lit(-1))["v"]
    member = F.array_min(F.transform(F.filter(priced, lambda p: p["t"].isin(MEMBER_PRICE_TYPES)),
                                     lambda p: p["v"]))
    return regular, member


def normalize_events(ev: DataFrame, categories: DataFrame | None, known_zones: list[str],
                     client_code=None) -> DataFrame:
    """N12 + N13 + N14: system-A events.

    ``categories``: (client_code, source_system, id, event_category_name);
    joined by (tenant, system, category id) — a dimension small enough for
    AQE to broadcast by measured size.  Fall-back type: CategoryName, then
    EventType, then EventCategoryName (Q9).
    """
    def alt(name):
        return F.col("_alt")[name] if "_alt" in ev.columns else F.lit(None).cast("string")
    event_id = S.truthy_or(F.col("Id"), alt("id"), F.col("EventId"), F.lit(""))
    zone = S.resolve_zone(known_zones, S.truthy_or(F.col("TimeZone"), alt("Timezone"), F.lit(None)),
                          F.lit(S.SYSTEM_A_NAIVE_ZONE))
    start_txt = S.truthy_or(F.col("StartTime"), alt("startTime"), F.col("StartDateTime"), F.lit(None))
    end_txt = S.truthy_or(F.col("EndTime"), alt("endTime"), F.col("EndDateTime"), F.lit(None))
    regular, member = price_rates(F.col("PriceInfo"))
    base = ev.select(
        _tenant(ev, client_code).alias("client_code"),
        F.lit(SYSTEM_A).alias("source_system"),
        event_id.alias("event_id"),
        S.truthy_or(F.col("Name"), alt("name"), F.col("EventName"), F.lit("")).alias("event_name"),
        F.col("EventCategoryId").cast("string").alias("_cat"),
        S.truthy_or(F.col("CategoryName"), F.col("EventType"), F.col("EventCategoryName"), F.lit(""))
        .alias("_fallback_type"),
        S.parse_iso_utc(start_txt, zone).alias("event_start_time"),
        S.parse_iso_utc(end_txt, zone).alias("event_end_time"),
        S.safe_int(F.col("RegisteredCount")).alias("num_registrants"),
        S.safe_int(F.col("MaxRegistrants")).alias("max_registrants"),
        regular.alias("admission_rate_regular"), member.alias("admission_rate_member"),
        S.parse_courts_array(F.col("Courts")).alias("courts"),
        *[c for c in ("_file", "_pos") if c in ev.columns],
    ).filter(F.col("event_id") != "")
    if categories is not None:
        cat = categories.select(
            F.lower("client_code").alias("_cc"), F.lower("source_system").alias("_cs"),
            F.col("id").cast("string").alias("_cid"), F.col("event_category_name").alias("_cname"))
        base = base.join(cat, (base["client_code"] == cat["_cc"]) & (base["source_system"] == cat["_cs"])
                         & (base["_cat"] == cat["_cid"]), "left")
        etype = S.truthy_or(F.col("_cname"), F.col("_fallback_type"))
    else:
        etype = F.col("_fallback_type")
    return base.select(
        "client_code", "source_system", "event_id", "event_name",
        F.lit(None).cast("string").alias("event_description"),  # no description key (Q16)
        etype.alias("event_type"),
        "event_start_time", "event_end_time", "num_registrants", "max_registrants",
        "admission_rate_regular", "admission_rate_member", "courts",
        *[c for c in ("_file", "_pos") if c in ev.columns],
    )


def event_busy(ev: DataFrame, client_code=None) -> DataFrame:
    """V4 input from event payloads: courts from the array form, times from
    ``StartDateTime`` / ``EndDateTime`` (naive = New York); events carry no
    cancellation."""
    return ev.select(
        _tenant(ev, client_code).alias("client_code"),
        S.parse_courts_array(F.col("Courts")).alias("courts"),
        S.parse_event_time(S.truthy_or(F.col("StartDateTime"), F.lit(None))).alias("start"),
        S.parse_event_time(S.truthy_or(F.col("EndDateTime"), F.lit(None))).alias("end"),
        F.lit(None).cast("string").alias("cancelled"),
    )


def reservation_busy(res: DataFrame, client_code=None) -> DataFrame:
    """V4 input from reservation payloads: courts from the text form, times
    naive = New York; only ``CancelledOn`` marks a reservation cancelled here
    (the availability job reads that field, not ``CancelledOnUtc``)."""
    return res.select(
        _tenant(res, client_code).alias("client_code"),
        S.parse_courts_text(F.col("Courts")).alias("courts"),
        S.parse_event_time(S.truthy_or(F.col("StartTime"), F.lit(None))).alias("start"),
        S.parse_event_time(S.truthy_or(F.col("EndTime"), F.lit(None))).alias("end"),
        F.nullif(F.col("CancelledOn"), F.lit("")).alias("cancelled"),
    )
