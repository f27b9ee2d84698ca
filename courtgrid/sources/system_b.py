"""System-B payload normalisers (N5–N11, N15, N16) as DataFrame projections.

Nested lists become ``explode`` / higher-order functions; the order-
preserving de-duplication of participants uses ``array_distinct`` (which
keeps first occurrences in order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

# Fixed values that must equal the reference's.
SYSTEM_B = "podplay"
NO_MEMBERSHIP = "NONE"
SKIP_INVITE_STATUSES = ["CANCELLED", "DECLINED"]
REGULAR = "REGULAR"
AVAILABLE = "AVAILABLE"
FIXED_TABLE = "FIXED_TABLE"


def _tenant(client_code) -> Column:
    return F.lower(F.col("client_code")) if client_code is None else F.lower(F.lit(client_code))


def _utc_date(x: Column) -> Column:
    """``parse_iso_datetime(x).date()``: date of the UTC instant (naive = UTC)."""
    return F.to_date(S.parse_iso_utc(S.truthy_or(x, F.lit(None))))


def phone_text(x: Column) -> Column:
    """The phone field is text or an object ``{phoneNumber, id, value}``.
    With a STRING schema Spark keeps an object as its JSON text."""
    obj = F.ltrim(x).startswith("{")
    pick = S.truthy_or(F.get_json_object(x, "$.phoneNumber"), F.get_json_object(x, "$.id"),
                       F.get_json_object(x, "$.value"), F.lit(None))
    return F.when(obj, pick).otherwise(x)


def newest_membership(items: Column) -> Column:
    """Newest membership by createdAt -> startedAt ->
    membership.createdAt (null lowest), then membership id."""
    keyed = F.transform(items, lambda m: F.struct(
        S.parse_iso_utc(S.truthy_or(m["createdAt"], m["startedAt"], m["membership"]["createdAt"], F.lit(None)))
        .alias("k1"),
        m["membership"]["id"].alias("k2"),
        m.alias("item")))
    return F.array_max(keyed)["item"]


def normalize_members(users: DataFrame, client_code=None) -> DataFrame:
    """Member rows of system B."""
    membership = S.truthy_or(F.col("membershipType"), F.lit(NO_MEMBERSHIP))
    return users.select(
        _tenant(client_code).alias("client_code"),
        F.col("id").alias("member_id"), F.col("id").alias("club_member_key"),
        F.col("firstName").alias("first_name"), F.col("lastName").alias("last_name"),
        F.col("gender").alias("gender"),
        _utc_date(F.col("birthday")).alias("date_of_birth"),
        S.normalize_email_ingest(F.col("email")).alias("email"),
        S.normalize_phone_ingest(phone_text(F.col("phoneNumber"))).alias("phone_number"),
        membership.alias("membership_type_name"),
        F.when(membership != NO_MEMBERSHIP, 1).otherwise(0).alias("is_premium_member"),
        _utc_date(F.col("profile.memberSince")).alias("member_since"),
        newest_membership(F.col("memberships.items")).alias("newest_membership"),
        *[c for c in ("_file", "_pos") if c in users.columns],
    )


def booker(r: Column) -> dict[str, Column]:
    """Booker fields from ``bookedBy``, then ``_embedded.bookedBy``."""
    d, e = r["bookedBy"], r["_embedded"]["bookedBy"]
    return {
        "id": S.truthy_or(d["id"], e["id"], r["bookedById"], F.lit(None)),
        "first_name": S.truthy_or(d["firstName"], e["firstName"], F.lit(None)),
        "last_name": S.truthy_or(d["lastName"], e["lastName"], F.lit(None)),
        "email": S.truthy_or(d["email"], e["email"], F.lit(None)),
        "phone": S.truthy_or(d["phoneNumber"], e["phoneNumber"], F.lit(None)),
        "display_name": S.truthy_or(d["displayName"], e["displayName"], d["fullName"], e["fullName"], F.lit(None)),
    }


def combine_name(first: Column, last: Column, display: Column) -> Column:
    """N10: 'first last' when either is set, else the display name."""
    either = (F.coalesce(first, F.lit("")) != "") | (F.coalesce(last, F.lit("")) != "")
    return F.when(either, F.concat_ws(" ", F.nullif(first, F.lit("")), F.nullif(last, F.lit("")))).otherwise(display)


def invitees(invitations: Column) -> Column:
    """Invitees not CANCELLED/DECLINED (id -> email -> phone), stripped,
    blanks dropped, first-seen order."""
    kept = F.filter(invitations, lambda i: ~F.upper(F.coalesce(i["status"], F.lit(""))).isin(SKIP_INVITE_STATUSES))
    ids = F.transform(kept, lambda i: F.nullif(S.py_strip(S.truthy_or(
        i["inviteeProfile"]["id"], i["invitee"]["email"], i["invitee"]["phoneNumber"], F.lit(None))), F.lit("")))
    ids = F.array_distinct(F.filter(ids, lambda x: x.isNotNull()))
    return F.coalesce(ids, F.array().cast("array<string>"))


def host(reservation: Column) -> Column:
    """The booker's id, else email, else phone, stripped; null when blank."""
    b = booker(reservation)
    return F.nullif(S.py_strip(S.truthy_or(b["id"], b["email"], b["phone"], F.lit(None))), F.lit(""))


def participants(ids: Column, booked_by: Column) -> Column:
    """The invitees, then the booker if absent."""
    return F.when(booked_by.isNotNull() & ~F.array_contains(ids, booked_by),
                  F.concat(ids, F.array(booked_by))).otherwise(ids)


def normalize_event_reservations(events: DataFrame, client_code=None) -> DataFrame:
    """REGULAR events -> reservations -> one row per participant.  An input
    position ``_pos`` becomes (position of the event, of the reservation in it)."""
    has_pos = "_pos" in events.columns
    ev = events.filter(F.upper(F.coalesce(F.col("type"), F.lit(""))) == REGULAR).select(
        _tenant(client_code).alias("client_code"),
        F.col("id").alias("event_id"),
        S.parse_iso_utc(S.truthy_or(F.col("startTime"), F.lit(None))).alias("_es"),
        S.parse_iso_utc(S.truthy_or(F.col("endTime"), F.lit(None))).alias("_ee"),
        F.col("invitations.items").alias("_inv"),
        *([F.col("_pos")] if has_pos else []),
        F.posexplode("reservations.items").alias("_item", "r"),
    )
    created = S.parse_iso_utc(S.truthy_or(F.col("r.createdAt"), F.lit(None)))
    # A reservation's own columns are made before its participants are taken apart, each once.
    booked = ev.select(
        "client_code",
        S.truthy_or(F.col("r.id"), F.col("r.code"), F.lit(None)).alias("reservation_id"),
        "event_id",
        invitees(F.col("_inv")).alias("_ids"), host(F.col("r")).alias("_host"),
        created.alias("reservation_created_at"),
        S.parse_iso_utc(S.truthy_or(F.col("r.updatedAt"), F.lit(None))).alias("_updated"),
        F.coalesce(S.parse_iso_utc(S.truthy_or(F.col("r.startTime"), F.lit(None))), F.col("_es"))
        .alias("reservation_start_at"),
        F.coalesce(S.parse_iso_utc(S.truthy_or(F.col("r.endTime"), F.lit(None))), F.col("_ee"))
        .alias("reservation_end_at"),
        S.parse_iso_utc(S.truthy_or(F.col("r.cancelledAt"), F.lit(None))).alias("reservation_cancelled_at"),
        *([F.struct("_pos", "_item").alias("_pos")] if has_pos else []),
    )
    rows = booked.select(
        "client_code", "reservation_id", "event_id",
        F.explode(participants(F.col("_ids"), F.col("_host"))).alias("member_id"),
        "reservation_created_at", F.coalesce("_updated", "reservation_created_at").alias("reservation_updated_at"),
        "reservation_start_at", "reservation_end_at", "reservation_cancelled_at",
        *(["_pos"] if has_pos else []),
    )
    return rows


def _int_like(x: Column) -> Column:
    """``int(x)`` for text or numbers: integers as is, decimals truncated."""
    return F.coalesce(x.try_cast("bigint"), x.try_cast("double").try_cast("bigint"))


def normalize_events(events: DataFrame, known_zones: list[str], client_code=None) -> DataFrame:
    """System-B events; blank id skipped; zone from the payload, else UTC."""
    zone = S.resolve_zone(known_zones, F.col("timezone"), F.lit("UTC"))
    start_txt = S.truthy_or(F.col("startTime"), F.col("start_time"), F.lit(None))
    end_txt = S.truthy_or(F.col("endTime"), F.col("end_time"), F.lit(None))
    teams, size = _int_like(F.col("totalTeams")), _int_like(F.col("teamSize"))
    return events.filter(F.coalesce(F.col("id"), F.lit("")) != "").select(
        _tenant(client_code).alias("client_code"),
        F.lit(SYSTEM_B).alias("source_system"),
        F.col("id").alias("event_id"),
        S.truthy_or(F.col("name"), F.col("title"), F.lit("")).alias("event_name"),
        F.coalesce(F.col("description"), F.lit("")).alias("event_description"),
        S.truthy_or(F.col("subtype"), F.lit("")).alias("event_type"),
        S.parse_iso_utc(start_txt, zone).alias("event_start_time"),
        S.parse_iso_utc(end_txt, zone).alias("event_end_time"),
        _int_like(F.col("signups._total")).alias("num_registrants"),
        (teams * size).alias("max_registrants"),
        S.safe_double(F.col("admissionRate.regular")).alias("admission_rate_regular"),
        S.safe_double(F.col("admissionRate.member")).alias("admission_rate_member"),
        *[c for c in ("_file", "_pos") if c in events.columns],
    )


def _session_time(x: Column) -> Column:
    """Session times: ISO text, 'Z' accepted, naive = UTC (Q26: zone attached
    before any comparison)."""
    return S.parse_iso_utc(S.truthy_or(x, F.lit(None)))


def normalize_sessions(sessions: DataFrame, end_time, client_code=None) -> DataFrame:
    """AVAILABLE sessions with both times, starting at or before
    ``end_time`` (order-free form of the reference's early stop, Q13), one
    row per FIXED_TABLE court with an id."""
    end = F.lit(end_time).cast("timestamp") if isinstance(end_time, str) else end_time
    s = sessions.filter(F.col("status") == AVAILABLE).select(
        _tenant(client_code).alias("client_code"),
        # from a generator: the filter below would parse the texts again
        F.inline(F.array(F.struct(_session_time(F.col("startTime")).alias("slot_start"),
                                  _session_time(F.col("endTime")).alias("slot_end")))),
        F.col("periodType").alias("period_type"),
        F.col("availableTables.items").alias("_tables"),
        *[c for c in ("_pos",) if c in sessions.columns],
    ).filter(F.col("slot_start").isNotNull() & F.col("slot_end").isNotNull() & (F.col("slot_start") <= end))
    pos = [c for c in ("_pos",) if c in sessions.columns]
    t = s.select("client_code", "slot_start", "slot_end", "period_type", F.explode("_tables").alias("t"), *pos)
    t = t.filter((F.col("t.type") == FIXED_TABLE) & F.col("t.table").isNotNull()
                 & (F.coalesce(F.col("t.table.id"), F.lit("")) != ""))
    return t.select(
        "client_code", F.lit(SYSTEM_B).alias("source_system"),
        F.col("t.table.id").alias("court_id"),
        S.truthy_or(F.col("t.table.displayName"), F.col("t.table.displayNameShort"), F.lit(None)).alias("court_name"),
        "slot_start", "slot_end", "period_type", *pos,
    )


def session_counts(sessions: DataFrame, end_time) -> DataFrame:
    """Per-status counts plus available / with-tables / beyond-end
    counts, as one aggregate (grouping by status, then totals)."""
    end = F.lit(end_time).cast("timestamp") if isinstance(end_time, str) else end_time
    start = _session_time(F.col("startTime"))
    avail = F.col("status") == AVAILABLE
    both = start.isNotNull() & _session_time(F.col("endTime")).isNotNull()
    tables = F.coalesce(F.size("availableTables.items"), F.lit(0)) > 0
    return sessions.groupBy("status").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum(F.when(avail, 1).otherwise(0)).alias("available"),
        F.sum(F.when(avail & both & (start > end), 1).otherwise(0)).alias("beyond_end"),
        F.sum(F.when(avail & both & (start <= end) & tables, 1).otherwise(0)).alias("with_tables"),
    )
