"""Model chain (P1–P12): staging views and mart tables as DataFrame functions.

Dependency order (each function takes its inputs as DataFrames):

    organizations -> stg_organizations -> stg_reservations__{a,b} -> stg_reservations -> fct_reservations
                                       -> stg_members -> dim_members
                                       -> dim_clients
    courts -> stg_courts -> fct_court_availability (with stg_organizations)
    facility_court_availabilities -> fct_court_availability_fe
    facility_events_raw -> (classifier) -> fct_events

Tenant-sized dimensions (organizations, courts) are joined with plain
joins; Catalyst/AQE broadcast them when their measured size is under the
broadcast threshold and fall back to a shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import scalars as S
from ..operators import peak as K
from ..operators import slots as L

SYSTEM_A, SYSTEM_B = "courtreserve", "podplay"


def stg_courts(courts: DataFrame) -> DataFrame:
    """P1."""
    return courts.select(
        F.col("id").alias("court_id"), "client_code", F.col("label").alias("court_label"),
        F.col("type_name").alias("court_type"), "order_index", "created_at", "updated_at")


STG_ORG_COLUMNS = [
    "source_system_code", "client_code", "login_link", "city", "is_customer", "hourly_rate_non_member",
    "hourly_rate_member", "hourly_rate_non_member_off_peak", "hourly_rate_member_off_peak",
    "facility_display_name", "peak_hours", "location_display_name", "podplay_pod", "podplay_pod_id",
    "operating_hours",
]


def stg_organizations(orgs: DataFrame) -> DataFrame:
    """16 columns (display hours and place id left out)."""
    return orgs.select(F.col("id").alias("organization_id"),
                       *[F.col(c) if c in orgs.columns else F.lit(None).cast("string").alias(c)
                         for c in STG_ORG_COLUMNS])


def stg_members(members_raw: DataFrame, stg_orgs: DataFrame) -> DataFrame:
    """Members with model-rule phone/email, member key, reservation system."""
    o = stg_orgs.select(F.col("client_code").alias("_occ"), F.col("source_system_code").alias("_sys"))
    b = members_raw.join(o, F.lower(members_raw["client_code"]) == o["_occ"], "left")
    system = F.coalesce(F.col("_sys"), F.col("client_code"))
    return b.select(
        S.md5_key(system, F.col("client_code"), F.col("member_id")).alias("member_pk"),
        "client_code", F.col("member_id").alias("external_member_id"), "first_name", "last_name", "gender",
        F.col("date_of_birth").alias("birthday"),
        S.normalize_phone_model(F.col("phone_number")).alias("phone"),
        S.normalize_email_model(F.col("email")).alias("email"),
        "membership_type_name", "is_premium_member", "member_since", "created_at",
        system.alias("reservation_system_code"),
    )


DIM_MEMBER_COLUMNS = ["member_pk", "client_code", "external_member_id", "first_name", "last_name", "gender",
                      "birthday", "phone", "email", "membership_type_name", "is_premium_member",
                      "member_since", "created_at", "reservation_system_code"]


def dim_members(stg: DataFrame) -> DataFrame:
    """P8."""
    return stg.select(*DIM_MEMBER_COLUMNS)


def _stg_res(res_raw: DataFrame, stg_orgs: DataFrame, system: str, key_fallbacks: list[str]) -> DataFrame:
    o = stg_orgs.filter(F.col("source_system_code") == system).select(F.col("client_code").alias("_occ"))
    r = res_raw.join(o, F.lower(res_raw["client_code"]) == o["_occ"], "inner")
    start_txt = F.coalesce(S.pg_timestamptz_text(F.col("reservation_start_at")), F.lit(""))
    return r.select(
        S.md5_key(F.lit(system), F.col("client_code"), F.coalesce(*[F.col(c) for c in key_fallbacks]),
                  start_txt).alias("reservation_pk"),
        F.lit(system).alias("source_system_code"), "client_code", "reservation_id", "event_id", "member_id",
        "reservation_created_at", "reservation_updated_at", "reservation_start_at", "reservation_end_at",
        F.col("created_at").alias("ingested_at"),
    )


def stg_reservations_a(res_raw: DataFrame, stg_orgs: DataFrame) -> DataFrame:
    """System-A tenants; key from reservation -> event -> member id."""
    return _stg_res(res_raw, stg_orgs, SYSTEM_A, ["reservation_id", "event_id", "member_id"])


def stg_reservations_b(res_raw: DataFrame, stg_orgs: DataFrame, drop_cancelled: bool = False) -> DataFrame:
    """P5: system-B tenants; key from reservation -> event id.  Cancelled
    bookings stay unless ``drop_cancelled`` (Q29)."""
    src = res_raw.filter(F.col("reservation_cancelled_at").isNull()) if drop_cancelled else res_raw
    return _stg_res(src, stg_orgs, SYSTEM_B, ["reservation_id", "event_id"])


def stg_reservations(res_raw: DataFrame, stg_orgs: DataFrame) -> DataFrame:
    """Both systems' staging (P4, P5) and the union in one pass over the
    raw table: one join to the tenants picks the system and its key rule,
    a second (not lower-cased, J2) gives the reservation system code."""
    o = stg_orgs.select(F.col("client_code").alias("_occ"), F.col("source_system_code").alias("_sys"))
    r = res_raw.join(o.filter(F.col("_sys").isin(SYSTEM_A, SYSTEM_B)),
                     F.lower(res_raw["client_code"]) == o["_occ"], "inner")
    start_txt = F.coalesce(S.pg_timestamptz_text(F.col("reservation_start_at")), F.lit(""))
    key_a = F.coalesce(F.col("reservation_id"), F.col("event_id"), F.col("member_id"))
    key_b = F.coalesce(F.col("reservation_id"), F.col("event_id"))
    u = r.select(
        S.md5_key(F.col("_sys"), F.col("client_code"),
                  F.when(F.col("_sys") == SYSTEM_A, key_a).otherwise(key_b), start_txt).alias("reservation_pk"),
        F.col("_sys").alias("source_system_code"), "client_code", "reservation_id", "event_id", "member_id",
        "reservation_created_at", "reservation_updated_at", "reservation_start_at", "reservation_end_at",
        F.col("created_at").alias("ingested_at"),
    )
    o2 = stg_orgs.select(F.col("client_code").alias("_occ2"), F.col("source_system_code").alias("_sys2"))
    j = u.join(o2, u["client_code"] == o2["_occ2"], "left")
    return j.select(
        "reservation_pk", "source_system_code", "client_code",
        F.coalesce(F.col("_sys2"), F.col("source_system_code")).alias("reservation_system_code"),
        "reservation_id", "event_id", "member_id", "reservation_created_at", "reservation_updated_at",
        "reservation_start_at", "reservation_end_at", "ingested_at",
    )


def stg_reservations_union(res_raw: DataFrame, stg_orgs: DataFrame) -> DataFrame:
    """P6 spelled as in the models (two staging views, then union); same
    result as :func:`stg_reservations`, which reads the raw table once."""
    u = stg_reservations_a(res_raw, stg_orgs).unionByName(stg_reservations_b(res_raw, stg_orgs))
    o = stg_orgs.select(F.col("client_code").alias("_occ"), F.col("source_system_code").alias("_sys"))
    j = u.join(o, u["client_code"] == o["_occ"], "left")
    return j.select(
        "reservation_pk", "source_system_code", "client_code",
        F.coalesce(F.col("_sys"), F.col("source_system_code")).alias("reservation_system_code"),
        "reservation_id", "event_id", "member_id", "reservation_created_at", "reservation_updated_at",
        "reservation_start_at", "reservation_end_at", "ingested_at",
    )


FCT_RES_COLUMNS = ["reservation_pk", "client_code", "reservation_system_code", "source_system_code",
                   "reservation_id", "event_id", "member_id", "reservation_created_at",
                   "reservation_updated_at", "reservation_start_at", "reservation_end_at", "ingested_at"]


def fct_reservations(stg: DataFrame) -> DataFrame:
    """P9."""
    return stg.select(*FCT_RES_COLUMNS)


def dim_clients(stg_orgs: DataFrame) -> DataFrame:
    """Tenant dimension with always-null placeholder columns."""
    null = F.lit(None).cast("string")
    return stg_orgs.select(
        "client_code", F.col("facility_display_name").alias("client_name"), "location_display_name",
        null.alias("timezone"), F.col("is_customer").alias("is_active"), null.alias("notes"),
        F.col("source_system_code").alias("reservation_system_code"),
        S.system_display_name(F.col("source_system_code")).alias("reservation_system_name"),
        null.alias("api_base_url"), null.alias("auth_method"), null.alias("reservation_system_notes"),
    )


def classify_events(events_raw: DataFrame) -> DataFrame:
    """The skill level is computed inside the pipeline."""
    return events_raw.withColumn("skill_level", R.skill_level(F.col("event_name")))


FCT_EVENT_COLUMNS = ["event_pk", "client_code", "source_system", "event_id", "event_name", "event_description",
                     "event_type_original", "event_type", "skill_level", "event_start_time", "event_end_time",
                     "num_registrants", "max_registrants", "is_full", "admission_rate_regular",
                     "admission_rate_member", "created_at"]


def fct_events(events_raw: DataFrame) -> DataFrame:
    """P10: type mapping, excluded types dropped, default skill level, key, is_full."""
    e = events_raw.filter(S.keep_event_type(F.col("event_type")))
    start_txt = F.coalesce(S.pg_timestamptz_text(F.col("event_start_time")), F.lit(""))
    return e.select(
        S.md5_key(F.coalesce("client_code", F.lit("")), F.coalesce("event_id", F.lit("")),
                  F.coalesce("source_system", F.lit("")), start_txt).alias("event_pk"),
        "client_code", "source_system", "event_id", "event_name", "event_description",
        F.col("event_type").alias("event_type_original"),
        S.map_event_type(F.col("event_type")).alias("event_type"),
        F.coalesce(F.col("skill_level"), F.lit(R.ALL_LEVELS)).alias("skill_level"),
        "event_start_time", "event_end_time", "num_registrants", "max_registrants",
        S.is_full(F.col("num_registrants"), F.col("max_registrants")).alias("is_full"),
        "admission_rate_regular", "admission_rate_member", "created_at",
    )


def fct_court_availability(avail: DataFrame, stg_orgs: DataFrame, stg_court: DataFrame,
                           known_zones: list[str], as_of, horizon_days: int = 7) -> DataFrame:
    """P11."""
    return K.label_periods(avail, stg_orgs.select("client_code", "peak_hours", "operating_hours"),
                           stg_court.select("court_id", "client_code", "court_label"), known_zones,
                           as_of=as_of, horizon_days=horizon_days)


def fct_court_availability_fe(avail: DataFrame, as_of, horizon_days: int = 7,
                              display_zone: str = "UTC") -> DataFrame:
    """P12."""
    return L.compose_slots(avail, as_of, horizon_days, display_zone)
