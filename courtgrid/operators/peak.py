"""Peak / off-peak labelling.

Hour ranges live in the tenant's ``peak_hours`` JSON.  They are parsed
once per tenant with ``from_json`` and the range test is a higher-order
``exists`` over the (short) range array, so the lateral joins of the
reference disappear: the plan is two many-to-one joins to small
dimensions plus projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

RANGE = "array<struct<start:string,end:string>>"
PEAK_HOURS_SCHEMA = (
    f"struct<timezone:string,weekday_peak:{RANGE},weekend_peak:{RANGE},"
    f"weekday_off_peak:{RANGE},weekend_off_peak:{RANGE}>"
)
DAY_SCHEMA = "struct<open:string,close:string>"
OPERATING_HOURS_SCHEMA = (
    "struct<timezone:string," + ",".join(
        f"{d}:{DAY_SCHEMA}" for d in
        ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")) + ">"
)


def hhmm_seconds(x: Column) -> Column:
    """'HH:mm[:ss]' -> seconds of day (the reference casts these to ``time``)."""
    p = F.split(x, ":")
    sec = F.coalesce(F.try_element_at(p, F.lit(3)).try_cast("int"), F.lit(0))
    return (F.try_element_at(p, F.lit(1)).try_cast("int") * 3600 + F.try_element_at(p, F.lit(2)).try_cast("int") * 60 + sec)


def in_any_range(ranges: Column, t: Column) -> Column:
    """K4: ``start <= end``: start <= t < end; ``start > end``: t >= start or t < end."""
    def hit(r):
        s, e = hhmm_seconds(r["start"]), hhmm_seconds(r["end"])
        return ((s <= e) & (t >= s) & (t < e)) | ((s > e) & ((t >= s) | (t < e)))
    return F.exists(ranges, hit)


def non_empty(ranges: Column) -> Column:
    """C20: an array with at least one element (JSON null / non-array -> false)."""
    return ranges.isNotNull() & (F.size(ranges) > 0)


def calculated_period(peak: Column, is_weekday: Column, t: Column) -> Column:
    """K5 + K6: weekday lists first; weekend with a peak list is always 'peak' (Q7)."""
    wd_peak, wd_off, we_peak = peak["weekday_peak"], peak["weekday_off_peak"], peak["weekend_peak"]
    weekday = (
        F.when(~non_empty(wd_peak), F.lit(None).cast("string"))
        .when(in_any_range(wd_peak, t), F.lit("peak"))
        .when(non_empty(wd_off) & in_any_range(wd_off, t), F.lit("off_peak"))
        .otherwise(F.lit("peak"))
    )
    weekend = F.when(non_empty(we_peak), F.lit("peak"))
    return F.when(peak.isNull(), F.lit(None).cast("string")).when(is_weekday, weekday).otherwise(weekend)


def minute_bits(hits) -> Column:
    """24 longs, one an hour: bit ``m`` tells ``hits(second of day of minute m)``."""
    def hour(h):
        return F.aggregate(
            F.sequence(F.lit(0), F.lit(59)), F.lit(0).cast("bigint"),
            lambda acc, m: acc.bitwiseOR(F.when(hits(h * 3600 + m * 60), F.call_function(
                "shiftleft", F.lit(1).cast("bigint"), m)).otherwise(F.lit(0).cast("bigint"))))
    return F.transform(F.sequence(F.lit(0), F.lit(23)), hour)


def compile_hours(peak: Column) -> Column:
    """A tenant's weekday lists as minute-of-day bitmaps; the weekend is one flag (K6).

    ``peak`` and ``off``: minutes inside a range of the list.  ``split``: minutes within
    which a range begins or ends (a bound with seconds); they are told by the second
    from ``exact``, the lists themselves, kept only for tenants that have such bounds.
    """
    lists = [peak["weekday_peak"], peak["weekday_off_peak"]]

    def inside(t, seconds):
        return (seconds >= t) & (seconds < t + 60) & (F.pmod(seconds, F.lit(60)) != 0)

    def splits(t):
        cut = [F.exists(ranges, lambda r: inside(t, hhmm_seconds(r["start"])) | inside(t, hhmm_seconds(r["end"])))
               for ranges in lists]
        return F.coalesce(cut[0], F.lit(False)) | F.coalesce(cut[1], F.lit(False))

    odd = [F.coalesce(F.exists(ranges, lambda r: (F.pmod(hhmm_seconds(r["start"]), F.lit(60)) != 0)
                               | (F.pmod(hhmm_seconds(r["end"]), F.lit(60)) != 0)), F.lit(False)) for ranges in lists]
    with_seconds = odd[0] | odd[1]
    return F.when(peak.isNotNull(), F.struct(
        non_empty(lists[0]).alias("has_weekday"), F.coalesce(non_empty(peak["weekend_peak"]), F.lit(False)).alias("weekend"),
        minute_bits(lambda t: in_any_range(lists[0], t)).alias("peak"),
        minute_bits(lambda t: in_any_range(lists[1], t)).alias("off"),
        F.when(with_seconds, minute_bits(splits)).alias("split"),
        F.when(with_seconds, peak).alias("exact"),
    ))


def period_at(hours: Column, is_weekday: Column, t: Column) -> Column:
    """K5 + K6 by position in the bitmaps of ``compile_hours``: no range is read per slot."""
    hour = F.floor(t / 3600).cast("int")
    minute = F.floor((t % 3600) / 60).cast("int")

    def at(bits):
        return F.call_function("shiftright", F.get(bits, hour), minute).bitwiseAND(F.lit(1).cast("bigint")) == 1

    weekday = (
        F.when(~hours["has_weekday"], F.lit(None).cast("string"))
        .when(at(hours["split"]), calculated_period(hours["exact"], is_weekday, t))
        .when(at(hours["peak"]), F.lit("peak"))
        .when(at(hours["off"]), F.lit("off_peak"))
        .otherwise(F.lit("peak"))
    )
    return (F.when(hours.isNull(), F.lit(None).cast("string")).when(is_weekday, weekday)
            .otherwise(F.when(hours["weekend"], F.lit("peak"))))


def label_periods(avail: DataFrame, organizations: DataFrame, courts: DataFrame | None,
                  known_zones: list[str], as_of=None, horizon_days: int = 7,
                  dow_zone: str = "utc", bitmaps: bool = False) -> DataFrame:
    """P11 ``fct_court_availability``.

    ``avail``: client_code, source_system, court_id, court_name, slot_start,
    slot_end, period_type, created_at.  ``organizations``: client_code,
    peak_hours (JSON text), operating_hours (JSON text).  ``courts``:
    court_id, client_code, court_label (optional).

    Time of day is the slot's local time in the facility zone (Q1, stated
    intent); the weekday comes from the stored UTC instant unless
    ``dow_zone='local'``.  An unknown zone name falls back to the default
    zone instead of failing the job.  ``bitmaps``: the ranges are compiled once a
    tenant (``compile_hours``) and slots are told by position; the rows are the same.
    """
    a = avail
    if as_of is not None:
        start = F.lit(as_of).cast("timestamp")
        a = a.filter((F.col("slot_start") >= start)
                     & (F.col("slot_start") <= start + F.expr(f"make_interval(0, 0, 0, {int(horizon_days)})")))
    org = organizations.select(
        "client_code",
        F.from_json("peak_hours", PEAK_HOURS_SCHEMA).alias("_peak"),
        F.from_json("operating_hours", OPERATING_HOURS_SCHEMA).alias("_oh"),
    )
    zone_raw = F.coalesce(F.col("_peak.timezone"), F.col("_oh.timezone"), F.lit(S.DEFAULT_FACILITY_ZONE))
    zone = F.when(zone_raw.isin(sorted(set(known_zones))), zone_raw).otherwise(F.lit(S.DEFAULT_FACILITY_ZONE))
    if bitmaps:
        org = org.select("client_code", zone.alias("_zone"), compile_hours(F.col("_peak")).alias("_hours"))
        zone = F.coalesce("_zone", F.lit(S.DEFAULT_FACILITY_ZONE))  # a slot without a tenant row
    a = a.join(org, "client_code", "left")
    if courts is not None:
        c = courts.select(F.col("court_id").cast("string").alias("_cid"), F.col("client_code").alias("_ccode"),
                          "court_label")
        a = a.join(c, (a["court_id"].cast("string") == c["_cid"]) & (a["client_code"] == c["_ccode"]), "left")
        name = F.coalesce(F.col("court_label"), F.col("court_name"))
    else:
        name = F.col("court_name")
    local = F.from_utc_timestamp(F.col("slot_start"), zone)
    t = F.hour(local) * 3600 + F.minute(local) * 60 + F.second(local)
    dow = S.dow_sunday0(local if dow_zone == "local" else F.col("slot_start"))
    is_weekday = dow.between(1, 5)
    calc = period_at(F.col("_hours"), is_weekday, t) if bitmaps else calculated_period(F.col("_peak"), is_weekday, t)
    return a.select(
        S.surrogate_key(F.col("client_code"), F.col("source_system"), F.col("court_id").cast("string"),
                        S.pg_timestamptz_text(F.col("slot_start"))).alias("availability_pk"),
        "client_code", "source_system", F.col("court_id").cast("string").alias("court_id"),
        "slot_start", "slot_end",
        S.minutes_between("slot_start", "slot_end").alias("duration_minutes"),
        "created_at",
        name.alias("court_name"),
        F.coalesce(calc, F.col("period_type")).alias("period_type"),
    )
