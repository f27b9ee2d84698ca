"""Availability by subtraction.

free = (courts x opening grid) - slots overlapping a busy interval on the
same court label.

* V1–V3 grid: each court row carries its tenant's opening hours; dates
  and 30-minute steps are generated with ``explode(sequence(..))`` per
  court, so the grid is built in parallel over courts (no join product).
  Wall-clock bounds are converted with ``to_utc_timestamp`` per row, steps
  run in UTC (daylight-saving days get 23 or 25 hours).
* V4 busy: events and active reservations, exploded over their court labels.
* V5 overlap: the reference tests every (busy, slot) pair.  Here each busy
  interval is exploded over the UTC hours it can touch (widened by one
  slot), each slot is keyed by the hour of its start, and a ``left_anti``
  equi join on (tenant, label, hour) carries the range test as a
  residual.  Hour buckets keep one court's busy rows spread over many
  join keys, so a hot court or tenant does not land in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .peak import OPERATING_HOURS_SCHEMA, hhmm_seconds

SLOT_MINUTES = 30
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def _day_hours(oh: Column, date: Column) -> Column:
    """Opening hours struct of the weekday of ``date`` (Monday first)."""
    idx = F.weekday(date)  # 0 = Monday
    expr = None
    for i, name in enumerate(WEEKDAYS):
        expr = F.when(idx == i, oh[name]) if expr is None else expr.when(idx == i, oh[name])
    return expr


def opening_grid(courts: DataFrame, organizations: DataFrame, start_date, end_date,
                 known_zones: list[str], slot_minutes: int = SLOT_MINUTES) -> DataFrame:
    """V1–V3: one row per (court, slot) of the opening hours, UTC.

    ``courts``: client_code, court_id, court_label.  ``organizations``:
    client_code, operating_hours (JSON text).  Every UTC date from
    ``start_date`` to ``end_date`` inclusive; a missing day, open or close
    gives no slots; close after midnight only when the close *hour* is
    below the open hour (V2); a partial last slot is dropped.
    """
    spans = opening_spans(courts, organizations, start_date, end_date, known_zones, slot_minutes)
    step = F.expr(f"INTERVAL {int(slot_minutes)} MINUTES")
    return spans.select(
        "client_code", "court_id", "court_label",
        F.explode(F.sequence(F.col("first_slot"), F.col("last_slot"), step)).alias("slot_start"),
    ).withColumn("slot_end", F.col("slot_start") + step)


def opening_spans(courts: DataFrame, organizations: DataFrame, start_date, end_date,
                  known_zones: list[str], slot_minutes: int = SLOT_MINUTES) -> DataFrame:
    """V1–V2: one row per court and opening day with its first slot (the opening time)
    and the latest start that a whole slot can have, UTC."""
    org = organizations.select(
        "client_code", F.from_json("operating_hours", OPERATING_HOURS_SCHEMA).alias("_oh"))
    zone_raw = F.coalesce(F.col("_oh.timezone"), F.lit("America/New_York"))
    zone = F.when(zone_raw.isin(sorted(set(known_zones))), zone_raw).otherwise(F.lit("America/New_York"))
    start = F.lit(start_date).cast("date") if isinstance(start_date, str) else start_date
    end = F.lit(end_date).cast("date") if isinstance(end_date, str) else end_date
    days = (
        courts.join(org, "client_code", "inner")
        .filter(F.col("_oh").isNotNull())
        .select("client_code", "court_id", "court_label", zone.alias("_zone"), "_oh",
                F.explode(F.sequence(start, end)).alias("_date"))
    )
    hours = _day_hours(F.col("_oh"), F.col("_date"))
    o, c = hhmm_seconds(hours["open"]), hhmm_seconds(hours["close"])
    open_local = F.col("_date").cast("timestamp") + F.make_dt_interval(secs=o)
    close_local = (F.col("_date").cast("timestamp") + F.make_dt_interval(secs=c)
                   + F.when(F.floor(c / 3600) < F.floor(o / 3600), F.expr("INTERVAL 1 DAY"))
                   .otherwise(F.expr("INTERVAL 0 DAY")))
    bounded = days.select(
        "client_code", "court_id", "court_label",
        F.to_utc_timestamp(open_local, F.col("_zone")).alias("_open"),
        F.to_utc_timestamp(close_local, F.col("_zone")).alias("_close"),
    ).filter(F.col("_open").isNotNull() & F.col("_close").isNotNull())
    step = F.expr(f"INTERVAL {int(slot_minutes)} MINUTES")
    last = F.col("_close") - step
    return bounded.filter(last >= F.col("_open")).select(
        "client_code", "court_id", "court_label", F.col("_open").alias("first_slot"), last.alias("last_slot"))


def busy_intervals(events: DataFrame | None, reservations: DataFrame | None) -> DataFrame:
    """V4: (client_code, court_label, busy_start, busy_end).

    ``events``: client_code, courts (array<string> of labels), start, end.
    ``reservations``: same plus ``cancelled`` (any non-null/true value
    means cancelled).  Rows without both times or without a court block
    nothing.
    """
    parts = []
    if events is not None:
        parts.append(events.select("client_code", "courts", "start", "end"))
    if reservations is not None:
        # Events and reservations may come as one frame (events carry a null
        # ``cancelled``), which reads the source once.
        parts.append(reservations.filter(F.col("cancelled").isNull() | (F.col("cancelled").cast("string") == ""))
                     .select("client_code", "courts", "start", "end"))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return (u.filter(F.col("start").isNotNull() & F.col("end").isNotNull())
            .select("client_code", F.explode("courts").alias("court_label"),
                    F.col("start").alias("busy_start"), F.col("end").alias("busy_end")))


def subtract_busy(grid: DataFrame, busy: DataFrame, slot_minutes: int = SLOT_MINUTES) -> DataFrame:
    """Grid slots not overlapping any busy interval of the
    same tenant and court label (``slot_start < end and slot_end > start``)."""
    widen = F.expr(f"INTERVAL {int(slot_minutes)} MINUTES")
    lo = F.date_trunc("hour", F.least("busy_start", "busy_end") - widen)
    hi = F.date_trunc("hour", F.greatest("busy_start", "busy_end"))
    b = busy.select(
        F.col("client_code").alias("_bc"), F.col("court_label").alias("_bl"), "busy_start", "busy_end",
        F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 HOUR"))).alias("_bh"),
    )
    g = grid.withColumn("_gh", F.date_trunc("hour", "slot_start"))
    cond = ((g["client_code"] == b["_bc"]) & (g["court_label"] == b["_bl"]) & (g["_gh"] == b["_bh"])
            & (g["slot_start"] < b["busy_end"]) & (g["slot_end"] > b["busy_start"]))
    return g.join(b, cond, "left_anti").drop("_gh")


def free_slots(courts: DataFrame, organizations: DataFrame, events: DataFrame | None,
               reservations: DataFrame | None, start_date, end_date, known_zones: list[str],
               source_system: str = "courtreserve") -> DataFrame:
    """V1–V5 end to end, in the shape of ``facility_court_availabilities``."""
    grid = opening_grid(courts, organizations, start_date, end_date, known_zones)
    free = subtract_busy(grid, busy_near(events, reservations, start_date, end_date))
    return availability_rows(free, source_system)


def busy_near(events: DataFrame | None, reservations: DataFrame | None, start_date, end_date) -> DataFrame:
    """V4 for the dates of a grid: busy rows that can touch it, clipped to its surroundings."""
    # local days reach at most a day over the UTC ones: older and later busy rows cannot matter
    lo = F.lit(str(start_date)).cast("timestamp") - F.expr("INTERVAL 1 DAY")
    hi = F.lit(str(end_date)).cast("timestamp") + F.expr("INTERVAL 2 DAYS")
    near = busy_intervals(events, reservations).filter((F.col("busy_start") < hi) & (F.col("busy_end") > lo))
    return near.withColumn("busy_start", F.greatest("busy_start", lo)).withColumn("busy_end", F.least("busy_end", hi))


def availability_rows(free: DataFrame, source_system: str) -> DataFrame:
    """Free slots in the shape of ``facility_court_availabilities``."""
    return free.select(
        "client_code", F.lit(source_system).alias("source_system"),
        F.col("court_id").cast("string").alias("court_id"),
        F.col("court_label").alias("court_name"), "slot_start", "slot_end",
        F.lit(None).cast("string").alias("period_type"),
    )


def parse_courts_any(courts_text: Column | None = None, courts_array: Column | None = None) -> Column:
    """Labels from the text form or the array-of-objects form."""
    if courts_array is not None and courts_text is not None:
        return F.coalesce(S.parse_courts_array(courts_array), S.parse_courts_text(courts_text))
    if courts_array is not None:
        return S.parse_courts_array(courts_array)
    return S.parse_courts_text(courts_text)
