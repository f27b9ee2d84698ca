"""Slot composition over day bitmasks.

The same rows as ``slots.compose_slots``, from one 50-bit mask per (tenant,
system, day, court, period, display name): bit ``2h`` is the first half of hour
``h``, bit ``2h + 1`` the second.  Hour 0 of a day is also hour 24 of the day
before, so a two-hour slot over midnight is seen within one day.

* full hours: ``mask & (mask >> 1)`` on the even bits; lone halves: the even
  bits of ``mask & ~(mask >> 1)`` and of ``(mask >> 1) & ~mask``;
* a two-hour slot looks at the full-hour bits ``2h`` and ``2h + 2`` of a court;
* the courts of a facility meet in one aggregate per (tenant, system, day,
  period, hour), from which all four kinds of slots are written.

Rows are shuffled once into masks (with map-side ``bit_or``) and the masks, at
most one for 48 halves, once by facility-day; the later groupings refine that
key and shuffle nothing.  There is no self join and no checkpoint.  A group
holds the courts of one facility in one hour, so a tenant with a third of all
rows is spread over its days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .slots import base_window, keyed

DAY = ["client_code", "source_system", "day"]
# Bits of first halves: 0, 2, ... 48.
EVEN = sum(1 << (2 * h) for h in range(25))
OFF_GRID = ("a slot of 30 minutes starts or ends off the half hours: day masks cannot hold it, "
            "use slots.compose_slots for this table")


def on_grid(avail: DataFrame) -> DataFrame:
    """The 30-minute slots that composition reads, each exactly one half hour long.

    Slots of another length, or that start at another minute, take no part (as in
    ``slots.halves``).  A slot that counts as 30 minutes only by rounding, or starts
    some seconds after the half hour, fails the job with a message that names
    ``slots.compose_slots``: it is never left out unseen.
    """
    exact = ((F.unix_micros("slot_end") - F.unix_micros("slot_start") == 1_800_000_000)
             & (F.unix_micros("slot_start") % 1_800_000_000 == 0))
    return (avail.filter((S.rounded_minutes("slot_start", "slot_end") == 30) & F.minute("slot_start").isin(0, 30))
            .filter(F.when(exact, F.lit(True)).otherwise(F.raise_error(F.lit(OFF_GRID)).cast("boolean"))))


def day_masks(avail: DataFrame, as_of="2024-01-01", horizon_days: int = 7) -> DataFrame:
    """L1–L2: one row per tenant, system, day, court, period (sentinel form) and
    display name, with the mask of the halves open under that name.

    Repeated rows set the same bit.  A null tenant, system or court groups as a value.
    """
    rows = on_grid(base_window(avail, as_of, horizon_days))
    day = F.to_date("slot_start")
    half = F.hour("slot_start") * 2 + F.when(F.minute("slot_start") == 30, 1).otherwise(0)
    here = F.struct(day.alias("day"), half.alias("half"))
    before = F.struct(F.date_sub(day, 1).alias("day"), (half + 48).alias("half"))
    court_id = F.col("court_id").cast("string")
    placed = rows.select(
        "client_code", "source_system", court_id.alias("court_id"),
        S.to_sentinel(F.col("period_type")).alias("period_type"),
        S.court_display_name(F.col("court_name"), court_id).alias("name"),
        F.explode(F.when(half < 2, F.array(here, before)).otherwise(F.array(here))).alias("at"),
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at.half"))
    return (placed.groupBy("client_code", "source_system", F.col("at.day").alias("day"), "court_id", "period_type", "name")
            .agg(F.bit_or(bit).alias("mask")))


def _bit(mask: Column, position: Column) -> Column:
    return F.call_function("shiftright", mask, position).bitwiseAND(F.lit(1).cast("bigint"))


def court_hours(masks: DataFrame) -> DataFrame:
    """L3 + L10: one row per facility-day, court, period and hour that holds an opening.

    ``span``: 1 if the court is open for the whole hour, 2 for the whole next hour, 3
    for both.  ``lone``: 1 or 2 if only the first or second half of the hour is open.
    ``first``, ``next_first``, ``second``: names of the court at those halves in any
    period; ``own``: its names at the lone half in this period.
    """
    cell = F.struct("period_type", "name", "mask")
    courts = masks.repartition(*DAY).groupBy(*DAY, "court_id").agg(F.collect_list(cell).alias("cells"))
    periods = courts.select("*", F.explode(F.array_distinct(F.transform("cells", lambda c: c["period_type"])))
                            .alias("period_type"))
    zero = F.lit(0).cast("bigint")
    held = periods.select(
        *DAY, "court_id", "period_type", "cells",
        F.filter("cells", lambda c: c["period_type"] == F.col("period_type")).alias("mine"),
    ).withColumn("mask", F.aggregate("mine", zero, lambda acc, c: acc.bitwiseOR(c["mask"])))
    shifted = F.call_function("shiftright", F.col("mask"), F.lit(1))
    even = F.lit(EVEN).cast("bigint")
    bits = held.select(
        "*", F.col("mask").bitwiseAND(shifted).bitwiseAND(even).alias("full"),
        F.col("mask").bitwiseAND(F.bitwise_not(shifted)).bitwiseAND(even).alias("lone_first"),
        shifted.bitwiseAND(F.bitwise_not(F.col("mask"))).bitwiseAND(even).alias("lone_second"),
    )
    hours = bits.select("*", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")).select(
        *DAY, "court_id", "period_type", "hour", "cells", "mine",
        (_bit(F.col("full"), F.col("hour") * 2) + _bit(F.col("full"), F.col("hour") * 2 + 2) * 2).alias("span"),
        (_bit(F.col("lone_first"), F.col("hour") * 2) + _bit(F.col("lone_second"), F.col("hour") * 2) * 2).alias("lone"),
    ).filter("span > 0 OR lone > 0")

    def names(cells: str, position: Column) -> Column:
        open_then = F.filter(cells, lambda c: _bit(c["mask"], position) == 1)
        return F.array_distinct(F.transform(open_then, lambda c: c["name"]))

    start = F.col("hour") * 2
    return hours.select(
        *DAY, "period_type", "hour", "span", "lone",
        names("cells", start).alias("first"), names("cells", start + 2).alias("next_first"),
        names("cells", start + 1).alias("second"),
        names("mine", start + (F.col("lone") - 1).cast("int")).alias("own"),
    )


def facility_hours(hours: DataFrame) -> DataFrame:
    """The courts of a facility in one hour and period, as one row (no shuffle: the key
    refines the facility-day that the masks are dealt by)."""
    span, lone = F.col("span"), F.col("lone")
    return hours.groupBy(*DAY, "period_type", "hour").agg(
        F.count_if(span.isin(1, 3)).alias("n_first"), F.count_if(span.isin(2, 3)).alias("n_next"),
        F.count_if(span == 1).alias("only_first"), F.count_if(span == 2).alias("only_next"),
        F.count_if(lone == 1).alias("n_lone_first"), F.count_if(lone == 2).alias("n_lone_second"),
        F.collect_list(F.struct("span", "lone", "first", "next_first", "second", "own")).alias("courts"),
    )


def compose_slots(avail: DataFrame, as_of="2024-01-01", horizon_days: int = 7, display_zone: str = "UTC") -> DataFrame:
    """The rows of ``slots.compose_slots`` (columns too), from day masks.

    Empty input gives no rows; columns of ``avail`` beyond the seven read are ignored;
    repeated rows count once.  Slots off the half hours fail the job (``on_grid``).
    """
    fac = facility_hours(court_hours(day_masks(avail, as_of, horizon_days)))
    start = F.col("day").cast("timestamp") + F.make_dt_interval(hours=F.col("hour"))
    timed = fac.select(
        "*", start.alias("t0"), (start + F.expr("INTERVAL 30 MINUTES")).alias("t_half"),
        (start + F.expr("INTERVAL 1 HOUR")).alias("t1"), (start + F.expr("INTERVAL 2 HOURS")).alias("t2"))

    def between(a: str, b: str) -> Column:
        return F.concat(F.lit(" ("), S.time_label(F.col(a), display_zone), F.lit("-"),
                        S.time_label(F.col(b), display_zone), F.lit(")"))

    def listed(keep, field: str) -> Column:
        found = F.flatten(F.transform(F.filter("courts", keep), lambda c: c[field]))
        return F.array_join(F.array_sort(F.array_distinct(found)), ", ")

    def with_time(names: Column, a: str, b: str) -> Column:
        # inside the lambda, so that texts are made only for names that bear a time
        return F.transform(names, lambda n: F.concat(n, between(a, b)))

    def slot(kind: str, begin: str, end: str, count: Column, courts: Column) -> Column:
        return F.struct(F.lit(kind).alias("slot_type"), F.col(begin).alias("slot_start"), F.col(end).alias("slot_end"),
                        count.cast("bigint").alias("available_courts_count"), courts.alias("available_courts"))

    shown = F.transform(
        F.filter("courts", lambda c: (c["span"] == 3) | ((c["span"] == 1) & (F.col("only_next") > 0))
                 | ((c["span"] == 2) & (F.col("only_first") > 0))),
        lambda c: F.when(c["span"] == 3, F.array_min(c["first"]))
        .when(c["span"] == 1, F.array_min(with_time(c["first"], "t0", "t1")))
        .otherwise(F.array_min(with_time(c["next_first"], "t1", "t2"))))
    early = F.flatten(F.transform(F.filter("courts", lambda c: c["lone"] == 1), lambda c: with_time(c["own"], "t0", "t_half")))
    late = F.flatten(F.transform(F.filter("courts", lambda c: c["lone"] == 2), lambda c: with_time(c["own"], "t_half", "t1")))
    single = F.array_compact(F.array(
        F.when(F.col("n_first") > 0, slot("hour", "t0", "t1", F.col("n_first"),
                                          listed(lambda c: c["span"].isin(1, 3), "first"))),
        F.when((F.col("n_first") > 0) & (F.col("n_next") > 0),
               slot("two_hour", "t0", "t2", F.least("n_first", "n_next"), F.array_join(F.array_sort(shown), ", "))),
        F.when(F.col("n_lone_first") > 0, slot("orphan", "t0", "t_half", F.col("n_lone_first"),
                                               listed(lambda c: c["lone"] == 1, "first"))),
        F.when(F.col("n_lone_second") > 0, slot("orphan", "t_half", "t1", F.col("n_lone_second"),
                                                listed(lambda c: c["lone"] == 2, "second"))),
    ))
    cross = F.flatten(F.transform(early, lambda a: F.transform(
        late, lambda b: slot("cross_court_hour", "t0", "t1", F.lit(1), F.concat(a, F.lit(", "), b)))))
    return keyed(timed.select("client_code", "source_system", "period_type", F.inline(F.concat(single, cross))))
