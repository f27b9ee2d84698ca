"""Availability from busy islands.

A busy interval blocks the slot starts ``x`` with ``busy_start - length < x < busy_end``.
Overlapping intervals of a court are united day by day with a running maximum, and a
court-day of the opening hours meets its islands as one row: the join is a plain
equi join on (tenant, label, UTC day) without a range residual, and free starts are
written from the row.  An island is one join row for each day it touches (31 for a
month, where hour buckets take 720), a court-day one row (30 slots in the hour form).

Busy rows of equal day and start are reduced to their last end before the shuffle, so
repeated rows and rows that cover whole days cost one row a task.  The running maximum
is over one court's day: a court or tenant with a third of all rows is spread over
its days.  Islands of rows that do not end before they start are at least one slot
long, so a day holds at most ``1440 / slot_minutes + 1`` of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import availability as V

DAY_MICROS = 86_400_000_000


def _clip_days(df: DataFrame, first: str, last: str, keep: list[str]) -> DataFrame:
    """One row for each UTC day from ``first`` to ``last`` (microseconds, both inclusive), clipped to it."""
    day = F.col("day")

    def day_of(name):  # whole-number division: a quotient in doubles would round at the last microsecond
        return F.expr(f"({name} - pmod({name}, {DAY_MICROS})) div {DAY_MICROS}")

    days = df.select(*keep, first, last, F.explode(F.sequence(day_of(f"`{first}`"), day_of(f"`{last}`"))).alias("day"))
    return days.withColumn(first, F.greatest(F.col(first), day * DAY_MICROS)) \
        .withColumn(last, F.least(F.col(last), (day + 1) * DAY_MICROS - 1))


def day_islands(busy: DataFrame, slot_minutes: int = V.SLOT_MINUTES) -> DataFrame:
    """(client_code, court_label, day, islands): the blocked slot starts of a court's UTC
    day as a sorted list of disjoint (first, last) in microseconds, both inclusive.

    ``busy``: client_code, court_label, busy_start, busy_end.  Rows with a null time, or
    that end before they start, block nothing here (see ``subtract``).  Starts between
    two islands are free, the exact end of a busy row among them.
    """
    key = ["client_code", "court_label", "day"]
    blocked = busy.filter("busy_end >= busy_start").select(
        "client_code", "court_label",
        (F.unix_micros("busy_start") - int(slot_minutes) * 60_000_000 + 1).alias("first"),
        (F.unix_micros("busy_end") - 1).alias("last"))
    pieces = _clip_days(blocked, "first", "last", ["client_code", "court_label"]) \
        .groupBy(*key, "first").agg(F.max("last").alias("last"))
    by_start = Window.partitionBy(*key).orderBy("first")
    reach = F.max("last").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    starts = pieces.withColumn("opens", F.coalesce((F.col("first") > reach + 1).cast("int"), F.lit(0)))
    numbered = starts.withColumn("island", F.sum("opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    united = numbered.groupBy(*key, "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return united.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("islands"))


def subtract(spans: DataFrame, busy: DataFrame, slot_minutes: int = V.SLOT_MINUTES) -> DataFrame:
    """V5: free slots of opening spans (``availability.opening_spans``).

    Same rows as ``availability.subtract_busy`` on the grid of the spans.  Busy rows that end
    before they start, by less than a slot, block what the overlap test says of them: they
    go through the hour buckets of that function.  A null tenant or label matches nothing.
    """
    step = int(slot_minutes) * 60_000_000
    keep = ["client_code", "court_id", "court_label"]
    opened = spans.select(*keep, F.unix_micros("first_slot").alias("open"),
                          F.unix_micros("first_slot").alias("from"), F.unix_micros("last_slot").alias("to"))
    days = _clip_days(opened, "from", "to", keep + ["open"])
    # the first start on the span's own rhythm within the day
    begin = F.col("open") + F.ceil((F.col("from") - F.col("open")) / step) * step
    days = days.withColumn("from", begin).filter(F.col("from") <= F.col("to"))
    joined = days.join(day_islands(busy, slot_minutes), ["client_code", "court_label", "day"], "left")
    free = F.filter(
        F.sequence("from", "to", F.lit(step).cast("bigint")),
        lambda x: ~F.exists(F.coalesce("islands", F.array().cast("array<struct<first:bigint,last:bigint>>")),
                            lambda i: (x >= i["first"]) & (x <= i["last"])))
    slots = joined.select(*keep, F.explode(free).alias("x")).select(
        *keep, F.timestamp_micros("x").alias("slot_start"), F.timestamp_micros(F.col("x") + step).alias("slot_end"))
    backward = busy.filter((F.col("busy_end") < F.col("busy_start"))
                           & (F.unix_micros("busy_start") - F.unix_micros("busy_end") < step))
    return V.subtract_busy(slots, backward, slot_minutes)


def free_slots(courts: DataFrame, organizations: DataFrame, events: DataFrame | None,
               reservations: DataFrame | None, start_date, end_date, known_zones: list[str],
               source_system: str = "courtreserve") -> DataFrame:
    """V1–V5 end to end: the rows of ``availability.free_slots``."""
    spans = V.opening_spans(courts, organizations, start_date, end_date, known_zones)
    free = subtract(spans, V.busy_near(events, reservations, start_date, end_date))
    return V.availability_rows(free, source_system)
