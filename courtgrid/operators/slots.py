"""Slot composition: 30-minute openings -> one-hour,
two-hour, cross-court and orphan slots.

Plan shape (all DataFrame operators, no UDF):

* L1/L2 ``halves``: a filter + projection of the availability table.
* L3: one window pass partitioned by the court-hour group
  ``(client, system, court, hour, period)`` collects the (tiny) sets of
  first-half ends and second-half starts, so every row knows whether it is
  part of a full hour, an orphan, or a truly orphaned half.  A court-hour holds
  at most a few distinct slots, so the window partitions stay small whatever
  the data size, and one shuffle replaces the reference's five self joins.
* L4: group full-hour courts by ``(client, system, hour, period)``.
* L5–L9: hour ``h`` is paired with hour ``h + 1`` by an equi join on the
  shifted hour; courts of both hours meet in one aggregate per pair, whose
  arrays are bounded by the number of courts of a facility.
* L10–L12: orphans are rows flagged by the L3 window; cross-court pairs are
  an equi join on the hour with a ``court_id <>`` residual.
* L13/L14: union with a slot type, durations, keys.

Groups are per court-hour or per facility-hour, never per facility or per
system, so a tenant holding a third of all rows is still spread over all
its hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as S

GROUP = ["client_code", "source_system", "court_id", "hour_start", "period_type"]
HOUR_KEY = ["client_code", "source_system", "hour_start", "period_type"]
OUTPUT_COLUMNS = [
    "availability_pk", "slot_pk", "client_code", "source_system", "slot_start", "slot_end",
    "available_courts_count", "available_courts", "duration_minutes", "duration_display",
    "period_type", "slot_type",
]


def _names(values: Column) -> Column:
    """``string_agg(distinct x, ', ' order by x)`` over a bounded group."""
    return F.array_join(F.array_sort(F.collect_set(values)), ", ")


def base_window(avail: DataFrame, as_of, horizon_days: int = 7) -> DataFrame:
    """L1 / F2: slots starting in ``[as_of, as_of + horizon]`` (upper edge inclusive).

    ``as_of`` is a date literal text or a Column; ``current_date()`` is only
    the caller's default.
    """
    start = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of.cast("timestamp")
    end = start + F.expr(f"make_interval(0, 0, 0, {int(horizon_days)})")
    return avail.filter((F.col("slot_start") >= start) & (F.col("slot_start") <= end))


def halves(avail: DataFrame, as_of="2024-01-01", horizon_days: int = 7) -> DataFrame:
    """L1 + L2: 30-minute slots of the window, half position, hour start, sentinel period."""
    base = base_window(avail, as_of, horizon_days)
    minute = F.minute("slot_start")
    return (
        base.filter(S.rounded_minutes("slot_start", "slot_end") == 30)
        .select(
            "client_code", "source_system", F.col("court_id").cast("string").alias("court_id"),
            "court_name", "slot_start", "slot_end",
            S.to_sentinel(F.col("period_type")).alias("period_type"),
            F.date_trunc("hour", "slot_start").alias("hour_start"),
            F.when(minute == 0, F.lit("first_half"))
            .when(minute == 30, F.lit("second_half"))
            .otherwise(F.lit("other")).alias("half_position"),
        )
        .filter(F.col("half_position") != "other")
    )


def flag_halves(h: DataFrame) -> DataFrame:
    """L3 + L10: one window pass over each court-hour group.

    Adds ``full_hour`` (a first half whose end is the start of a second half
    of the same group), ``orphan`` (no contiguous partner half in the group)
    and ``truly_orphan`` (no partner half at all in the group).
    """
    w = Window.partitionBy(*GROUP)
    first = F.col("half_position") == "first_half"
    second_starts = F.collect_set(F.when(~first, F.col("slot_start"))).over(w)
    first_ends = F.collect_set(F.when(first, F.col("slot_end"))).over(w)
    return h.select(
        "*",
        F.when(first, F.array_contains(second_starts, F.col("slot_end")))
        .otherwise(F.array_contains(first_ends, F.col("slot_start"))).alias("_contiguous"),
        F.when(first, F.size(second_starts) > 0).otherwise(F.size(first_ends) > 0).alias("_partner"),
    ).select(
        *h.columns,
        (first & F.col("_contiguous")).alias("full_hour"),
        (~F.col("_contiguous")).alias("orphan"),
        (~F.col("_partner")).alias("truly_orphan"),
    )


def first_half_names(h: DataFrame) -> DataFrame:
    """Court display names by (client, system, court, hour) from first-half rows
    (any period); the system keeps equal court ids of two systems apart (Q8)."""
    return (
        h.filter(F.col("half_position") == "first_half")
        .select("client_code", "source_system", "court_id", "hour_start",
                S.court_display_name(F.col("court_name"), F.col("court_id")).alias("display_name"))
        .distinct()
    )


def full_hour_courts(flagged: DataFrame) -> DataFrame:
    """L3 result: (client, system, court, hour, period) with both halves."""
    return flagged.filter("full_hour").select(*GROUP).distinct()


def hour_slots(fh_named: DataFrame) -> DataFrame:
    """L4: one-hour slots per (client, system, hour, period)."""
    return (
        fh_named.groupBy(*HOUR_KEY)
        .agg(
            F.countDistinct("court_id").alias("available_courts_count"),
            _names(F.col("display_name")).alias("available_courts"),
        )
        .select(
            "client_code", "source_system",
            F.col("hour_start").alias("slot_start"),
            (F.col("hour_start") + F.expr("INTERVAL 1 HOUR")).alias("slot_end"),
            "available_courts_count", "available_courts", "period_type",
        )
    )


def two_hour_slots(hours: DataFrame, fh_named: DataFrame, display_zone: str = "UTC") -> DataFrame:
    """Consecutive one-hour slots of the same client, system and period.

    A court free in both hours is listed by name; courts free in one hour
    only are listed with that hour's range, and only when the other hour
    also has such a court.  Count = least of the two hour counts.
    """
    h1 = hours.select(
        "client_code", "source_system", "period_type",
        F.col("slot_start").alias("hour1"),
        F.col("available_courts_count").alias("n1"),
    )
    h2 = hours.select(
        "client_code", "source_system", "period_type",
        (F.col("slot_start") - F.expr("INTERVAL 1 HOUR")).alias("hour1"),
        F.col("available_courts_count").alias("n2"),
    )
    pairs = h1.join(h2, ["client_code", "source_system", "period_type", "hour1"], "inner")
    pair_key = ["client_code", "source_system", "period_type", "hour1"]

    # Courts of hour 1 and hour 2 of every pair, with their display names.
    c1 = fh_named.select(
        "client_code", "source_system", "period_type",
        F.col("hour_start").alias("hour1"), "court_id", "display_name", F.lit(1).alias("which"),
    )
    c2 = fh_named.select(
        "client_code", "source_system", "period_type",
        (F.col("hour_start") - F.expr("INTERVAL 1 HOUR")).alias("hour1"),
        "court_id", "display_name", F.lit(2).alias("which"),
    )
    courts = c1.unionByName(c2).join(pairs.select(*pair_key), pair_key, "left_semi")

    h1_end = F.col("hour1") + F.expr("INTERVAL 1 HOUR")
    h2_end = F.col("hour1") + F.expr("INTERVAL 2 HOURS")
    range1 = F.concat(F.lit(" ("), S.time_label(F.col("hour1"), display_zone), F.lit("-"),
                      S.time_label(h1_end, display_zone), F.lit(")"))
    range2 = F.concat(F.lit(" ("), S.time_label(h1_end, display_zone), F.lit("-"),
                      S.time_label(h2_end, display_zone), F.lit(")"))
    in1 = F.col("which") == 1
    per_court = (
        courts.groupBy(*pair_key, "court_id")
        .agg(
            F.max(in1.cast("int")).alias("in1"),
            F.max((~in1).cast("int")).alias("in2"),
            F.min(F.when(in1, F.col("display_name"))).alias("name1"),
            F.min(F.when(in1, F.concat(F.col("display_name"), range1))).alias("disp1"),
            F.min(F.when(~in1, F.concat(F.col("display_name"), range2))).alias("disp2"),
        )
        .select(
            *pair_key,
            ((F.col("in1") == 1) & (F.col("in2") == 1)).alias("both"),
            F.when(F.col("in1") == 1, F.lit(1)).otherwise(F.lit(2)).alias("which"),
            F.when((F.col("in1") == 1) & (F.col("in2") == 1), F.col("name1"))
            .when(F.col("in1") == 1, F.col("disp1"))
            .otherwise(F.col("disp2")).alias("court_display"),
        )
    )
    agg = per_court.groupBy(*pair_key).agg(
        F.sum(F.when(~F.col("both") & (F.col("which") == 1), 1).otherwise(0)).alias("p1"),
        F.sum(F.when(~F.col("both") & (F.col("which") == 2), 1).otherwise(0)).alias("p2"),
        F.collect_list(F.struct("both", "which", "court_display")).alias("courts"),
    )
    kept = F.filter(
        F.col("courts"),
        lambda x: x["both"]
        | ((x["which"] == 1) & (F.col("p2") > 0))
        | ((x["which"] == 2) & (F.col("p1") > 0)),
    )
    return (
        agg.join(pairs, pair_key, "inner")
        .select(
            "client_code", "source_system",
            F.col("hour1").alias("slot_start"),
            (F.col("hour1") + F.expr("INTERVAL 2 HOURS")).alias("slot_end"),
            F.least("n1", "n2").alias("available_courts_count"),
            F.array_join(F.array_sort(F.transform(kept, lambda x: x["court_display"])), ", ")
            .alias("available_courts"),
            "period_type",
        )
    )


def cross_court_slots(flagged: DataFrame, display_zone: str = "UTC") -> DataFrame:
    """A truly orphaned first half of one court with a truly orphaned
    second half of another court, same client/system/period/hour, contiguous.

    Equi join on the hour plus a ``court_id <>`` residual; pairs per hour are
    bounded by the courts of one facility.
    """
    f = flagged.filter((F.col("half_position") == "first_half") & F.col("truly_orphan"))
    s = flagged.filter((F.col("half_position") == "second_half") & F.col("truly_orphan"))
    key = ["client_code", "source_system", "period_type", "hour_start"]
    a = f.select(*key, F.col("court_id").alias("c1"), F.col("court_name").alias("n1"),
                 F.col("slot_start").alias("s1"), F.col("slot_end").alias("e1"))
    b = s.select(*key, F.col("court_id").alias("c2"), F.col("court_name").alias("n2"),
                 F.col("slot_start").alias("s2"), F.col("slot_end").alias("e2"))
    j = a.join(b, key, "inner").filter((F.col("c1") != F.col("c2")) & (F.col("e1") == F.col("s2")))

    def part(name, cid, st, en):
        return F.concat(S.court_display_name(F.col(name), F.col(cid)), F.lit(" ("),
                        S.time_label(F.col(st), display_zone), F.lit("-"),
                        S.time_label(F.col(en), display_zone), F.lit(")"))

    return j.select(
        "client_code", "source_system",
        F.col("hour_start").alias("slot_start"),
        (F.col("hour_start") + F.expr("INTERVAL 1 HOUR")).alias("slot_end"),
        F.lit(1).cast("bigint").alias("available_courts_count"),
        F.concat(part("n1", "c1", "s1", "e1"), F.lit(", "), part("n2", "c2", "s2", "e2"))
        .alias("available_courts"),
        "period_type",
    )


def orphan_slots(flagged: DataFrame, h: DataFrame) -> DataFrame:
    """L10 + L12: halves without a contiguous partner on the same court and
    period, grouped per half-hour with distinct court count and names."""
    orphans = flagged.filter("orphan").select(
        "client_code", "source_system", "slot_start", "slot_end", "period_type", "court_id")
    names = h.select(
        "client_code", "source_system", "court_id", "slot_start", "slot_end",
        S.court_display_name(F.col("court_name"), F.col("court_id")).alias("display_name"),
    ).distinct()
    return (
        orphans.join(names, ["client_code", "source_system", "court_id", "slot_start", "slot_end"], "left")
        .groupBy("client_code", "source_system", "slot_start", "slot_end", "period_type")
        .agg(
            F.countDistinct("court_id").alias("available_courts_count"),
            _names(F.col("display_name")).alias("available_courts"),
        )
        .select("client_code", "source_system", "slot_start", "slot_end",
                "available_courts_count", "available_courts", "period_type")
    )


class SlotPlan:
    """The shared sub-plans of one composition run (L1–L3), built once.

    Four consumers (hour, two-hour, cross-court, orphan) read the flagged
    halves.  Without materialising them each consumer would rescan the
    input and redo the window shuffle (column pruning makes the subtrees
    differ, so exchanges are not reused).  ``materialize='checkpoint'``
    (default) writes them once to the session's ``spark.checkpoint.dir``:
    the lineage is cut, executors lost later recompute nothing upstream,
    and the four branches read the written files.  ``'persist'`` caches
    instead; ``None`` keeps one lazy plan.
    """

    def __init__(self, avail: DataFrame, as_of="2024-01-01", horizon_days: int = 7,
                 display_zone: str = "UTC", materialize: str | None = "checkpoint"):
        self.display_zone = display_zone
        flagged = flag_halves(halves(avail, as_of, horizon_days))
        if materialize == "checkpoint":
            from ..session import ensure_checkpoint_dir
            ensure_checkpoint_dir(flagged.sparkSession)
            flagged = flagged.checkpoint(eager=True)
        elif materialize == "persist":
            flagged = flagged.persist()
        self.flagged = flagged
        self.h = flagged
        names = first_half_names(self.h)
        fh_named = full_hour_courts(self.flagged).join(
            names, ["client_code", "source_system", "court_id", "hour_start"], "left")
        # The full-hour courts feed the hour slots and both sides of the
        # two-hour pairing; materialising this (much smaller) set keeps those
        # five readers off the flagged halves.
        if materialize == "checkpoint":
            fh_named = fh_named.checkpoint(eager=True)
        elif materialize == "persist":
            fh_named = fh_named.persist()
        self.fh_named = fh_named
        self.hours = hour_slots(self.fh_named)

    def hour(self) -> DataFrame:
        return self.hours

    def two_hour(self) -> DataFrame:
        return two_hour_slots(self.hours, self.fh_named, self.display_zone)

    def cross_court(self) -> DataFrame:
        return cross_court_slots(self.flagged, self.display_zone)

    def orphan(self) -> DataFrame:
        return orphan_slots(self.flagged, self.h)

    def all(self) -> DataFrame:
        return finish(self.two_hour(), self.hours, self.cross_court(), self.orphan())


def finish(two_hour: DataFrame, hour: DataFrame, cross: DataFrame, orphan: DataFrame) -> DataFrame:
    """L13 + L14: union with slot type, duration, keys, sentinel back to null.

    ``availability_pk`` keeps the reference's key (client, start, end, type),
    which pairs of cross-court slots share (Q14); ``slot_pk`` adds system,
    period and the court text so every row has its own key.
    """
    parts = []
    for df, kind in ((two_hour, "two_hour"), (hour, "hour"), (cross, "cross_court_hour"), (orphan, "orphan")):
        parts.append(df.select(
            "client_code", "source_system", "slot_start", "slot_end",
            F.col("available_courts_count").cast("bigint").alias("available_courts_count"),
            "available_courts", "period_type", F.lit(kind).alias("slot_type")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return keyed(u)


def keyed(u: DataFrame) -> DataFrame:
    """L14 alone: keys and display columns of composed slots that bear their type."""
    pk = S.surrogate_key(F.col("client_code"), S.pg_timestamptz_text(F.col("slot_start")),
                         S.pg_timestamptz_text(F.col("slot_end")), F.col("slot_type"))
    slot_pk = S.surrogate_key(F.col("client_code"), F.col("source_system"),
                              S.pg_timestamptz_text(F.col("slot_start")),
                              S.pg_timestamptz_text(F.col("slot_end")), F.col("slot_type"),
                              F.col("period_type"), F.col("available_courts"))
    return u.select(
        pk.alias("availability_pk"),
        slot_pk.alias("slot_pk"),
        "client_code", "source_system", "slot_start", "slot_end",
        "available_courts_count", "available_courts",
        S.rounded_minutes("slot_start", "slot_end").alias("duration_minutes"),
        S.duration_text("slot_start", "slot_end").alias("duration_display"),
        S.from_sentinel(F.col("period_type")).alias("period_type"),
        "slot_type",
    )


def compose_slots(avail: DataFrame, as_of="2024-01-01", horizon_days: int = 7,
                  display_zone: str = "UTC", materialize: str | None = "checkpoint") -> DataFrame:
    """P12 ``fct_court_availability_fe``: the full slot composition."""
    return SlotPlan(avail, as_of, horizon_days, display_zone, materialize).all()
