"""Busy islands and hour bitmaps: against the overlap test and the range test written out
in Python, on random rows with every odd case."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest

from courtgrid.functions import scalars as S
from courtgrid.operators import availability as V
from courtgrid.operators import islands as I
from courtgrid.operators import peak as K

from .test_peak_availability import AV, _days

D0 = dt.datetime(2025, 1, 6)
BUSY = "client_code string, court_label string, busy_start timestamp, busy_end timestamp"


def spans_of(spark, open_="06:10", close="02:00", first="2025-01-06", last="2025-01-08", zone="America/New_York"):
    org = spark.createDataFrame([(c, json.dumps({"timezone": zone, **_days(open_, close)})) for c in ("c", "d")],
                                "client_code string, operating_hours string")
    courts = spark.createDataFrame([("c", "1", "Court #1"), ("c", "2", "Court #2"), ("d", "1", "Court #1"), ("d", "2", None)],
                                   "client_code string, court_id string, court_label string")
    return V.opening_spans(courts, org, first, last, S.known_zone_names(spark)), \
        V.opening_grid(courts, org, first, last, S.known_zone_names(spark))


def free_by_hand(grid, busy):
    return sorted(str((g.client_code, g.court_id, g.slot_start)) for g in grid if not any(
        b[0] == g.client_code and b[1] is not None and b[1] == g.court_label and b[2] is not None and b[3] is not None
        and g.slot_start < b[3] and g.slot_end > b[2] for b in busy))


def free_by_islands(spans, busy_df):
    return sorted(str((r.client_code, r.court_id, r.slot_start)) for r in I.subtract(spans, busy_df).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_random_busy_rows(spark, seed):
    rnd = random.Random(seed)
    busy = [("c", "Court #1", D0 + dt.timedelta(hours=60, minutes=10), D0 + dt.timedelta(hours=60, minutes=40)),
            ("c", None, D0, D0 + dt.timedelta(days=9)), ("d", "Court #1", None, D0), (None, "Court #1", D0, D0)]
    for _ in range(40):
        start = D0 + dt.timedelta(minutes=rnd.randrange(0, 4 * 1440, 10), microseconds=rnd.choice([0, 0, 1]))
        minutes = rnd.choice([0, -10, -40, 10, 30, 45, 90, 400])
        busy.append((rnd.choice("cd"), rnd.choice(["Court #1", "Court #2"]), start, start + dt.timedelta(minutes=minutes)))
    spans, grid = spans_of(spark)
    assert free_by_islands(spans, spark.createDataFrame(busy + busy, BUSY)) == free_by_hand(grid.collect(), busy)


def test_daylight_saving_and_no_busy_rows(spark):
    for day in ("2025-03-09", "2025-11-02"):
        spans, grid = spans_of(spark, "01:00", "04:00", day, day)
        empty = spark.createDataFrame([], BUSY)
        assert free_by_islands(spans, empty) == free_by_hand(grid.collect(), [])


def test_month_of_overlapping_rows_is_one_island_a_day(spark):
    rows = [("c", "Court #1", D0 - dt.timedelta(days=3), D0 + dt.timedelta(days=27, hours=5))] * 300
    rows += [("c", "Court #1", D0 + dt.timedelta(hours=h), D0 + dt.timedelta(hours=h + 3)) for h in range(0, 600, 2)]
    found = I.day_islands(spark.createDataFrame(rows, BUSY)).collect()
    assert len(found) == 32 and all(len(r.islands) == 1 for r in found)  # 30.2 days widened by a slot
    spans, grid = spans_of(spark, last="2025-02-04")
    assert free_by_islands(spans, spark.createDataFrame(rows, BUSY)) == free_by_hand(grid.collect(), rows[:1])


def test_touching_rows_leave_the_start_between_them_free(spark):
    half = dt.timedelta(minutes=30)
    rows = [("c", "Court #1", D0, D0 + half), ("c", "Court #1", D0 + 2 * half, D0 + 4 * half)]
    (day,) = [r for r in I.day_islands(spark.createDataFrame(rows, BUSY)).collect()
              if r.day == (D0 - dt.datetime(1970, 1, 1)).days]
    assert len(day.islands) == 2 and day.islands[1]["first"] - day.islands[0]["last"] == 2


def test_island_plan_joins_without_a_residual(spark):
    spans, _ = spans_of(spark)
    plan = I.subtract(spans, spark.createDataFrame([("c", "Court #1", D0, D0)], BUSY))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


# ---------------------------------------------------------------------------
# Hour bitmaps
# ---------------------------------------------------------------------------
def _seconds(text):
    parts = [int(x) for x in text.split(":")]
    return parts[0] * 3600 + parts[1] * 60 + (parts[2] if len(parts) > 2 else 0)


def _inside(ranges, t):
    for r in ranges:
        if r["start"] is None or r["end"] is None:
            continue
        s, e = _seconds(r["start"]), _seconds(r["end"])
        if (s <= t < e) if s <= e else (t >= s or t < e):
            return True
    return False


def _by_hand(doc, local, utc, raw):
    if doc is None:
        return raw
    weekday, off, weekend = (doc.get(k) or [] for k in ("weekday_peak", "weekday_off_peak", "weekend_peak"))
    t = local.hour * 3600 + local.minute * 60 + local.second
    if utc.weekday() < 5:
        if not weekday:
            return raw
        return "peak" if _inside(weekday, t) else "off_peak" if _inside(off, t) else "peak"
    return "peak" if weekend else raw


@pytest.mark.parametrize("seed", [1, 2])
def test_bitmaps_equal_the_range_test(spark, seed):
    from zoneinfo import ZoneInfo
    rnd = random.Random(seed)

    def time_text():
        return rnd.choice(["00:00", "24:00", f"{rnd.randint(0, 23)}:{rnd.randint(0, 59):02d}",
                           f"{rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:{rnd.randint(0, 59):02d}"])

    def ranges():
        return rnd.choice([None, [], [{"start": time_text(), "end": time_text()} for _ in range(rnd.randint(1, 3))],
                           [{"start": None, "end": "10:00"}, {"start": "09:00", "end": "09:00:30"}]])

    docs = {f"t{i}": {"timezone": "America/New_York", "weekday_peak": ranges(), "weekday_off_peak": ranges(),
                      "weekend_peak": ranges()} for i in range(8)} | {"none": None}
    org = spark.createDataFrame([(c, None if d is None else json.dumps(d), None) for c, d in docs.items()],
                                "client_code string, peak_hours string, operating_hours string")
    zone, rows, expected = ZoneInfo("America/New_York"), [], {}
    marks = [_seconds(r[k]) for d in docs.values() if d for lst in d.values() if isinstance(lst, list)
             for r in lst for k in ("start", "end") if r[k]]
    days = [dt.datetime(2025, 3, 9), dt.datetime(2025, 11, 2), dt.datetime(2025, 3, 10), dt.datetime(2025, 1, 8)]
    for client in [*docs, "no tenant"]:
        for i in range(60):
            utc = rnd.choice(days) + dt.timedelta(seconds=rnd.randrange(86400))
            if i % 2 and marks:  # about the bounds themselves, five hours behind
                utc = dt.datetime(2025, 1, 8, 5) + dt.timedelta(seconds=rnd.choice(marks) + rnd.choice([-1, 0, 1, 29, 59]))
            raw = rnd.choice([None, "RAW"])
            local = utc.replace(tzinfo=dt.timezone.utc).astimezone(zone)
            rows.append((client, "s", str(i), "n", utc, utc + dt.timedelta(minutes=30), raw, utc))
            expected[(client, str(i))] = _by_hand(docs.get(client), local, utc, raw)
    out = K.label_periods(spark.createDataFrame(rows, AV), org, None, S.known_zone_names(spark), bitmaps=True).collect()
    assert {(r.client_code, r.court_id): r.period_type for r in out} == expected


def test_bitmaps_leave_the_ranges_out_of_the_slot_stage(spark):
    org = spark.createDataFrame([("c", json.dumps({"weekday_peak": [{"start": "17:00", "end": "21:00"}]}), None)],
                                "client_code string, peak_hours string, operating_hours string")
    av = spark.createDataFrame([("c", "s", "1", "n", D0, D0, None, D0)], AV)
    hours = K.label_periods(av, org, None, S.known_zone_names(spark), bitmaps=True)
    top = hours._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "shiftright" in top or ">>" in top
    assert "from_json" not in top and "JsonToStructs" not in top
