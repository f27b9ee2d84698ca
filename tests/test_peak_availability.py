"""Peak labelling (K1–K9) and availability by subtraction (V1–V5) golden cases."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from courtgrid.functions import scalars as S
from courtgrid.operators import availability as V
from courtgrid.operators import peak as K

AV = ("client_code string, source_system string, court_id string, court_name string, slot_start timestamp, "
      "slot_end timestamp, period_type string, created_at timestamp")


def _label(spark, peak, starts, tz_zone="UTC", raw=None):
    doc = None if peak is None else json.dumps({"timezone": tz_zone, **peak})
    org = spark.createDataFrame([("c", doc, None)], "client_code string, peak_hours string, operating_hours string")
    rows = [("c", "s", "1", "n", s, s + dt.timedelta(minutes=30), raw, s) for s in starts]
    av = spark.createDataFrame(rows, AV)
    out = K.label_periods(av, org, None, S.known_zone_names(spark)).orderBy("slot_start").collect()
    return [r.period_type for r in out]


WED = dt.datetime(2025, 1, 8)  # a Wednesday (UTC)
SAT = dt.datetime(2025, 1, 11)


def test_midnight_crossing_range(spark):
    peak = {"weekday_peak": [{"start": "22:00", "end": "02:00"}], "weekday_off_peak": [{"start": "02:00", "end": "06:00"}]}
    starts = [WED.replace(hour=1, minute=59), WED.replace(hour=2), WED.replace(hour=12), WED.replace(hour=23)]
    assert _label(spark, peak, starts) == ["peak", "off_peak", "peak", "peak"]


def test_end_exclusive_and_weekend(spark):
    peak = {"weekday_peak": [{"start": "17:00", "end": "21:00"}], "weekend_peak": [{"start": "08:00", "end": "09:00"}]}
    starts = [WED.replace(hour=21), WED.replace(hour=20, minute=30), SAT.replace(hour=22)]
    assert _label(spark, peak, starts) == ["peak", "peak", "peak"]  # 21:00 outside -> weekday default peak


def test_no_list_keeps_raw_period(spark):
    assert _label(spark, {"weekday_peak": []}, [WED], raw="PEAK") == ["PEAK"]
    assert _label(spark, None, [SAT], raw="OFF_PEAK") == ["OFF_PEAK"]
    assert _label(spark, {"weekend_peak": []}, [SAT], raw=None) == [None]


def test_local_time_of_day(spark):
    # 22:30 UTC is 17:30 in New York (winter): inside 17:00-21:00.
    peak = {"weekday_peak": [{"start": "17:00", "end": "21:00"}], "weekday_off_peak": [{"start": "00:00", "end": "17:00"}]}
    assert _label(spark, peak, [WED.replace(hour=22, minute=30)], tz_zone="America/New_York") == ["peak"]
    assert _label(spark, peak, [WED.replace(hour=16)], tz_zone="America/New_York") == ["off_peak"]


# ---------------------------------------------------------------------------
# Availability
# ---------------------------------------------------------------------------
def _grid(spark, hours, start, end, tz="UTC"):
    org = spark.createDataFrame([("c", json.dumps({"timezone": tz, **hours}))], "client_code string, operating_hours string")
    courts = spark.createDataFrame([("c", "1", "Court #1")], "client_code string, court_id string, court_label string")
    return V.opening_grid(courts, org, start, end, S.known_zone_names(spark))


def _days(o, c):
    return {d: {"open": o, "close": c} for d in V.WEEKDAYS}


def test_grid_counts(spark):
    assert _grid(spark, _days("07:00", "22:00"), "2025-01-06", "2025-01-06").count() == 30
    assert _grid(spark, _days("06:00", "02:00"), "2025-01-06", "2025-01-06").count() == 40
    assert _grid(spark, _days("07:00", "07:45"), "2025-01-06", "2025-01-06").count() == 1
    assert _grid(spark, {"tuesday": {"open": "07:00", "close": "08:00"}}, "2025-01-06", "2025-01-06").count() == 0
    g = _grid(spark, _days("07:00", "08:00"), "2025-01-06", "2025-01-13")
    assert g.select(F.to_date("slot_start")).distinct().count() == 8


def test_grid_daylight_saving(spark):
    # Spring: 2025-03-09 in New York, 01:00-04:00 local is 2 wall hours -> 4 slots.
    g = _grid(spark, _days("01:00", "04:00"), "2025-03-09", "2025-03-09", tz="America/New_York")
    assert g.count() == 4
    # Autumn: 2025-11-02, 01:00-03:00 local spans 3 real hours -> 6 slots.
    g = _grid(spark, _days("01:00", "03:00"), "2025-11-02", "2025-11-02", tz="America/New_York")
    assert g.count() == 6
    first = g.agg(F.min("slot_start")).first()[0]
    assert first == dt.datetime(2025, 11, 2, 5, 0)  # 01:00 EDT, the earlier instant


def _free(spark, busy_rows):
    grid = _grid(spark, _days("10:00", "12:00"), "2025-01-06", "2025-01-06")
    busy = spark.createDataFrame(busy_rows, "client_code string, court_label string, busy_start timestamp, busy_end timestamp")
    return sorted(r.slot_start.strftime("%H:%M") for r in V.subtract_busy(grid, busy).collect())


def test_overlap_rules(spark):
    d = dt.datetime(2025, 1, 6)
    assert _free(spark, [("c", "Court #1", d.replace(hour=10, minute=15), d.replace(hour=10, minute=45))]) == ["11:00", "11:30"]
    assert _free(spark, [("c", "Court #1", d.replace(hour=10, minute=30), d.replace(hour=11))]) == ["10:00", "11:00", "11:30"]
    assert _free(spark, [("c", "Court #9", d.replace(hour=10), d.replace(hour=12))]) == ["10:00", "10:30", "11:00", "11:30"]
    # zero-length busy inside a slot blocks it (reference test is strict on both sides)
    assert _free(spark, [("c", "Court #1", d.replace(hour=10, minute=40), d.replace(hour=10, minute=40))]) == [
        "10:00", "11:00", "11:30"]
    # a long busy interval across midnight of the previous day still blocks
    assert _free(spark, [("c", "Court #1", d - dt.timedelta(hours=20), d.replace(hour=11))]) == ["11:00", "11:30"]


def test_cancelled_reservation_blocks_nothing(spark):
    d = dt.datetime(2025, 1, 6)
    res = spark.createDataFrame([("c", ["Court #1"], d.replace(hour=10), d.replace(hour=12), "2025-01-01")],
                                "client_code string, courts array<string>, start timestamp, end timestamp, cancelled string")
    busy = V.busy_intervals(None, res)
    assert busy.count() == 0


def test_no_cartesian_in_overlap_plan(spark):
    d = dt.datetime(2025, 1, 6)
    grid = _grid(spark, _days("10:00", "12:00"), "2025-01-06", "2025-01-06")
    busy = spark.createDataFrame([("c", "Court #1", d, d)], "client_code string, court_label string, busy_start timestamp, busy_end timestamp")
    plan = V.subtract_busy(grid, busy)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_busy_from_payloads(spark):
    from courtgrid.sources import payloads as PL
    from courtgrid.sources import system_a as A
    ev = spark.createDataFrame([("c", '{"StartDateTime": "2025-01-06T05:00:00", "EndDateTime": "2025-01-06T06:00:00", '
                                      '"Courts": [{"Label": "Court #1"}, {"Label": ""}]}')], "client_code string, payload string")
    res = spark.createDataFrame([("c", '{"StartTime": "2025-01-06T06:00:00", "EndTime": "2025-01-06T06:30:00", '
                                       '"Courts": "Court #1", "CancelledOnUtc": "2025-01-01T00:00:00Z"}'),
                                 ("c", '{"StartTime": "2025-01-06T06:30:00", "EndTime": "2025-01-06T07:00:00", '
                                       '"Courts": "Court #1", "CancelledOn": "2025-01-01T00:00:00"}')],
                                "client_code string, payload string")
    e = A.event_busy(PL.parse_records(ev, "payload", PL.A_EVENT, keep=("client_code",), alt_schema=PL.A_EVENT_ALT))
    r = A.reservation_busy(PL.parse_records(res, "payload", PL.A_RESERVATION, keep=("client_code",)))
    busy = V.busy_intervals(e, r).orderBy("busy_start").collect()
    # event 10:00-11:00Z blocks; reservation with only CancelledOnUtc still blocks 11:00-11:30Z;
    # the one with CancelledOn blocks nothing
    assert [(b.court_label, b.busy_start.hour, b.busy_end.hour, b.busy_end.minute) for b in busy] == [
        ("Court #1", 10, 11, 0), ("Court #1", 11, 11, 30)]
