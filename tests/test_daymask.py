"""Slots from day masks: the brute-force model of test_slots, the window form of the
operator, hours over midnight, rows off the half hours, and the plan."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from courtgrid.operators import daymask as M
from courtgrid.operators import slots as L

from .test_slots import DAY, SCHEMA, _key, brute, slot, t


def compose(spark, rows):
    out = M.compose_slots(spark.createDataFrame(rows, SCHEMA), as_of="2025-01-06", horizon_days=7).collect()
    return sorted(((r.slot_type, r.slot_start, r.slot_end, r.available_courts_count, r.available_courts,
                    r.period_type) for r in out), key=_key)


@pytest.mark.parametrize("seed", [11, 12])
def test_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = set()
    for _ in range(70):
        court = rnd.choice("abcd")
        name = None if court == "d" else rnd.choice([f"Court {court.upper()}", f"Court {court.upper()}!"])
        rows.add(slot(court, rnd.choice([6, 7, 8, 22, 23, 24, 25]), rnd.choice([0, 30, 0, 30, 15]),
                      rnd.choice([None, "PEAK"]), name=name, minutes=rnd.choice([30, 30, 30, 60]),
                      client=rnd.choice(["c1", "c2"])))
    rows = sorted(rows, key=lambda r: tuple("" if x is None else str(x) for x in r))
    assert compose(spark, rows) == brute(rows)


def test_equals_the_window_form_with_keys(spark):
    rnd = random.Random(5)
    rows = sorted({slot(rnd.choice("abc"), rnd.randint(0, 60), rnd.choice([0, 30]), rnd.choice([None, "PEAK"]))
                   for _ in range(150)}, key=str)
    df = spark.createDataFrame(rows, SCHEMA)
    new, old = M.compose_slots(df, "2025-01-06"), L.compose_slots(df, "2025-01-06")
    assert new.schema == old.schema
    assert new.exceptAll(old).isEmpty() and old.exceptAll(new).isEmpty()


def test_two_hours_over_midnight(spark):
    rows = [slot("a", h, m) for h in (23, 24) for m in (0, 30)]
    two = [r for r in compose(spark, rows) if r[0] == "two_hour"]
    assert two == [("two_hour", t(23), t(25), 1, "Court A", None)]


def test_repeated_rows_extra_columns_and_empty_table(spark):
    rows = [slot("a", 9, 0), slot("a", 9, 30), slot("a", 10, 0)]
    assert compose(spark, rows * 50) == compose(spark, rows)
    clash = spark.createDataFrame([r + (1, 2, 3) for r in rows], SCHEMA + ", mask long, day int, hour int")
    assert M.compose_slots(clash, "2025-01-06").count() == 2
    assert compose(spark, []) == []


def test_off_grid_rows_fail_the_job_by_name(spark):
    late = ("c1", "sys", "a", "Court A", t(9) + dt.timedelta(seconds=5), t(9, 30) + dt.timedelta(seconds=5), None)
    with pytest.raises(Exception, match="compose_slots"):
        compose(spark, [slot("a", 10, 0), late])
    hour_long = ("c1", "sys", "a", "Court A", DAY, DAY + dt.timedelta(hours=1), None)
    assert compose(spark, [hour_long]) == []


def test_plan_has_two_exchanges_and_no_join(spark):
    rows = [slot("a", 9, 0), slot("a", 9, 30)]
    plan = M.compose_slots(spark.createDataFrame(rows, SCHEMA), "2025-01-06") \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Join" not in plan and "Window" not in plan
