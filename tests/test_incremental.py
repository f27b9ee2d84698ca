"""Builds over touched tenant-days: equal to the full build, other files left alone."""

from __future__ import annotations

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from courtgrid.operators import daymask
from courtgrid.plans import incremental as I
from courtgrid.plans import models as P

AVAIL = ("client_code STRING, source_system STRING, court_id STRING, court_name STRING, slot_start TIMESTAMP, "
         "slot_end TIMESTAMP, period_type STRING")
AS_OF, HORIZON = "2025-01-01", 7
HALF = dt.timedelta(minutes=30)


def _openings(rng, tenants, days, share=0.6):
    out = []
    for tenant in tenants:
        for day in days:
            for half in [0, 1, 2, 3, 44, 45, 46, 47]:
                for court in ("1", "2"):
                    if rng.random() < share:
                        start = dt.datetime(2025, 1, day) + half * HALF
                        out.append((tenant, "courtreserve", court, f"Court #{court}", start, start + HALF, None))
    return out


def _times(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs
            if f.endswith(".parquet")}


def _day_of(file):
    parts = file.split("/")
    return parts[-3].split("=")[1], parts[-2].split("=")[1]


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_slots_equal_the_full_build_after_each_batch(spark, tmp_path):
    rng, raw, mart = random.Random(5), str(tmp_path / "raw"), str(tmp_path / "fe")
    batches = [
        (_openings(rng, ["007", "b", "c"], [2, 3, 4, 5]), []),
        (_openings(rng, ["b"], [3]), []),
        (_openings(rng, ["c"], [4]) + [(None, *_openings(rng, ["x"], [4], 1)[0][1:])], [("007", dt.date(2025, 1, 5)), (None, None)]),
    ]
    changed = [None, {("b", "2025-01-02"), ("b", "2025-01-03")},
               {("c", "2025-01-03"), ("c", "2025-01-04"), ("007", "2025-01-04"), ("007", "2025-01-05")}]
    state, full = {}, spark.createDataFrame([], AVAIL)
    for (rows, cleared), days in zip(batches, changed):
        before = _times(mart)
        for key in {(r[0], r[4].date()) for r in rows} | set(cleared):
            state[key] = [r for r in rows if (r[0], r[4].date()) == key]
        I.availability_batch(spark.createDataFrame(rows, AVAIL), raw, mart, AS_OF, HORIZON,
                             spark.createDataFrame(cleared, "client_code STRING, day DATE"))
        kept = [r for (tenant, _), rs in state.items() if tenant for r in rs]
        full = daymask.compose_slots(spark.createDataFrame(kept, AVAIL), AS_OF, HORIZON)
        assert _rows(I.read(spark, mart, full.schema)) == _rows(full)
        if days is not None:
            after = _times(mart)
            assert {_day_of(f) for f in before.keys() ^ after.keys()} == days  # the others keep their files
            assert all(after[f] == t for f, t in before.items() if f in after)
    kinds = {r.slot_type for r in full.collect()}
    assert {"hour", "two_hour"} <= kinds
    assert full.filter((F.hour("slot_start") == 23) & (F.col("slot_type") == "two_hour")).count() > 0  # over midnight


def test_days_before_and_after_a_batch_are_not_read(spark, tmp_path):
    rng, raw, mart = random.Random(6), str(tmp_path / "raw"), str(tmp_path / "fe")
    first = spark.createDataFrame(_openings(rng, ["a", "b"], [1, 2, 3, 4, 5, 6]), AVAIL)
    I.availability_batch(first, raw, mart, AS_OF, HORIZON)
    for file in _times(raw):  # a day that is not needed cannot be read any more
        if _day_of(file)[1] not in ("2025-01-02", "2025-01-03", "2025-01-04"):
            with open(file, "wb") as f:
                f.write(b"unreadable")
    I.availability_batch(spark.createDataFrame(_openings(rng, ["b"], [3]), AVAIL), raw, mart, AS_OF, HORIZON)


def test_events_and_empty_batches(spark, tmp_path):
    schema = ("client_code STRING, source_system STRING, event_id STRING, event_name STRING, event_description STRING, "
              "event_type STRING, event_start_time TIMESTAMP, event_end_time TIMESTAMP, num_registrants INT, max_registrants INT, "
              "admission_rate_regular DOUBLE, admission_rate_member DOUBLE, created_at TIMESTAMP, _day STRING")
    raw, mart = str(tmp_path / "raw"), str(tmp_path / "events")

    def event(tenant, n, day):
        t = dt.datetime(2025, 1, day, 10)
        return (tenant, "podplay", n, "Open Play 3.5+", None, "OPEN_PLAY", t, t, 1, 4, 1.0, 1.0, t, "own")
    one = spark.createDataFrame([event("a", "1", 1), event("a", "2", 2), event("b", "3", 1)], schema).drop("_day")
    two = spark.createDataFrame([event("a", "4", 1), event("a", "5", 1)], schema).drop("_day")
    want = P.fct_events(P.classify_events(one))
    I.events_batch(one.limit(0), raw, mart)
    assert I.read(spark, mart, want.schema).count() == 0
    I.events_batch(one, raw, mart)
    assert _rows(I.read(spark, mart, want.schema)) == _rows(want)
    for _ in range(2):  # a batch run again changes nothing
        I.events_batch(two, raw, mart)
        now = P.fct_events(P.classify_events(one.filter("event_id <> '1'").unionByName(two)))
        assert _rows(I.read(spark, mart, want.schema)) == _rows(now)


def test_tables_in_groups_equal_the_full_build(spark, tmp_path):
    """Files grow with groups and days, not with tenants; other tenants of a folder keep their rows."""
    rng, raw, mart = random.Random(7), str(tmp_path / "raw"), str(tmp_path / "fe")
    tenants = [f"t{n}" for n in range(40)]
    batches = [(_openings(rng, tenants, [2, 3, 4], 0.3), []), (_openings(rng, ["t3"], [3]), [("t5", dt.date(2025, 1, 3))]),
               (_openings(rng, ["t7", "new"], [5]), [(None, None)])]
    state = {}
    for rows, cleared in batches:
        for key in {(r[0], r[4].date()) for r in rows} | set(cleared):
            state[key] = [r for r in rows if (r[0], r[4].date()) == key]
        days = {d for _, d in state if d}
        before = _times(raw)
        I.availability_batch(spark.createDataFrame(rows, AVAIL), raw, mart, AS_OF, HORIZON,
                             spark.createDataFrame(cleared, "client_code STRING, day DATE"), groups=2)
        full = daymask.compose_slots(spark.createDataFrame([r for rs in state.values() for r in rs], AVAIL), AS_OF, HORIZON)
        assert _rows(I.read(spark, mart, full.schema, groups=2)) == _rows(full)
        assert len(_times(raw)) <= 2 * len(days)
    own = {r[4].date().isoformat() for r in batches[-1][0]}
    assert {_day_of(f)[1] for f in before.keys() ^ _times(raw).keys()} == own  # other days keep their files


def test_a_put_that_died_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    rng, raw = random.Random(8), str(tmp_path / "raw")
    days = [spark.createDataFrame([(t, dt.date(2025, 1, d)) for t in "ab"], "client_code STRING, _day DATE") for d in (2, 3)]
    rows = [spark.createDataFrame(_openings(rng, "ab", [d]), AVAIL) for d in (2, 3)]
    with monkeypatch.context() as died:
        died.setattr(I, "_finish", lambda *_: None)
        I.put(rows[0], "slot_start", days[0], raw, 2)
    I.put(rows[1], "slot_start", days[1], raw, 2)
    assert _rows(I.read(spark, raw, rows[0].schema, groups=2)) == _rows(rows[0].unionByName(rows[1]))


def test_a_big_folder_is_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "ROWS_PER_FILE", 5)
    batch, raw = spark.createDataFrame(_openings(random.Random(9), "ab", [2], 1), AVAIL), str(tmp_path / "raw")
    I.put(batch, "slot_start", I.touched_days(batch, "slot_start"), raw)
    assert len(_times(raw)) > 4  # two folders of 16 rows and a blank one
    assert _rows(I.read(spark, raw, batch.schema)) == _rows(batch)
