"""The load queries compute their normalised rows once, however often the merge reads them."""

from __future__ import annotations

import datetime as dt

import pytest

from courtgrid.plans import load_job_queries as Q

T = dt.datetime(1994, 5, 1, 10)
EVENT = ("client_code string, source_system string, event_id string, event_name string, event_description string, "
         "event_type string, event_start_time timestamp, event_end_time timestamp, num_registrants long, "
         "max_registrants long, admission_rate_regular double, admission_rate_member double")
RESERVATION = ("client_code string, reservation_id string, event_id string, member_id string, "
               "reservation_created_at timestamp, reservation_updated_at timestamp, reservation_start_at timestamp, "
               "reservation_end_at timestamp, reservation_cancelled_at timestamp")
EVENTS = [("a" if i % 2 else None, "podplay", f"e{i % 7}", "n", None, "t", T, T, 1, None, 1.0, None) for i in range(20)]
RESERVATIONS = [("a", f"r{i % 6}", f"e{i}", None if i % 5 == 0 else f"m{i % 3}", T, T + dt.timedelta(days=200 * (i % 3)), T, T, None)
                for i in range(20)]


@pytest.mark.parametrize("query, source, rows, schema", [
    ("load_events_a", "json_events_a", EVENTS, EVENT),
    ("load_events_b", "json_events_b", EVENTS, EVENT),
    ("load_reservations_b", "json_participants", RESERVATIONS, RESERVATION),
])
def test_rows_are_computed_once(spark, monkeypatch, query, source, rows, schema):
    seen = spark.sparkContext.accumulator(0)

    def count(row):
        seen.add(1)
        return row
    made = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(count), schema)
    monkeypatch.setattr(Q.PQ, source, lambda spark, sf_dir: made)
    assert getattr(Q, query)(spark, "").count() > 0
    assert seen.value == len(rows)
