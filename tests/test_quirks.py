"""Quirk ledger cases not covered elsewhere: Q3, Q8, Q9,
Q12, Q14, Q16, Q24, Q29."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from courtgrid.functions import scalars as S
from courtgrid.operators import merge as M
from courtgrid.operators import quality as Q
from courtgrid.operators import slots as L
from courtgrid.plans import models as P
from courtgrid.sources import payloads as PL
from courtgrid.sources import system_a as A
from courtgrid.sources import system_b as B

D = dt.datetime(2025, 1, 6)
SLOT = ("client_code string, source_system string, court_id string, court_name string, "
        "slot_start timestamp, slot_end timestamp, period_type string")


def _slot(court, h, m, system="s1", client="c"):
    s = D + dt.timedelta(hours=h, minutes=m)
    return (client, system, court, f"Court {court.upper()}", s, s + dt.timedelta(minutes=30), None)


def test_q3_stage_key_has_tenant(spark):
    rows = [(t, "ev", D, D, "m", None, D, 1) for t in ("t1", "t2")]
    df = spark.createDataFrame(rows, "client_code string, event_id string, reservation_start_at timestamp, "
                                     "reservation_created_at timestamp, member_id string, "
                                     "reservation_updated_at timestamp, created_at timestamp, _pos int")
    assert M.stage_dedupe(df, M.RES_STAGE_KEY, "reservation_updated_at", "created_at", "_pos").count() == 2


def test_q8_two_hours_stay_within_one_system(spark):
    rows = [_slot("a", 17, 0), _slot("a", 17, 30), _slot("a", 18, 0, "s2"), _slot("a", 18, 30, "s2")]
    out = L.compose_slots(spark.createDataFrame(rows, SLOT), "2025-01-06", 7, materialize=None)
    assert out.filter("slot_type = 'two_hour'").count() == 0
    assert out.filter("slot_type = 'hour'").count() == 2


def test_q14_cross_court_pairs_share_reference_key(spark):
    rows = [_slot("a", 5, 0), _slot("b", 5, 30), _slot("c", 5, 30)]
    out = L.compose_slots(spark.createDataFrame(rows, SLOT), "2025-01-06", 7, materialize=None)
    cross = out.filter("slot_type = 'cross_court_hour'").collect()
    assert len(cross) == 2
    assert cross[0].availability_pk == cross[1].availability_pk
    assert cross[0].slot_pk != cross[1].slot_pk


def test_q24_display_zone(spark):
    rows = [_slot("a", 22, 0), _slot("b", 22, 30)]
    out = L.compose_slots(spark.createDataFrame(rows, SLOT), "2025-01-06", 7, display_zone="America/New_York",
                          materialize=None)
    text = out.filter("slot_type = 'cross_court_hour'").first().available_courts
    assert text == "Court A (5 PM-5:30 PM), Court B (5:30 PM-6 PM)"


def test_q9_category_name_fallback(spark):
    ev = spark.createDataFrame([("c", '{"Id": "1", "EventCategoryName": "Clinic", "StartDateTime": "2025-01-06T10:00:00"}')],
                               "client_code string, payload string")
    recs = PL.parse_records(ev, "payload", PL.A_EVENT, keep=("client_code",), alt_schema=PL.A_EVENT_ALT)
    r = A.normalize_events(recs, None, S.known_zone_names(spark)).first()
    assert r.event_type == "Clinic"
    assert r.event_description is None  # Q16: system A has no description key


def test_q16_system_b_blank_description(spark):
    ev = spark.createDataFrame([("c", '{"id": "e1", "name": "x"}')], "client_code string, payload string")
    r = B.normalize_events(PL.parse_records(ev, "payload", PL.B_EVENT, keep=("client_code",)),
                           S.known_zone_names(spark)).first()
    assert r.event_description == ""


def _raw(spark, rows):
    return spark.createDataFrame(rows, "client_code string, reservation_id string, event_id string, member_id string, "
                                       "reservation_created_at timestamp, reservation_updated_at timestamp, "
                                       "reservation_start_at timestamp, reservation_end_at timestamp, "
                                       "reservation_cancelled_at timestamp, created_at timestamp")


def _orgs(spark):
    return P.stg_organizations(spark.createDataFrame(
        [(1, "courtreserve", "a"), (2, "podplay", "b")], "id bigint, source_system_code string, client_code string"))


def test_q12_shared_reservation_key_is_reported(spark):
    raw = _raw(spark, [("a", "r1", "e", m, D, D, D, D, None, D) for m in ("m1", "m2")])
    stg = P.stg_reservations(raw, _orgs(spark))
    got = {r.check_name: r.failing_rows for r in Q.run_checks([Q.TableChecks("stg", stg, unique=["reservation_pk"])]).collect()}
    assert got == {"unique": 1}


def test_q29_drop_cancelled_parameter(spark):
    raw = _raw(spark, [("b", "r1", "e", "m1", D, D, D, D, D, D), ("b", "r2", "e", "m1", D, D, D, D, None, D)])
    assert P.stg_reservations_b(raw, _orgs(spark)).count() == 2
    assert P.stg_reservations_b(raw, _orgs(spark), drop_cancelled=True).count() == 1


def test_stg_reservations_one_pass_equals_union(spark):
    raw = _raw(spark, [("A", "r1", "e", "m", D, D, D, D, None, D), ("b", None, "e2", "m", D, D, D, D, None, D),
                       ("x", "r3", "e", "m", D, D, D, D, None, D)])
    one = sorted(tuple(r) for r in P.stg_reservations(raw, _orgs(spark)).collect())
    two = sorted(tuple(r) for r in P.stg_reservations_union(raw, _orgs(spark)).collect())
    assert one == two and len(one) == 2
    assert {r[3] for r in one} == {"courtreserve", "podplay"}
