"""The load jobs on landed files: every record is loaded or rejected, a second
run changes nothing, unreadable responses and unknown tenants are rejects."""

from __future__ import annotations

import datetime as dt
import json
import os

from courtgrid.plans import checks as CK
from courtgrid.plans import loads as LO
from courtgrid.sources import snapshot as SN

NOW = "2025-01-06 00:00:00"


def _land(base, tenant, name, body):
    d = os.path.join(base, f"client_code={tenant}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as fh:
        fh.write(body if isinstance(body, str) else json.dumps(body))


def _orgs(spark):
    return spark.createDataFrame(
        [("t1", "podplay", True, None, None), (" T2 ", "podplay", True, "", "p2"), ("t3", "podplay", False, None, None),
         ("a1", "courtreserve", True, None, "p1")],
        "client_code string, source_system_code string, is_customer boolean, podplay_pod_id string, google_place_id string")


def _run(spark, tmp_path, name, **kw):
    at = {k: str(tmp_path / k) for k in ("snap", "wm", "rejects")}
    out = LO.run(spark, name, str(tmp_path / "landing"), at["snap"], NOW, _orgs(spark), watermarks=at["wm"],
                 rejects=at["rejects"], **kw)
    rejects = sorted(r.reason for r in SN.read_latest(spark, at["rejects"]).collect())
    return out, SN.read_latest(spark, at["snap"]), rejects, at


def _user(i, first="A"):
    return {"id": i, "firstName": first, "email": "x@y.org", "phoneNumber": {"phoneNumber": "2125550100"}}


def test_members_b(spark, tmp_path):
    land = str(tmp_path / "landing")
    _land(land, "t1", "1.json", {"items": [_user("u1", "first"), _user("u1", "second"), _user(None)], "_total": 3})
    _land(land, "t2", "1.json", {"items": [], "_total": 0})
    _land(land, "t3", "1.json", {"items": [_user("u9")], "_total": 1})
    _land(land, "t1", "broken.json", '{"items": [')
    out, cur, rejects, at = _run(spark, tmp_path, "members_b")
    assert out == {"version": 1, "rejects": 3, "judged": 6}
    assert [(r.client_code, r.member_id, r.first_name) for r in cur.collect()] == [("t1", "u1", "first")]
    assert rejects == ["missing key", "response", "tenant not in roster"]
    wm = {r.source_name: r.last_loaded_at for r in SN.read_latest(spark, at["wm"]).collect()}
    assert wm == {"members__t1": dt.datetime(2025, 1, 6), "members__t2": dt.datetime(2025, 1, 6)}
    out, again, _, _ = _run(spark, tmp_path, "members_b")  # no new file: nothing is read
    assert out == {"version": 1, "rejects": 0, "judged": 0} and sorted(again.collect()) == sorted(cur.collect())


def test_members_a_marks_tenants_with_rows_only(spark, tmp_path):
    land = str(tmp_path / "landing")
    _land(land, "a1", "1.json", {"IsSuccessStatusCode": True, "Data": {"Members": []}})
    out, cur, rejects, at = _run(spark, tmp_path, "members_a")
    assert cur.count() == 0 and rejects == [] and SN.read_latest(spark, at["wm"]).count() == 0


def test_events_a_case_clash_and_bad_time(spark, tmp_path):
    land = str(tmp_path / "landing")
    ev = {"Id": "1", "EventName": "x", "StartDateTime": "2025-01-07T10:00:00", "EndDateTime": "2025-01-07T11:00:00"}
    low = {"id": "2", "name": "low", "startTime": "2025-01-07T10:00:00Z", "endTime": "2025-01-07T11:00:00Z", "Timezone": "UTC"}
    _land(land, "a1", "1.json", {"IsSuccessStatusCode": True, "Data": [
        ev, low, {**ev, "EventName": "last"}, {**ev, "Id": "3", "StartDateTime": "soon"}, {"Id": "4"}]})
    _land(land, "a1", "2.json", {"Data": [ev]})
    _, cur, rejects, _ = _run(spark, tmp_path, "events_a")
    assert sorted((r.event_id, r.event_name) for r in cur.collect()) == [("1", "last"), ("2", "low")]
    assert rejects == ["missing key", "response", "time text"]


def test_sessions_b_clear_a_tenant(spark, tmp_path):
    land = str(tmp_path / "landing")
    table = {"type": "FIXED_TABLE", "table": {"id": "c1", "displayName": "One"}}
    s = {"status": "AVAILABLE", "startTime": "2025-01-07T10:00:00Z", "endTime": "2025-01-07T10:30:00Z",
         "availableTables": {"items": [table]}}
    _land(land, "t1", "1.json", {"items": [s]})
    _land(land, "t2", "1.json", {"items": [s, {**s, "startTime": "2025-02-07T10:00:00Z"}]})
    _, cur, _, _ = _run(spark, tmp_path, "sessions_b")
    assert sorted(r.client_code for r in cur.collect()) == ["t1", "t2"]
    _land(land, "t2", "2.json", {"items": []})
    _, cur, _, at = _run(spark, tmp_path, "sessions_b")
    assert [r.client_code for r in cur.collect()] == ["t1"]
    assert {r.source_name for r in SN.read_latest(spark, at["wm"]).collect()} == {
        "t1__court_availability", "t2__court_availability"}


def test_reservations_b_cancellations_a_and_reviews(spark, tmp_path):
    land = str(tmp_path / "landing")
    res = {"id": "r1", "createdAt": "2025-01-01T00:00:00Z", "bookedById": "u1"}
    _land(land, "t1", "1.json", {"items": [{"id": "e1", "type": "REGULAR", "startTime": "2025-01-07T10:00:00Z",
                                            "endTime": "2025-01-07T11:00:00Z", "reservations": {"items": [res, res]}}]})
    _, cur, rejects, _ = _run(spark, tmp_path, "reservations_b")
    assert [(r.reservation_id, r.member_id) for r in cur.collect()] == [("r1", "u1")] and rejects == []
    other = tmp_path / "c"
    c = {"EventId": 1, "EventDateId": 2, "OrganizationMemberId": 3, "StartTime": "2025-01-07T10:00:00",
         "CancelledOnUtc": "2025-01-05T10:00:00Z"}
    _land(str(other / "landing"), "a1", "1.json", {"IsSuccessStatusCode": True, "Data": [c, c]})
    for _ in range(2):
        _, cur, rejects, _ = _run(spark, other, "cancellations_a")
        assert cur.count() == 1 and rejects == []
    place = tmp_path / "p"
    _land(str(place / "landing"), "a1", "1.json", {"id": "p1", "rating": 4.5, "userRatingCount": 7})
    _land(str(place / "landing"), "t2", "1.json", "{}")
    _, cur, rejects, _ = _run(spark, place, "reviews")
    assert [(r.client_code, r.num_reviews, r.avg_review) for r in cur.collect()] == [("a1", 7, 4.5)]
    assert rejects == ["response"]


def test_fetch_windows_overlap(spark):
    wm = spark.createDataFrame([("members__t1", dt.datetime(2025, 1, 5, 22))], "source_name string, last_loaded_at timestamp")
    roster = spark.createDataFrame([("t1",)], "client_code string")
    w = LO.fetch_windows("members_a", wm, roster, NOW).collect()
    assert [(r.window_start, r.window_end) for r in w] == [(dt.datetime(2025, 1, 5, 20, 30), dt.datetime(2025, 1, 6))]


def test_model_checks_are_44():
    unique, not_null, rel = zip(*CK.MODEL_CHECKS.values())
    assert [sum(map(len, x)) for x in (unique, not_null, rel)] == [9, 29, 6]
