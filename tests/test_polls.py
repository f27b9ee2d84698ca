"""The ledger of the load jobs: a run reads new files only, newest polls win, vanished
rows go, late polls and restarts; records as VARIANT; one scan of the landing."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from courtgrid.functions import scalars as S
from courtgrid.plans import jobs as J
from courtgrid.plans import loads as LO
from courtgrid.sources import payloads as PL
from courtgrid.sources import snapshot as SN
from courtgrid.sources import system_b as B
from courtgrid.sources import variants as VA

NOW = "2025-01-06 00:00:00"


def land(base, poll, tenant, name, body):
    d = os.path.join(base, f"poll={poll}", f"client_code={tenant}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as fh:
        fh.write(body if isinstance(body, str) else json.dumps(body))


def orgs(spark):
    return spark.createDataFrame(
        [("t1", "podplay", True, None, "p1"), ("t2", "podplay", True, "", "p2"), ("a1", "courtreserve", True, None, "p3"),
         ("a2", "courtreserve", True, None, "p4")],
        "client_code string, source_system_code string, is_customer boolean, podplay_pod_id string, google_place_id string")


def run(spark, tmp_path, name, **kw):
    out = LO.run(spark, name, str(tmp_path / "landing"), str(tmp_path / "table"), NOW, orgs(spark),
                 rejects=str(tmp_path / "rejects"), **kw)
    return out, SN.read_latest(spark, str(tmp_path / "table"))


def judged_files(spark, tmp_path, version):
    path = f"{tmp_path}/table-ledger/staged/batch={version:08d}"
    return {os.path.basename(r[0]) for r in spark.read.parquet(path).select("_pos.file").distinct().collect()}


def good_a(records):
    return {"IsSuccessStatusCode": True, "Data": records}


def session(start, court="c1"):
    return {"status": "AVAILABLE", "startTime": start, "endTime": start.replace(":00:00Z", ":30:00Z"),
            "availableTables": {"items": [{"type": "FIXED_TABLE", "table": {"id": court, "displayName": court}}]}}


def user(i, first):
    return {"id": i, "firstName": first}


# name -> (body of a poll from a list of (key, mark), what a table row says as (tenant, key, mark), tenants)
BODIES = {
    "members_a": (lambda rs: {"IsSuccessStatusCode": True, "Data": {"Members": [
        {"MembershipNumber": k, "FirstName": m} for k, m in rs]}}, ("member_id", "first_name"), "a"),
    "members_b": (lambda rs: {"items": [user(k, m) for k, m in rs]}, ("member_id", "first_name"), "t"),
    "events_a": (lambda rs: good_a([{"Id": k, "EventName": m, "StartDateTime": "2025-01-07T10:00:00",
                                     "EndDateTime": "2025-01-07T11:00:00"} for k, m in rs]), ("event_id", "event_name"), "a"),
    "events_b": (lambda rs: {"items": [{"id": k, "type": "EVENT", "name": m, "startTime": "2025-01-07T10:00:00Z",
                                        "endTime": "2025-01-07T11:00:00Z"} for k, m in rs]}, ("event_id", "event_name"), "t"),
    "sessions_b": (lambda rs: {"items": [
        {**session(f"2025-01-07T{k}:00:00Z"), "periodType": m} for k, m in rs]}, ("slot_start", "period_type"), "t"),
    "reviews": (lambda rs: {"id": "place", "rating": 1.5, "userRatingCount": int(rs[-1][1][1:]) if rs else 0},
                ("review_service", "num_reviews"), None),
}


@pytest.mark.parametrize("name", list(BODIES))
def test_newest_poll_wins(spark, tmp_path, name):
    body, cols, kind = BODIES[name]
    whole = LO.LOADS[name].whole
    one, two = {"a": ("a1", "a2"), "t": ("t1", "t2"), None: ("t1", "a1")}[kind]
    base = str(tmp_path / "landing")
    keys = ["10", "11", "12"]

    def rows(frame):
        return {(r[0], str(r[1])[11:13] if name == "sessions_b" else "" if name == "reviews" else r[1], str(r[2]))
                for r in frame.select("client_code", *cols).collect()}

    def want(*parts):
        return {(t, "" if name == "reviews" else k, m[1:] if name == "reviews" else m) for t, k, m in parts}

    land(base, "01", one, "p1.json", body([(keys[0], "m1"), (keys[1], "m1")]))
    land(base, "01", two, "q1.json", body([(keys[0], "m1")]))
    out, table = run(spark, tmp_path, name)
    first = [(one, keys[0], "m1"), (one, keys[1], "m1"), (two, keys[0], "m1")]
    assert out["version"] == 1 and rows(table) == want(*first)
    # two polls landed between two runs: the newer one counts, what has vanished goes from whole loads
    land(base, "02", one, "p2.json", body([(keys[0], "m2"), (keys[2], "m2")]))
    land(base, "03", one, "p3.json", body([(keys[0], "m3")]))
    out, table = run(spark, tmp_path, name)
    kept = [] if whole else [(one, keys[1], "m1"), (one, keys[2], "m2")]
    if name == "reviews":
        kept = []
    assert rows(table) == want((one, keys[0], "m3"), *kept, (two, keys[0], "m1"))
    assert judged_files(spark, tmp_path, 2) == {"p2.json", "p3.json"}  # no file of the run before
    if name in ("members_a", "events_b"):  # the rules below are those of members_b and events_a
        return
    # a late older poll changes no row that is there
    land(base, "02", two, "q2.json", body([(keys[0], "m2")]))
    land(base, "02", one, "late.json", body([(keys[0], "m9"), (keys[1], "m9")]))
    out, table = run(spark, tmp_path, name)
    assert rows(table) == want((one, keys[0], "m3"), *(kept or []), (two, keys[0], "m2"))
    assert out["rejects"] == (2 if whole else 0)
    if whole:
        assert {r.reason for r in SN.read_latest(spark, str(tmp_path / "rejects")).collect()} == {"older poll"}
        # another page of the poll that stands extends it
        land(base, "03", one, "p3b.json", body([(keys[2], "m3")]))
        _, table = run(spark, tmp_path, name)
        assert rows(table) == want((one, keys[0], "m3"), (one, keys[2], "m3"), (two, keys[0], "m2"))


def test_an_empty_poll_clears_sessions_but_not_events(spark, tmp_path):
    for name, left in (("sessions_b", 0), ("events_b", 1)):
        at = tmp_path / name
        land(str(at / "landing"), "1", "t1", "a.json", BODIES[name][0]([("10", "m")]))
        run(spark, at, name)
        land(str(at / "landing"), "2", "t1", "b.json", {"items": []})
        assert run(spark, at, name)[1].count() == left


def test_a_batch_run_again_writes_the_same_version(spark, tmp_path):
    """A crash after the table was written: the batch comes again and starts from the state before it."""
    base = str(tmp_path / "landing")
    land(base, "1", "t1", "a.json", BODIES["sessions_b"][0]([("10", "m")]))
    run(spark, tmp_path, "sessions_b")
    land(base, "2", "t1", "b.json", BODIES["sessions_b"][0]([("11", "m"), ("12", "m")]))
    _, table = run(spark, tmp_path, "sessions_b")
    want = sorted(map(tuple, table.collect()))
    log = tmp_path / "table-ledger" / "checkpoint" / "commits"
    for f in ("1", ".1.crc"):
        (log / f).unlink(missing_ok=True)
    out, table = run(spark, tmp_path, "sessions_b")
    assert out["version"] == 2 and sorted(map(tuple, table.collect())) == want and len(want) == 2


def test_backlog_in_small_batches(spark, tmp_path):
    base = str(tmp_path / "landing")
    for k in range(5):
        land(base, "1", "t1", f"{k}.json", BODIES["sessions_b"][0]([(str(10 + k), "m")]))
    out, table = run(spark, tmp_path, "sessions_b", max_files=2)
    assert out["version"] == 3 and table.count() == 5


def test_every_record_is_loaded_or_rejected(spark, tmp_path):
    base = str(tmp_path / "landing")
    ev = {"id": "e", "type": "REGULAR", "startTime": "2025-01-07T10:00:00Z", "endTime": "2025-01-07T11:00:00Z"}
    res = {"id": "r", "bookedById": "u", "createdAt": "2025-01-01T00:00:00Z"}
    records = [{**ev, "reservations": {"items": [res]}}, {**ev, "reservations": {"items": [{**res, "updatedAt": "later"}]}},
               {**ev, "reservations": {"items": [res, {**res, "cancelledAt": "soon"}]}}, {**ev, "startTime": "noon"},
               {**ev, "reservations": "none"}, 7, None, {**ev, "unknown": [1, {"x": 2}]}]
    land(base, "1", "t1", "a.json", {"items": records})
    land(base, "1", "t9", "b.json", {"items": [ev]})
    land(base, "1", "t1", "c.json", '{"items": [')
    out, table = run(spark, tmp_path, "reservations_b")
    lost = SN.read_latest(spark, str(tmp_path / "rejects"))
    reasons = {r["reason"]: r["count"] for r in lost.groupBy("reason").count().collect()}
    assert reasons == {"time text": 3, "field type": 1, "record": 2, "tenant not in roster": 1, "response": 1}
    assert out["judged"] == len(records) + 2 and out["rejects"] == 8
    assert [tuple(r) for r in table.select("reservation_id", "member_id").collect()] == [("r", "u")]
    assert json.loads(lost.filter("reason = 'tenant not in roster'").first().record) == ev


def test_reservations_a_rejects_and_text_ids(spark, tmp_path):
    base = str(tmp_path / "landing")
    ok = {"Id": "R-8", "ReservationTypeId": 1, "ReservationTypeName": "Court Reservation", "StartTime": "2025-01-07T10:00:00",
          "EndTime": "2025-01-07T11:00:00", "CreatedOnUtc": "2025-01-01T00:00:00Z", "UpdatedOnUtc": "2025-01-02T00:00:00Z",
          "Players": [{"OrganizationMemberId": "M-1"}, {"OrganizationMemberId": 12}]}
    land(base, "1", "a1", "a.json", good_a([ok, {**ok, "Id": 9, "StartTime": "soon"}, {**ok, "Id": 10, "Players": {}}]))
    land(base, "1", "zz", "b.json", good_a([ok]))
    land(base, "1", "a1", "c.json", {"ErrorMessage": "boom", "IsSuccessStatusCode": True, "Data": []})
    audit = J.reservations_load(spark, base, str(tmp_path / "t"), str(tmp_path / "w"), NOW, mode="full",
                                organizations=orgs(spark), rejects=str(tmp_path / "r"))
    assert audit["rejects"] == 4 and audit["rejected_responses"] == 1
    got = SN.read_latest(spark, str(tmp_path / "t")).select("reservation_id", "member_id").collect()
    assert sorted(map(tuple, got)) == [("R-8", "12"), ("R-8", "M-1")]
    lost = {r.reason: r.record for r in SN.read_latest(spark, str(tmp_path / "r")).collect()}
    assert set(lost) == {"time text", "field type", "tenant not in roster", "response"}
    assert json.loads(lost["time text"])["StartTime"] == "soon" and "boom" in lost["response"]
    assert J.reservations_load(spark, base, str(tmp_path / "t"), str(tmp_path / "w"), NOW)["rejects"] == 0


def test_case_clashing_keys_and_numbers_in_variants(spark):
    df = spark.createDataFrame([(json.dumps({"Id": 1, "id": "low", "EventCategoryId": "x", "PriceInfo": [{"DailyPrice": 2.5}]}),),
                                (json.dumps({"id": True, "MaxRegistrants": 1.50, "Extra": None}),)], "t string")
    recs = VA.records(df.select(F.try_parse_json("t").alias("v")), PL.A_EVENT, PL.A_EVENT_ALT)
    rows = recs.select("f.Id", "f._alt.id", "f.MaxRegistrants", "f.PriceInfo", "fault").collect()
    assert [(r[0], r[1], r[2], r[4]) for r in rows] == [("1", "low", None, "field type"), (None, "true", "1.5", None)]
    assert rows[0][3][0].DailyPrice == 2.5


def test_the_landing_is_scanned_once(spark, tmp_path):
    base = str(tmp_path / "landing")
    land(base, "1", "t1", "a.json", {"items": [user("u", "x")]})
    load = LO.LOADS["members_b"]
    seen = []
    good, bad = LO.stage(spark, load, VA.responses(spark.read, base), None, str(tmp_path / "s"))
    rows, missing = LO.prepare(load, good, str(tmp_path / "r"), NOW, {})
    for df in (rows, missing, bad, good):
        seen += [f for f in df.inputFiles() if "/poll=" in f]
        assert "from_json" not in df._jdf.queryExecution().toString()
    assert rows.count() == 1 and not seen  # rows and rejects come from the staged table


def test_a_session_time_is_parsed_once(spark):
    df = spark.createDataFrame([], "client_code STRING, " + PL.B_SESSION)
    plan = B.normalize_sessions(df, "2024-01-29")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 4  # the plain and the rewritten form of two texts


def test_offsets_of_basic_and_extended_texts(spark):
    texts = ["20250106T100000-0500", "2025-01-06T10:00:00+01:00", "20250106T100000Z", "20250106", "2025-01-06 10:00", "20250106T1000", "2025-01-06Z"]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = [tuple(r) for r in rows.select(S.parse_iso_utc("t").cast("string"), S.parse_event_time("t").cast("string")).collect()]
    assert got == [("2025-01-06 15:00:00",) * 2, ("2025-01-06 09:00:00",) * 2, ("2025-01-06 10:00:00",) * 2,
                   ("2025-01-06 00:00:00", "2025-01-06 05:00:00"), ("2025-01-06 10:00:00", "2025-01-06 15:00:00"),
                   ("2025-01-06 10:00:00", "2025-01-06 15:00:00"), (None, None)]
