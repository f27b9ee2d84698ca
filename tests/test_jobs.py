"""End-to-end jobs on landed files: reservations load twice,
availability replace, model build."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from courtgrid.plans import jobs as J
from courtgrid.sources import snapshot as SN


def _land(base, tenant, name, records, ok=True):
    d = os.path.join(base, f"client_code={tenant}")
    os.makedirs(d, exist_ok=True)
    body = {"ErrorMessage": None if ok else "boom", "IsSuccessStatusCode": ok, "Data": records}
    with open(os.path.join(d, name), "w") as fh:
        json.dump(body, fh)


def _res(rid, start, updated, players, cancelled=None):
    return {"Id": rid, "ReservationTypeId": 1, "ReservationTypeName": "Court Reservation", "StartTime": start,
            "EndTime": start.replace("T10", "T11"), "CreatedOnUtc": "2025-01-01T00:00:00Z", "UpdatedOnUtc": updated,
            "CancelledOnUtc": cancelled, "Courts": "Court #1",
            "Players": [{"OrganizationMemberId": p} for p in players]}


def test_reservations_load_twice(spark, tmp_path):
    landing, snap, wm = str(tmp_path / "landing"), str(tmp_path / "snap"), str(tmp_path / "wm")
    _land(landing, "pklyn", "p1.json", [_res(1, "2025-01-06T10:00:00", "2025-01-02T00:00:00", [11, 12]),
                                        _res(2, "2025-01-07T10:00:00", "2025-01-02T00:00:00", [13])])
    _land(landing, "pklyn", "bad.json", None, ok=False)
    audit = J.reservations_load(spark, landing, snap, wm, "2025-01-05 00:00:00", mode="full")
    assert audit["snapshot_version"] == 1 and audit["rejected_responses"] == 1
    assert SN.read_latest(spark, snap).count() == 3
    # second load: reservation 1 moved (new start), reservation 2 cancelled
    _land(landing, "pklyn", "p2.json", [_res(1, "2025-01-08T10:00:00", "2025-01-05T00:00:00", [11, 12]),
                                        _res(2, "2025-01-07T10:00:00", "2025-01-05T00:00:00", [13],
                                             cancelled="2025-01-05T01:00:00Z")])
    audit = J.reservations_load(spark, landing, snap, wm, "2025-01-06 00:00:00", mode="incremental")
    cur = SN.read_latest(spark, snap)
    rows = sorted((r.reservation_id, r.member_id, r.reservation_start_at.day) for r in cur.collect())
    assert rows == [("1", "11", 8), ("1", "12", 8)]
    w = {r.source_name: r.last_loaded_at for r in SN.read_latest(spark, wm).collect()}
    assert str(w["reservations__pklyn"]) == "2025-01-06 00:00:00"


def test_availability_load_clears_tenant(spark, tmp_path):
    snap = str(tmp_path / "avail")
    orgs = spark.createDataFrame(
        [("t1", json.dumps({"timezone": "UTC", "monday": {"open": "10:00", "close": "11:00"}})),
         ("t2", json.dumps({"timezone": "UTC"}))], "client_code string, operating_hours string")
    courts = spark.createDataFrame([("t1", "1", "Court #1"), ("t2", "2", "Court #2")],
                                   "client_code string, court_id string, court_label string")
    busy = spark.createDataFrame([], "client_code string, courts array<string>, start timestamp, end timestamp, "
                                     "cancelled string")
    J.availability_load(spark, courts, orgs, busy, snap, "2025-01-06", "2025-01-06")
    assert SN.read_latest(spark, snap).count() == 2


def test_model_build(spark, tmp_path):
    from courtgrid.plans import model_queries as MQ
    sf = "/root/testdata/sf0.001"
    raw = {"organizations": MQ.organizations_view(spark, sf), "members_raw": MQ.members_raw_view(spark, sf),
           "reservations_raw": MQ.reservations_raw_view(spark, sf), "facility_events_raw": MQ.events_raw_view(spark, sf)}
    out = str(tmp_path / "marts")
    written = J.model_build(spark, raw, out, "2024-01-01")
    assert written == ["dim_clients", "dim_members", "fct_reservations", "fct_events"]
    assert spark.read.parquet(os.path.join(out, "fct_events")).filter(F.col("skill_level").isNull()).count() == 0


def test_reservations_load_partitioned(spark, tmp_path):
    landing, snap, wm = str(tmp_path / "landing"), str(tmp_path / "snap"), str(tmp_path / "wm")
    _land(landing, "a", "p1.json", [_res(1, "2025-01-06T10:00:00", "2025-01-02T00:00:00", [11])])
    _land(landing, "b", "p1.json", [_res(2, "2025-01-06T10:00:00", "2025-01-02T00:00:00", [12])])
    J.reservations_load(spark, landing, snap, wm, "2025-01-05 00:00:00", mode="full", layout="partitioned")
    b_files = sorted(os.listdir(os.path.join(snap, "client_code=b")))
    _land(landing, "a", "p2.json", [_res(1, "2025-01-09T10:00:00", "2025-01-05T00:00:00", [11])])
    J.reservations_load(spark, landing, snap, wm, "2025-01-06 00:00:00", mode="full", layout="partitioned")
    assert sorted(os.listdir(os.path.join(snap, "client_code=b"))) == b_files
    got = sorted((r.client_code, r.reservation_start_at.day) for r in spark.read.parquet(snap).collect())
    assert got == [("a", 9), ("b", 6)]
