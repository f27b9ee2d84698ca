"""Payload normalisers on landed JSON files."""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile

from courtgrid.functions import scalars as S
from courtgrid.sources import payloads as PL
from courtgrid.sources import places as PLC
from courtgrid.sources import system_a as A
from courtgrid.sources import system_b as B


def _land(objs, name):
    d = tempfile.mkdtemp(prefix=f"land-{name}-", dir="/tmp")
    for i, o in enumerate(objs):
        with open(os.path.join(d, f"r{i}.json"), "w") as fh:
            json.dump(o, fh)
    return d


def test_envelope_status_and_reservations(spark):
    good = {"ErrorMessage": None, "IsSuccessStatusCode": True, "Data": [
        {"Id": 7, "ReservationTypeId": 3, "ReservationTypeName": " Court Reservation ",
         "StartTime": "2025-01-06T10:00:00", "EndTime": "2025-01-06T11:00:00",
         "CreatedOnUtc": "2025-01-01T00:00:00Z", "UpdatedOnUtc": "2025-01-02T00:00:00",
         "CancelledOnUtc": "", "CancelledOn": "2025-01-03T00:00:00", "Courts": "Court #1",
         "Players": [{"OrganizationMemberId": 11}, {"OrganizationMemberId": None}]},
        {"Id": 8, "ReservationTypeName": "Lesson", "Players": [{"OrganizationMemberId": 1}]},
        {"Id": 9, "ReservationTypeName": "Court Reservation", "Players": None}]}
    bad = {"ErrorMessage": "quota", "IsSuccessStatusCode": False, "Data": None}
    env = PL.read_landed(spark, _land([good, bad], "res"), PL.envelope_a(PL.A_RESERVATION))
    ok, rejected = PL.split_status_a(env)
    assert rejected.count() == 1
    recs = PL.unwrap_a(ok).withColumn("client_code", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("PKLYN"))
    rows = A.normalize_reservations(recs).orderBy("member_id").collect()
    assert [(r.client_code, r.reservation_id, r.member_id) for r in rows] == [("pklyn", "7", None), ("pklyn", "7", "11")]
    r = rows[1]
    assert r.reservation_start_at == dt.datetime(2025, 1, 6, 15)     # naive = New York
    assert r.reservation_updated_at == dt.datetime(2025, 1, 2)       # naive = UTC
    assert r.reservation_cancelled_at == dt.datetime(2025, 1, 3)     # CancelledOn fallback (empty Utc)


def test_participants_and_booker(spark):
    ev = {"id": "e1", "type": "regular", "startTime": "2025-01-06T10:00:00Z", "endTime": "2025-01-06T11:00:00Z",
          "invitations": {"items": [
              {"status": "DECLINED", "inviteeProfile": {"id": "u9"}},
              {"status": "ACCEPTED", "inviteeProfile": {"id": " u1 "}},
              {"status": "ACCEPTED", "inviteeProfile": {"id": "u1"}},
              {"status": None, "invitee": {"email": "x@y.org"}}]},
          "reservations": {"items": [{"id": "r1", "createdAt": "2025-01-01T00:00:00Z", "bookedById": "host"}]}}
    recs = PL.read_landed(spark, _land([{"items": [ev], "_total": 1}], "ev"), PL.envelope_b(PL.B_EVENT))
    recs = PL.unwrap_b(recs).withColumn("client_code", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("g"))
    rows = B.normalize_event_reservations(recs).collect()
    assert sorted(r.member_id for r in rows) == ["host", "u1", "x@y.org"]
    assert all(r.reservation_updated_at == dt.datetime(2025, 1, 1) for r in rows)   # falls back to created
    assert all(r.reservation_start_at == dt.datetime(2025, 1, 6, 10) for r in rows)  # event start


def test_prices_and_events_a(spark):
    ev = {"Id": "", "id": "55", "Name": "", "name": "Mixer", "EventCategoryId": 4, "CategoryName": "",
          "EventType": "Drop-in", "StartDateTime": "2025-01-06T18:00:00", "TimeZone": "Bad/Zone",
          "RegisteredCount": "7", "MaxRegistrants": "x",
          "PriceInfo": [{"MembershipTypeName": "Non-Member Account", "EntireEventPrice": 0, "DailyPrice": 15},
                        {"MembershipTypeName": "Premium", "EntireEventPrice": 12},
                        {"MembershipTypeName": "Founder", "EntireEventPrice": 9}],
          "Courts": [{"Label": " Court #2 "}]}
    path = _land([ev], "eva")
    recs = PL.read_landed_text(spark, path, PL.A_EVENT, alt_schema=PL.A_EVENT_ALT)
    from pyspark.sql import functions as F
    recs = recs.withColumn("client_code", F.lit("c"))
    r = A.normalize_events(recs, None, S.known_zone_names(spark)).first()
    assert (r.event_id, r.event_name, r.event_type) == ("55", "Mixer", "Drop-in")
    assert (r.admission_rate_regular, r.admission_rate_member) == (15.0, 9.0)
    assert (r.num_registrants, r.max_registrants) == (7, None)
    assert r.event_start_time == dt.datetime(2025, 1, 6, 23)  # unknown zone -> New York default
    assert r.courts == ["Court #2"]


def test_members_phone_object_and_newest(spark):
    users = [{"id": "u1", "phoneNumber": {"phoneNumber": "", "id": "2345678901"}, "email": " A@B.com ",
              "memberships": {"items": [{"createdAt": "2024-01-01T00:00:00Z", "membership": {"id": "old"}},
                                        {"startedAt": "2024-06-01T00:00:00", "membership": {"id": "new"}}]}},
             {"id": "u2", "phoneNumber": "12345678901", "membershipType": "GOLD", "birthday": "1990-05-05T23:00:00-05:00"}]
    recs = PL.read_landed(spark, _land([{"items": users}], "users"), PL.envelope_b(PL.B_USER))
    from pyspark.sql import functions as F
    recs = PL.unwrap_b(recs).withColumn("client_code", F.lit("g"))
    rows = {r.member_id: r for r in B.normalize_members(recs).collect()}
    assert rows["u1"].phone_number == "+12345678901" and rows["u1"].email == "a@b.com"
    assert rows["u1"].newest_membership.membership.id == "new"
    assert (rows["u1"].membership_type_name, rows["u1"].is_premium_member) == ("NONE", 0)
    assert (rows["u2"].membership_type_name, rows["u2"].is_premium_member) == ("GOLD", 1)
    assert rows["u2"].date_of_birth == dt.date(1990, 5, 6)  # date of the UTC instant


def test_sessions_order_free_cutoff(spark):
    items = [{"startTime": "2025-01-07T10:00:00Z", "endTime": "2025-01-07T10:30:00Z", "status": "AVAILABLE",
              "periodType": "PEAK", "availableTables": {"items": [
                  {"type": "FIXED_TABLE", "table": {"id": "t1", "displayName": "", "displayNameShort": "T1"}},
                  {"type": "AUTO", "table": None}]}},
             {"startTime": "2025-01-05T10:00:00", "endTime": "2025-01-05T10:30:00", "status": "AVAILABLE",
              "availableTables": {"items": [{"type": "FIXED_TABLE", "table": {"id": "t2", "displayName": "Two"}}]}},
             {"startTime": "2025-01-05T11:00:00", "endTime": "2025-01-05T11:30:00", "status": "FULL"}]
    recs = PL.read_landed(spark, _land([{"items": items}], "sess"), PL.envelope_b(PL.B_SESSION))
    from pyspark.sql import functions as F
    recs = PL.unwrap_b(recs).withColumn("client_code", F.lit("g"))
    rows = B.normalize_sessions(recs, "2025-01-06 00:00:00").collect()
    # the late session comes first in the payload but only it is cut (Q13)
    assert [(r.court_id, r.court_name) for r in rows] == [("t2", "Two")]
    counts = {r.status: r for r in B.session_counts(recs, "2025-01-06 00:00:00").collect()}
    assert counts["AVAILABLE"].beyond_end == 1 and counts["FULL"].sessions == 1


def test_places(spark):
    place = {"id": "P1", "rating": 4.5, "userRatingCount": 10, "reviews": [{"name": "r"}], "photos": [{"name": "places/P1/photos/a"}]}
    from pyspark.sql import functions as F
    p = PL.read_landed(spark, _land([place], "pl"), PL.PLACE).withColumn("client_code", F.lit("c"))
    agg = PLC.review_aggregate(p).first()
    assert agg.link_to_reviews.endswith("place_id:P1") and agg.num_reviews == 10
    assert PLC.first_photo(p).first().photo_url.endswith("/places/P1/photos/a/media?maxWidthPx=800")
    assert PLC.reviews(p).count() == 1
