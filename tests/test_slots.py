"""Slot composition: golden cases (FIXTURES §3) and a brute-force model of
the reference's self-join semantics on random small inputs."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest

from courtgrid.operators import slots as L

SCHEMA = ("client_code string, source_system string, court_id string, court_name string, "
          "slot_start timestamp, slot_end timestamp, period_type string")
DAY = dt.datetime(2025, 1, 6)


def t(h, m=0):
    return DAY + dt.timedelta(hours=h, minutes=m)


def slot(court, h, m, period=None, name="?", minutes=30, client="c1"):
    nm = f"Court {court.upper()}" if name == "?" else name
    return (client, "sys", court, nm, t(h, m), t(h, m) + dt.timedelta(minutes=minutes), period)


def compose(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = L.compose_slots(df, as_of="2025-01-06", horizon_days=7).collect()
    return sorted(((r.slot_type, r.slot_start, r.slot_end, r.available_courts_count, r.available_courts,
                    r.period_type) for r in out), key=_key)


def _key(row):
    return tuple((x is None, str(x)) for x in row)


def kinds(result, kind):
    return [r for r in result if r[0] == kind]


def test_full_hour(spark):
    res = compose(spark, [slot("a", 17, 0), slot("a", 17, 30)])
    assert kinds(res, "hour") == [("hour", t(17), t(18), 1, "Court A", None)]
    assert kinds(res, "orphan") == []


def test_period_split(spark):
    res = compose(spark, [slot("a", 17, 0, "PEAK"), slot("a", 17, 30, "OFF_PEAK")])
    assert kinds(res, "hour") == []
    assert len(kinds(res, "orphan")) == 2


def test_two_hours_cases(spark):
    full = [slot("a", 17, 0), slot("a", 17, 30), slot("a", 18, 0), slot("a", 18, 30), slot("b", 18, 0),
            slot("b", 18, 30)]
    res = kinds(compose(spark, full), "two_hour")
    assert res == [("two_hour", t(17), t(19), 1, "Court A", None)]
    res = kinds(compose(spark, [slot("a", 17, 0), slot("a", 17, 30), slot("b", 18, 0), slot("b", 18, 30)]),
                "two_hour")
    assert res == [("two_hour", t(17), t(19), 1, "Court A (5 PM-6 PM), Court B (6 PM-7 PM)", None)]
    rows = [slot(c, h, m) for c, h in (("a", 17), ("b", 17), ("a", 18), ("c", 18)) for m in (0, 30)]
    res = kinds(compose(spark, rows), "two_hour")
    assert res == [("two_hour", t(17), t(19), 2, "Court A, Court B (5 PM-6 PM), Court C (6 PM-7 PM)", None)]


def test_cross_court(spark):
    res = compose(spark, [slot("a", 5, 0), slot("b", 5, 30)])
    assert kinds(res, "cross_court_hour") == [
        ("cross_court_hour", t(5), t(6), 1, "Court A (5 AM-5:30 AM), Court B (5:30 AM-6 AM)", None)]
    assert len(kinds(res, "orphan")) == 2
    res = compose(spark, [slot("a", 5, 0), slot("b", 5, 30), slot("c", 5, 30)])
    assert len(kinds(res, "cross_court_hour")) == 2


def test_off_grid(spark):
    res = compose(spark, [slot("a", 5, 15), slot("b", 6, 0, minutes=60)])
    assert res == []


def test_null_name_fallback(spark):
    res = compose(spark, [slot("7", 9, 0, name=None), slot("7", 9, 30, name=None)])
    assert kinds(res, "hour")[0][4] == "Court 7"


# ---------------------------------------------------------------------------
# Brute force: the reference's self-join formulation, row by row.
# ---------------------------------------------------------------------------
def _label(x):
    return x.strftime("%-I %p") if x.minute == 0 else x.strftime("%-I:%M %p")


def brute(rows):
    half = []
    for (cl, sy, co, nm, s, e, p) in rows:
        if round((e - s).total_seconds() / 60) != 30:
            continue
        pos = {0: "first", 30: "second"}.get(s.minute, "other")
        half.append(dict(cl=cl, sy=sy, co=co, nm=nm, s=s, e=e, p=p or "NULL", h=s.replace(minute=0, second=0), pos=pos))
    disp = lambda r: r["nm"] if r["nm"] is not None else f"Court {r['co']}"
    fhc = set()
    for f1 in half:
        for f2 in half:
            if (f1["pos"], f2["pos"]) == ("first", "second") and all(f1[k] == f2[k] for k in ("cl", "sy", "co", "h", "p")) \
                    and f1["e"] == f2["s"]:
                fhc.add((f1["cl"], f1["sy"], f1["co"], f1["h"], f1["p"]))
    names1 = defaultdict(set)
    for r in half:
        if r["pos"] == "first":
            names1[(r["cl"], r["co"], r["h"])].add(disp(r))
    hours = defaultdict(set)
    for (cl, sy, co, h, p) in fhc:
        hours[(cl, sy, h, p)].add(co)
    out = []
    for (cl, sy, h, p), courts in hours.items():
        names = sorted({n for c in courts for n in names1[(cl, c, h)]})
        out.append(("hour", h, h + dt.timedelta(hours=1), len(courts), ", ".join(names), p))
    one = dt.timedelta(hours=1)
    for (cl, sy, h, p), c1 in hours.items():
        c2 = hours.get((cl, sy, h + one, p))
        if not c2:
            continue
        r1 = f" ({_label(h)}-{_label(h + one)})"
        r2 = f" ({_label(h + one)}-{_label(h + 2 * one)})"
        cand = []
        for c in c1:
            for n in names1[(cl, c, h)]:
                both = c in c2
                cand.append((c, both, 1, n if both else n + r1))
        for c in c2 - c1:
            for n in names1[(cl, c, h + one)]:
                cand.append((c, False, 2, n + r2))
        best = {}
        for c, both, which, d in sorted(cand, key=lambda x: (not x[1], x[3])):
            best.setdefault(c, (both, which, d))
        p1 = sum(1 for b, w, _ in best.values() if not b and w == 1)
        p2 = sum(1 for b, w, _ in best.values() if not b and w == 2)
        kept = [d for b, w, d in best.values() if b or (w == 1 and p2 > 0) or (w == 2 and p1 > 0)]
        out.append(("two_hour", h, h + 2 * one, min(len(c1), len(c2)), ", ".join(sorted(kept)), p))
    grp = defaultdict(list)
    for r in half:
        grp[(r["cl"], r["sy"], r["co"], r["h"], r["p"])].append(r)
    lone_f = [r for r in half if r["pos"] == "first" and not any(x["pos"] == "second" for x in grp[(r["cl"], r["sy"], r["co"], r["h"], r["p"])])]
    lone_s = [r for r in half if r["pos"] == "second" and not any(x["pos"] == "first" for x in grp[(r["cl"], r["sy"], r["co"], r["h"], r["p"])])]
    for a in lone_f:
        for b in lone_s:
            if (a["cl"], a["sy"], a["p"], a["h"]) == (b["cl"], b["sy"], b["p"], b["h"]) and a["co"] != b["co"] and a["e"] == b["s"]:
                txt = (f"{disp(a)} ({_label(a['s'])}-{_label(a['e'])}), {disp(b)} ({_label(b['s'])}-{_label(b['e'])})")
                out.append(("cross_court_hour", a["h"], a["h"] + one, 1, txt, a["p"]))
    orph = []
    for r in half:
        g = grp[(r["cl"], r["sy"], r["co"], r["h"], r["p"])]
        if r["pos"] == "first" and not any(x["pos"] == "second" and x["s"] == r["e"] for x in g):
            orph.append(r)
        if r["pos"] == "second" and not any(x["pos"] == "first" and x["e"] == r["s"] for x in g):
            orph.append(r)
    og = defaultdict(set)
    for r in orph:
        og[(r["cl"], r["sy"], r["s"], r["e"], r["p"])].add(r["co"])
    for (cl, sy, s, e, p), courts in og.items():
        names = sorted({disp(x) for x in half if x["cl"] == cl and x["co"] in courts and x["s"] == s and x["e"] == e})
        out.append(("orphan", s, e, len(courts), ", ".join(names), p))
    return sorted(((k, s, e, n, txt, None if p == "NULL" else p) for k, s, e, n, txt, p in out), key=_key)


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = set()
    for _ in range(60):
        court = rnd.choice("abcd")
        name = None if court == "d" else rnd.choice([f"Court {court.upper()}", f"Court {court.upper()}!"])
        h = rnd.randint(6, 11)
        m = rnd.choice([0, 30, 0, 30, 15])
        minutes = rnd.choice([30, 30, 30, 60])
        rows.add(slot(court, h, m, rnd.choice([None, "PEAK"]), name=name, minutes=minutes,
                      client=rnd.choice(["c1", "c2"])))
    rows = sorted(rows, key=lambda r: tuple("" if x is None else str(x) for x in r))
    assert compose(spark, rows) == brute(rows)
