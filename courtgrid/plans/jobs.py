"""End-to-end batch jobs: the reference's make targets as Spark jobs.

* :func:`reservations_load` — §3.1: system-A reservation responses landed since the
  last run -> outcomes (S1–S3, C6, T7) -> normaliser (N1) -> cancellations (M8) ->
  merge (M1) -> next snapshot version -> watermark (T2).  All tenants in one job; the
  tenant comes from the landing folder (``client_code=<tenant>/``).
* :func:`availability_load` — §3.3: opening grid minus busy intervals
  (V1–V5) -> replace per tenant (M6, Q10) -> next snapshot version.
* :func:`model_build` — §3.2: the model chain in dependency order, each mart
  written with rows ordered inside files (O1), partitioned by tenant.

Each job writes versioned snapshots (``sources.snapshot``): a crash leaves
no committed version, and a rerun recomputes the same next state.

Command line::

    python -m courtgrid.plans.jobs reservations --landing L --snapshot S --watermarks W --now 2025-01-06
    python -m courtgrid.plans.jobs models --raw R --out O --as-of 2025-01-06
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import availability as V
from ..operators import merge as M
from ..operators import watermark as T
from ..sources import payloads as PL
from ..sources import snapshot as SN
from ..sources import variants as VA
from ..sources.tables import write_table
from ..streaming import stream as ST
from . import checks as CK
from . import loads as LO
from . import models as P

RESERVATION_COLS = ["client_code", "reservation_id", "event_id", "member_id", "reservation_created_at",
                    "reservation_updated_at", "reservation_start_at", "reservation_end_at",
                    "reservation_cancelled_at", "created_at"]
WATERMARK_SCHEMA = "source_name string, last_loaded_at timestamp, last_record_created_at timestamp"


def reservations_load(spark: SparkSession, landing: str, snapshot: str, watermarks: str, now: str,
                      mode: str = "incremental", sample: int | None = None, layout: str = "versioned",
                      organizations: DataFrame | None = None, rejects: str | None = None,
                      ledger: str | None = None, multiline: bool = True) -> dict:
    """§3.1 as one job over the files landed since the last run (the ledger and the
    one-pass outcomes of ``plans.loads``).  ``mode``: ``incremental`` keeps records updated
    since midnight of the tenant's watermark (T3/T4), ``full`` keeps all, ``dev`` keeps an
    ordered sample of ``sample`` rows (S6).  With ``organizations`` only tenants of the
    roster are loaded (S12).  Responses, records and tenants that are not loaded are written
    to ``rejects`` (default: in the ledger) with a reason.

    ``layout='versioned'`` writes the whole next state as a new version;
    ``'partitioned'`` keeps one table partitioned by tenant and reads and
    replaces only the tenants present in the batch (for big tables)."""
    load = LO.LOADS["reservations_a"]
    ledger = ledger or snapshot.rstrip("/") + "-ledger"
    rejects = rejects or f"{ledger}/rejects"
    known = LO.roster(load, organizations) if organizations is not None else None
    src = T.source_name("reservations", F.col("client_code"))
    audit: dict = {"rejects": 0, "rejected_responses": 0}

    def apply(landed: DataFrame, batch_id: int) -> None:
        version = batch_id + 1
        good, bad = LO.stage(spark, load, landed, known, f"{ledger}/staged/batch={version:08d}", version)
        batch, _ = LO.prepare(load, good, f"{ledger}/rows/batch={version:08d}", now, {})
        wm = SN.read_latest(spark, watermarks, schema=WATERMARK_SCHEMA)
        if mode == "incremental":
            sources = batch.select(src.alias("source_name")).distinct()
            batch = T.incremental(batch, T.resolve(wm, sources, now), "reservation_updated_at", src, overlap="midnight")
        elif mode == "dev":
            batch = PL.sample(batch, sample or 2000, ["client_code", "reservation_id", "member_id", "_pos"])
        active, cancelled = M.split_cancelled(batch)
        if layout == "partitioned":
            def merge(cur, inc):
                cur, act = M.apply_cancellations(cur.select(*RESERVATION_COLS), inc.filter(
                    F.col("reservation_cancelled_at").isNull()), cancelled)
                return M.merge_reservations(cur, act.select(*RESERVATION_COLS, "_pos"))
            nxt = SN.merge_partitions(spark, snapshot, batch.select(*RESERVATION_COLS, "_pos"), merge, ["client_code"])
            audit["touched_rows"] = nxt.count()
        else:
            current = SN.read_latest(spark, snapshot, schema=batch.select(*RESERVATION_COLS).schema, before=version)
            current, active = M.apply_cancellations(current.select(*RESERVATION_COLS), active, cancelled)
            nxt, obs = M.merge_reservations_observed(current, active.select(*RESERVATION_COLS, "_pos"))
            audit["snapshot_version"] = SN.write_next(nxt, snapshot, version=version)
            for k, o in obs.items():
                audit[k] = audit.get(k, 0) + (o.get or {}).get("rows", 0)
        loaded = batch.select(src.alias("source_name"), "reservation_created_at")
        SN.write_next(T.record(wm, loaded, now, record_created="reservation_created_at"), watermarks)
        SN.write_next(bad, rejects, version=version)
        lost = dict(map(tuple, SN.read_latest(spark, rejects, before=version + 1).groupBy("reason").count().collect()))
        audit["rejects"] += sum(lost.values())
        audit["rejected_responses"] += lost.get("response", 0)

    ST.run_available_now(VA.responses(spark.readStream, landing, multiline), ledger, foreach_batch=apply)
    return audit


def availability_load(spark: SparkSession, courts: DataFrame, organizations: DataFrame, busy: DataFrame,
                      snapshot: str, start_date: str, end_date: str, source_system: str = "courtreserve",
                      watermarks: str | None = None, now: str | None = None) -> int:
    """§3.3 as one job: free slots of every tenant, replacing each tenant's
    rows; tenants processed with no free slot are cleared too (Q10).  A tenant is
    processed if it is of the system and has opening hours (a grid row) and a
    court; the rows of all others are left alone."""
    zones = S.known_zone_names(spark)
    if "source_system_code" in organizations.columns:
        organizations = organizations.filter(F.col("source_system_code") == source_system)
    free = V.free_slots(courts, organizations, None, busy, start_date, end_date, zones, source_system)
    current = SN.read_latest(spark, snapshot, schema=free.schema)
    grid = V.opening_grid(courts, organizations, start_date, end_date, zones)
    processed = grid.select("client_code", F.lit(source_system).alias("source_system")).distinct()
    nxt = M.replace_groups(current, free, ["client_code", "source_system"], clear_groups=processed)
    version = SN.write_next(nxt, snapshot, partition_by=["client_code", "source_system"])
    if watermarks:
        wm = SN.read_latest(spark, watermarks, schema=WATERMARK_SCHEMA)
        done = processed.select(T.source_name("court_availability", F.col("client_code")).alias("source_name"))
        SN.write_next(T.record(wm, done, now), watermarks)
    return version


def model_build(spark: SparkSession, raw: dict[str, DataFrame], out: str, as_of: str,
                horizon_days: int = 7) -> list[str]:
    """§3.2: staging and marts in dependency order; returns the marts written.
    The declared checks of the built models go to ``model_checks`` beside them.

    ``raw`` holds ``organizations``, ``courts``, ``members_raw``,
    ``reservations_raw``, ``facility_events_raw`` and
    ``facility_court_availabilities`` (any may be missing)."""
    written = []
    orgs = P.stg_organizations(raw["organizations"])

    def put(name, df, sort):
        write_table(df, os.path.join(out, name), partition_by=["client_code"], sort_within=sort)
        written.append(name)

    put("dim_clients", P.dim_clients(orgs), ["client_code"])
    if "members_raw" in raw:
        put("dim_members", P.dim_members(P.stg_members(raw["members_raw"], orgs)), ["external_member_id"])
    if "reservations_raw" in raw:
        put("fct_reservations", P.fct_reservations(P.stg_reservations(raw["reservations_raw"], orgs)),
            ["reservation_start_at"])
    if "facility_events_raw" in raw:
        put("fct_events", P.fct_events(P.classify_events(raw["facility_events_raw"])), ["event_start_time"])
    if "facility_court_availabilities" in raw:
        av = raw["facility_court_availabilities"]
        zones = S.known_zone_names(spark)
        courts = P.stg_courts(raw["courts"]) if "courts" in raw else None
        if courts is not None:
            put("fct_court_availability", P.fct_court_availability(av, orgs, courts, zones, as_of, horizon_days),
                ["slot_start", "court_id"])
        put("fct_court_availability_fe", P.fct_court_availability_fe(av, as_of, horizon_days),
            ["slot_start", "slot_end", "slot_type"])
    spark = raw["organizations"].sparkSession
    models = {n: spark.read.parquet(os.path.join(out, n)) for n in written}
    models["stg_organizations"] = orgs
    if "members_raw" in raw:
        models["stg_members"] = P.stg_members(raw["members_raw"], orgs)
    if "reservations_raw" in raw:
        models |= {"stg_reservations_a": P.stg_reservations_a(raw["reservations_raw"], orgs),
                   "stg_reservations_b": P.stg_reservations_b(raw["reservations_raw"], orgs),
                   "stg_reservations": P.stg_reservations(raw["reservations_raw"], orgs)}
    write_table(CK.model_checks(models), os.path.join(out, "model_checks"))
    return written


def main(argv=None) -> None:
    from ..session import build_session

    ap = argparse.ArgumentParser(prog="courtgrid.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    r = sub.add_parser("reservations")
    r.add_argument("--landing", required=True)
    r.add_argument("--snapshot", required=True)
    r.add_argument("--watermarks", required=True)
    r.add_argument("--now", required=True)
    r.add_argument("--mode", default="incremental", choices=["incremental", "full", "dev"])
    r.add_argument("--sample", type=int)
    r.add_argument("--layout", default="versioned", choices=["versioned", "partitioned"])
    r.add_argument("--organizations", help="parquet folder of the tenants: only those of the roster are loaded")
    r.add_argument("--rejects")
    v = sub.add_parser("availability", help="free slots of every tenant (§3.3)")
    for flag in ("--courts", "--organizations", "--busy", "--snapshot", "--start-date", "--end-date"):
        v.add_argument(flag, required=True)
    v.add_argument("--source-system", default="courtreserve")
    v.add_argument("--watermarks")
    v.add_argument("--now")
    m = sub.add_parser("models")
    m.add_argument("--raw", required=True, help="folder with one parquet folder per raw table")
    m.add_argument("--out", required=True)
    m.add_argument("--as-of", required=True)
    n = sub.add_parser("load", help="one of the load jobs of plans.loads")
    n.add_argument("name", choices=sorted(LO.LOADS))
    n.add_argument("--landing", required=True)
    n.add_argument("--snapshot", required=True)
    n.add_argument("--organizations", required=True, help="parquet folder of the tenants")
    n.add_argument("--categories", help="parquet folder of the event categories (events_a)")
    n.add_argument("--watermarks")
    n.add_argument("--rejects")
    n.add_argument("--now", required=True)
    a = ap.parse_args(argv)
    spark = build_session()
    if a.job == "load":
        categories = spark.read.parquet(a.categories) if a.categories else None
        print(LO.run(spark, a.name, a.landing, a.snapshot, a.now, spark.read.parquet(a.organizations),
                     watermarks=a.watermarks, rejects=a.rejects, categories=categories))
    elif a.job == "reservations":
        orgs = spark.read.parquet(a.organizations) if a.organizations else None
        print(reservations_load(spark, a.landing, a.snapshot, a.watermarks, a.now, a.mode, a.sample, a.layout,
                                orgs, a.rejects))
    elif a.job == "availability":
        print(availability_load(spark, spark.read.parquet(a.courts), spark.read.parquet(a.organizations),
                                spark.read.parquet(a.busy), a.snapshot, a.start_date, a.end_date, a.source_system,
                                a.watermarks, a.now))
    else:
        names = ["organizations", "courts", "members_raw", "reservations_raw", "facility_events_raw",
                 "facility_court_availabilities"]
        raw = {n: spark.read.parquet(os.path.join(a.raw, n)) for n in names if SN.exists(spark, os.path.join(a.raw, n))}
        print(model_build(spark, raw, a.out, a.as_of))


if __name__ == "__main__":
    main()
