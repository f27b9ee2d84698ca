"""The load jobs of both booking systems and of the reviews, as data.

A :class:`Load` names the landed payload (schema, envelope, time texts), its
normaliser, the key columns a row must have and the rule that merges a batch
into the table.  :func:`run` is the same for all of them::

    files not seen before -> one pass: response, status (S3), roster (S12, S13),
      record, field types, time texts (C6) -> one table partitioned by outcome
    its good part -> normaliser -> keys checked (F7) -> newest poll -> merge rule
      -> table version -> watermark (T2)

The ledger of a load is the log of Spark's file source: a run reads only files that
no run before has read, each exactly once, so a landing folder is append-only (a file
written again under its old name is not read again).  A batch's number is its table's
version: a batch that is run again after a crash starts from the same state and writes
the same version.

A poll is a folder ``poll=<id>``, ids in order of time; files without one are a poll
with the other new files of their run.  Within a poll the load's own rule says which
of equal rows stays, between polls the newest poll's row does.  Loads that replace
their tenants' rows take the newest poll of each tenant: an older one that lands late
goes to the rejects, more files of the poll that stands extend it.  Loads that upsert
take from a late poll only rows whose key is new.

Nothing vanishes: responses, records and rows that are not loaded are written
to the rejects with a reason.  All tenants are one job; a tenant is known by
its landing folder (``client_code=<tenant>/``).  (Reservations of system A,
which also delete cancelled bookings, are ``jobs.reservations_load``.)
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import merge as M
from ..operators import roster as R
from ..operators import watermark as T
from ..sources import payloads as PL
from ..sources import places as PLC
from ..sources import snapshot as SN
from ..sources import system_a as A
from ..sources import system_b as B
from ..sources import variants as VA
from ..streaming import stream as ST

WATERMARK_SCHEMA = "source_name string, last_loaded_at timestamp, last_record_created_at timestamp"
MEMBER_KEY = ["client_code", "member_id"]
EVENT_KEY = ["client_code", "source_system", "event_id", "event_start_time"]
GROUP = ["client_code", "source_system"]
REVIEW_KEY = ["client_code", "review_service"]
SLOT_KEY = ["client_code", "source_system", "court_id", "slot_start", "slot_end", "period_type"]
AVAILABILITY_DAYS = 7
POLLS = "client_code string, poll string"

@dataclass(frozen=True)
class Load:
    """One load job.

    ``normalise(records, context)`` gives the rows with ``_pos``;
    ``merge(current, rows, processed)`` the next state, ``processed`` being
    the tenants (``client_code``) whose responses were read.  ``kind`` is the
    watermark name (None: the load has none), ``mark_empty`` tells whether a
    tenant without rows is marked too, ``overlap_minutes`` and ``window_days``
    shape the requests (:func:`fetch_windows`).  ``whole``: a poll is all of a
    tenant's rows; ``poll_key`` are the keys by which a poll's rows are told apart
    (None: the merge rule orders rows by their own times)."""
    envelope: str
    schema: str
    normalise: Callable[[DataFrame, dict], DataFrame]
    merge: Callable[[DataFrame, DataFrame, DataFrame | None], DataFrame]
    required: Sequence[str]
    system: str | None = None
    kind: str | None = None
    times: Sequence[str] = ()
    alt_schema: str | None = None
    stamps: Sequence[str] = ("created_at",)
    mark_empty: bool = True
    overlap_minutes: int = 0
    window_days: int = 30
    whole: bool = False
    poll_key: Sequence[str] | None = None


def _merge_members(current, rows, processed):
    """M3 / M7: upsert; of a member repeated in the batch the first row stays."""
    return M.upsert(current, rows, MEMBER_KEY, pos="_pos")


def _merge_events(current, rows, processed, last=M.dedupe_last):
    """W6 + M5: last occurrence per event and start (``last``: how it is found); tenants
    with events are replaced whole, others left."""
    # The groups as a table: its size is known when the join is planned, so the current rows are not shuffled.
    groups = ST.stored(rows.select(*GROUP).distinct(), "groups")
    return M.replace_groups(current, last(rows, EVENT_KEY, "_pos"), GROUP, groups=groups)


def _merge_sessions(current, rows, processed):
    """M6 / Q10: every processed tenant is replaced, also by nothing."""
    clear = processed.select("client_code", F.lit(B.SYSTEM_B).alias("source_system"))
    return M.replace_groups(current, rows, GROUP, clear_groups=clear)


def _merge_reviews(current, rows, processed):
    """M3 on (tenant, service): the last polled place of a tenant stays."""
    return M.upsert(current, M.dedupe_last(rows, REVIEW_KEY, "_pos"), REVIEW_KEY, batch_unique=True)


def _sessions(records, context):
    end = F.lit(context["now"]).cast("timestamp") + F.make_dt_interval(F.lit(AVAILABILITY_DAYS))
    return B.normalize_sessions(records, end)


LOADS: dict[str, Load] = {
    "members_a": Load(
        "a_members", PL.A_MEMBER, lambda r, c: A.normalize_members(r).drop("club_member_key"), _merge_members,
        MEMBER_KEY, A.SYSTEM_A, "members", mark_empty=False,
        overlap_minutes=T.MEMBER_OVERLAP_MINUTES, window_days=21, poll_key=MEMBER_KEY),
    "members_b": Load(
        "b", PL.B_USER, lambda r, c: B.normalize_members(r).drop("club_member_key", "newest_membership"),
        _merge_members, MEMBER_KEY, B.SYSTEM_B, "members", overlap_minutes=T.MEMBER_OVERLAP_MINUTES,
        poll_key=MEMBER_KEY),
    "reservations_b": Load(
        "b", PL.B_EVENT, lambda r, c: B.normalize_event_reservations(r),
        lambda cur, rows, processed: M.merge_reservations(cur, rows), ["client_code"], B.SYSTEM_B, "reservations",
        times=["startTime", "endTime", *[f"reservations.items[].{t}" for t in
                                         ("startTime", "endTime", "createdAt", "updatedAt", "cancelledAt")]]),
    "cancellations_a": Load(
        "a", PL.A_CANCELLATION, lambda r, c: A.normalize_cancellations(r),
        lambda cur, rows, processed: M.merge_cancellations(cur, rows), ["client_code"], A.SYSTEM_A,
        "reservation_cancellations", times=["StartTime", "EndTime", "SignedUpOnUtc", "CancelledOnUtc", "CancelledOn"]),
    "events_a": Load(
        "a", PL.A_EVENT, lambda r, c: A.normalize_events(r, c.get("categories"), c["zones"]).drop("courts"),
        _merge_events, EVENT_KEY, A.SYSTEM_A, "events", alt_schema=PL.A_EVENT_ALT,
        times=["StartTime", "EndTime", "StartDateTime", "EndDateTime", "_alt.startTime", "_alt.endTime"],
        whole=True, poll_key=EVENT_KEY),
    "events_b": Load(
        "b", PL.B_EVENT, lambda r, c: B.normalize_events(r, c["zones"]), _merge_events, EVENT_KEY, B.SYSTEM_B,
        "events", times=["startTime", "start_time", "endTime", "end_time"], whole=True, poll_key=EVENT_KEY),
    "sessions_b": Load(
        "b", PL.B_SESSION, _sessions, _merge_sessions, ["client_code", "court_id"], B.SYSTEM_B,
        "court_availability", times=["startTime", "endTime"], stamps=(), whole=True, poll_key=SLOT_KEY),
    "reviews": Load(
        "place", PL.PLACE, lambda r, c: PLC.review_aggregate(r), _merge_reviews, [*REVIEW_KEY, "link_to_reviews"],
        stamps=("last_updated_at", "updated_at"), poll_key=REVIEW_KEY),
    "reservations_a": Load(
        "a", PL.A_RESERVATION, lambda r, c: A.normalize_reservations(r), None, ["client_code"],
        A.SYSTEM_A, "reservations",
        times=["StartTime", "EndTime", "CreatedOnUtc", "UpdatedOnUtc", "CancelledOnUtc", "CancelledOn"]),
}


def fetch_windows(name: str, watermarks: DataFrame, roster: DataFrame, now: str) -> DataFrame:
    """T1 + S4: the windows a poller has to land for each tenant of ``roster``,
    from its watermark less the load's overlap up to ``now``."""
    load = LOADS[name]
    sources = roster.select(T.source_name(load.kind, F.col("client_code")).alias("source_name"))
    back = F.make_dt_interval(mins=F.lit(load.overlap_minutes))
    resolved = T.resolve(watermarks, sources, now).withColumn("watermark", F.col("watermark") - back)
    return T.load_windows(resolved, now, load.window_days)


def _reject(df: DataFrame, reason: str, record=None) -> DataFrame:
    text = F.to_json(F.struct(*[F.col(c) for c in df.columns])) if record is None else record
    return df.select("client_code", F.lit(reason).alias("reason"), text.alias("record"))


def keyed(load: Load, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with all key columns, the others)."""
    return M.split_missing_keys(rows, load.required)


def stage(spark: SparkSession, load: Load, responses: DataFrame, known: DataFrame | None, path: str,
          number: int = 0) -> tuple[DataFrame, DataFrame]:
    """S1–S3, C6, T7 in one pass over the responses (:func:`variants.responses`).

    Every record, and every response without one, gets an outcome: ``good``, ``read`` (a
    good response without records: its tenant was read) or ``rejected`` with a reason.
    One write to ``path`` partitioned by the outcome parses the landing once; returned are
    the good and read rows (client_code, outcome, _pos, f) and the rejects (client_code,
    reason, record).  ``_pos`` orders rows by poll, landing time, file and place;
    ``number`` stands for the poll of files without one; ``spark`` reads the table back (a
    stream's batch has a session of its own)."""
    rows = VA.unwrap(responses, load.envelope)
    if known is not None:
        rows = rows.join(known, "client_code", "left")
    pos = F.struct(F.coalesce("poll", F.lit(f"{number:012d}")).alias("poll"), "at", "file", "i").alias("_pos")
    inside = rows["_known"] if known is not None else F.lit(True)
    rows = rows.select("client_code", "value", "ok", "v", F.coalesce(inside, F.lit(False)).alias("known"), pos)
    parsed = VA.records(rows, load.schema, load.alt_schema)
    reason = (F.when(~F.col("ok"), "response").when(~F.col("known"), "tenant not in roster")
              .when(F.col("fault").isNotNull(), F.col("fault"))
              .when((F.col("_pos.i").isNotNull()) & F.col("f").isNull(), "record")
              .when(PL.bad_times(load.times, "f."), "time text"))
    judged = parsed.withColumn("reason", reason)
    bad = F.col("reason").isNotNull()
    outcome = F.when(bad, "rejected").when(F.col("f").isNull(), "read").otherwise("good")
    text = F.when(bad, F.coalesce(F.to_json("v"), F.col("value")))
    (judged.select("client_code", "_pos", "reason", text.alias("record"), F.when(~bad, F.col("f")).alias("f"),
                   outcome.alias("outcome"))
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("outcome").parquet(path))
    fields = judged.select(F.when(~bad, F.col("f")).alias("f")).schema["f"].dataType.simpleString()
    kind = "string, at: timestamp, file: string, i: int"
    back = spark.read.schema(f"client_code string, _pos struct<poll: {kind}>, reason string, record string, f {fields}, "
                             "outcome string").parquet(path)
    return (back.filter("outcome <> 'rejected'").select("client_code", "outcome", "_pos", "f"),
            back.filter("outcome = 'rejected'").select("client_code", "reason", "record"))


def roster(load: Load, organizations: DataFrame) -> DataFrame:
    """The tenants that the load takes, as ``client_code`` and a flag."""
    tenants = R.place_roster(organizations) if load.system is None else R.tenant_roster(organizations, load.system)
    return tenants.select(F.lower("client_code").alias("client_code"), F.lit(True).alias("_known")).distinct()


def prepare(load: Load, good: DataFrame, path: str, now: str, context: dict) -> tuple[DataFrame, DataFrame]:
    """Good records -> (rows to merge, rejects), normalised once into a table at ``path``."""
    rows = load.normalise(good.filter("outcome = 'good'").select("client_code", "_pos", "f.*"), {"now": now, **context})
    for c in load.stamps:
        rows = rows.withColumn(c, F.lit(now).cast("timestamp"))
    rows.write.mode("overwrite").parquet(path)
    rows, missing = keyed(load, good.sparkSession.read.schema(rows.schema).parquet(path))
    return rows, _reject(missing, "missing key")


def newest_polls(good: DataFrame, applied: DataFrame) -> DataFrame:
    """Per tenant that was read: its newest poll in the batch (``newest``) and the one its table stands at (``stands``)."""
    own = good.groupBy("client_code").agg(F.max("_pos.poll").alias("newest"))
    return own.join(applied.withColumnRenamed("poll", "stands"), "client_code", "left")


def merge_polls(load: Load, current: DataFrame, rows: DataFrame, polls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(next state, rows of polls older than the one that stands) of a load with ``poll_key``.

    ``rows`` carry ``_pos``; ``polls`` is :func:`newest_polls`."""
    # One row a tenant: salted, so that a large tenant's rows are spread.
    rows = M.salted_join(rows, polls, ["client_code"], "inner")
    poll = F.col("_pos.poll")
    late = F.coalesce(poll < F.col("stands"), F.lit(False))
    extra = ["newest", "stands"]
    if not load.whole:
        first = M.keep_first(rows, load.poll_key, [poll.desc(), F.col("_pos").asc() if load.merge is _merge_members
                                                   else F.col("_pos").desc()])
        new = M.upsert(current, first.filter(~late).drop(*extra), load.poll_key, batch_unique=True)
        return M.insert_ignore(new, first.filter(late).drop(*extra), load.poll_key), rows.filter(F.lit(False)).drop(*extra)
    taken = rows.filter((poll == F.col("newest")) & ~late)
    # A tenant whose newest poll is the one that stands is extended, others are replaced whole.
    again = F.coalesce(F.col("newest") == F.col("stands"), F.lit(False))
    fresh = polls.filter(F.col("stands").isNull() | (F.col("newest") > F.col("stands"))).select("client_code")
    replaced = load.merge(current, taken.filter(~again).drop(*extra), fresh)
    more = M.dedupe_last(taken.filter(again).drop(*extra), load.poll_key, "_pos")
    return M.upsert(replaced, more, load.poll_key, batch_unique=True), rows.filter(late).drop(*extra)


def run(spark: SparkSession, name: str, landing: str, snapshot: str, now: str, organizations: DataFrame,
        watermarks: str | None = None, rejects: str | None = None, categories: DataFrame | None = None,
        ledger: str | None = None, multiline: bool = True, max_files: int | None = None) -> dict:
    """One load from the files landed since the last run to the next table version.

    ``ledger`` (default: beside the table) holds the file log, the staged outcomes and the
    polls that stand.  ``max_files`` bounds a batch when a long backlog is loaded; a poll cut
    by it is extended by the next batch.  Returns the table's version, the rejects of this run
    (a batch's rejects are a version of ``rejects``, when given) and the records and responses
    judged."""
    load = LOADS[name]
    ledger = ledger or snapshot.rstrip("/") + "-ledger"
    context = {"zones": S.known_zone_names(spark), "categories": categories}
    known = roster(load, organizations)
    told = {"rejects": 0, "judged": 0}

    def apply(batch: DataFrame, batch_id: int) -> None:
        version = batch_id + 1
        good, bad = stage(spark, load, batch, known, f"{ledger}/staged/batch={version:08d}", version)
        rows, missing = prepare(load, good, f"{ledger}/rows/batch={version:08d}", now, context)
        current = SN.read_latest(spark, snapshot, schema=rows.drop("_pos").schema, before=version)
        applied = SN.read_latest(spark, f"{ledger}/polls", schema=POLLS, before=version)
        polls = newest_polls(good, applied)
        lost = bad.unionByName(missing)
        if load.poll_key:
            nxt, late = merge_polls(load, current, rows, polls)
            lost = lost.unionByName(_reject(late, "older poll"))
        else:
            nxt = load.merge(current, rows, polls.select("client_code"))
        SN.write_next(nxt, snapshot, version=version)
        if watermarks and load.kind:
            done = polls.select("client_code") if load.mark_empty else rows.select("client_code").distinct()
            done = done.select(T.source_name(load.kind, F.col("client_code")).alias("source_name"))
            SN.write_next(T.record(SN.read_latest(spark, watermarks, schema=WATERMARK_SCHEMA), done, now), watermarks)
        SN.write_next(lost, rejects or f"{ledger}/rejects", version=version)
        SN.write_next(applied.join(polls.select("client_code", "newest"), "client_code", "full_outer").select(
            "client_code", F.greatest("poll", "newest").alias("poll")), f"{ledger}/polls", version=version)
        told["rejects"] += SN.read_latest(spark, rejects or f"{ledger}/rejects", before=version + 1).count()
        told["judged"] += good.select("outcome").unionByName(bad.select(F.lit("rejected").alias("outcome"))).count()

    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    ST.run_available_now(VA.responses(reader, landing, multiline), ledger, foreach_batch=apply)
    return {"version": max(SN.versions(spark, snapshot), default=0), **told}
