"""Load / merge operators.

PostgreSQL's staging tables, ``DELETE .. USING``, ``ON CONFLICT`` and
per-group delete+insert become pure functions
``(current, incoming) -> next``; the caller writes ``next`` as a new
snapshot (see ``snapshot.py``).

Scale notes:

* First-per-group is ``row_number() .. = 1``.  Catalyst plans it as a
  *partial* ``WindowGroupLimit`` before the shuffle and a final one after,
  so a key holding a third of all rows is cut to one row per map task
  before it moves; no group is ever gathered whole.
* Anti / upsert joins are equi joins on the key (null-safe where the
  reference is), so they are sort-merge or hash joins that AQE can split
  when a key is skewed; a side is only broadcast when AQE measured it
  small at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


# ---------------------------------------------------------------------------
# First per group
# ---------------------------------------------------------------------------
def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (null keys form one group)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedupe_latest(df: DataFrame, keys: Sequence[str], updated: str, pos: str) -> DataFrame:
    """Latest ``updated`` wins; null loses to any value; the first row wins
    a tie; when every row of the key has a null ``updated`` the last wins."""
    return keep_first(df, keys, [
        F.col(updated).desc_nulls_last(),
        F.when(F.col(updated).isNotNull(), F.col(pos)).asc_nulls_last(),
        F.when(F.col(updated).isNull(), F.col(pos)).desc_nulls_last(),
    ])


def dedupe_first(df: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    """Keep the first occurrence (by input position)."""
    return keep_first(df, keys, [F.col(pos).asc()])


def dedupe_last(df: DataFrame, keys: Sequence[str], pos) -> DataFrame:
    """Keep the last occurrence (by input position)."""
    pos = [pos] if isinstance(pos, str) else list(pos)
    return keep_first(df, keys, [F.col(p).desc() for p in pos])


def dedupe_max_id(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Keep the highest id per key (delete ``a.id < b.id``)."""
    return keep_first(df, keys, [F.col(id_col).desc()])


def stage_dedupe(df: DataFrame, keys: Sequence[str], updated: str, loaded: str,
                 tie: str | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by updated desc
    nulls last, loaded desc)``; ``tie`` makes the pick deterministic."""
    order = [F.col(updated).desc_nulls_last(), F.col(loaded).desc()]
    if tie:
        order.append(F.col(tie).asc())
    return keep_first(df, keys, order)


# ---------------------------------------------------------------------------
# Anti joins
# ---------------------------------------------------------------------------
JOIN_SALTS = 32


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner",
                salts: int = JOIN_SALTS) -> DataFrame:
    """Join a big table to a small table keyed by the same columns, spreading
    each key of the big side over ``salts`` tasks.

    AQE splits skewed partitions only when both join sides come straight
    from a shuffle; when the small side is an aggregate of the key (a list
    of groups, of duplicated keys, of ids to delete) a key holding a third
    of the rows would land in one task.  Rows of the big side get a salt
    from a hash of the whole row (deterministic on recompute); the small
    side is replicated once per salt.  If AQE measures the small side
    small enough it is still broadcast, and no shuffle happens at all.
    """
    n = int(salts)
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    b = big.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(n)))
    return b.join(s, list(keys) + ["_salt"], how).drop("_salt")


def _any_null(cols: Sequence[str]) -> Column:
    out = None
    for c in cols:
        cond = F.col(c).isNull()
        out = cond if out is None else out | cond
    return out


def anti_existing(batch: DataFrame, current: DataFrame, cols: Sequence[str],
                  null_safe: bool = True) -> DataFrame:
    """Drop batch rows whose ``cols`` equal a current row.

    ``null_safe`` gives ``IS NOT DISTINCT FROM`` (nulls match); Catalyst
    turns ``<=>`` keys into ordinary join keys, so this stays a
    sort-merge / hash anti join.  With plain equality a row with a null key
    part can never match; such rows are spread by a hash of the row, in the
    same pass (they would all hash to one partition).
    """
    return _anti(batch, current, cols, null_safe)


def _spread(keys: Sequence[str], columns: Sequence[str]) -> Column:
    """An extra join key: 0, or for a row with a null key part, which plain
    equality never matches, a hash of the row that is never 0, so that such
    rows spread over the tasks instead of meeting in one."""
    return F.when(_any_null(keys), F.xxhash64(*[F.col(c) for c in columns]).bitwiseOR(F.lit(1).cast("long"))) \
        .otherwise(F.lit(0).cast("long"))


def _anti(batch: DataFrame, current: DataFrame, cols: Sequence[str], null_safe: bool) -> DataFrame:
    right, left = current.select(*cols), batch
    conds = F.lit(True)
    if not null_safe:
        left = left.withColumn("_spread", _spread(cols, batch.columns))
        right = right.withColumn("_spread", F.lit(0).cast("long"))
        conds = F.col("_l._spread") == F.col("_r._spread")
    for c in cols:
        a, b = F.col(f"_l.{c}"), F.col(f"_r.{c}")
        conds = conds & (a.eqNullSafe(b) if null_safe else a == b)
    return left.alias("_l").join(right.alias("_r"), conds, "left_anti").select(*[F.col(f"_l.{c}") for c in batch.columns])


def delete_keys(df: DataFrame, doomed: DataFrame, cols: Sequence[str],
                fold_case: Sequence[str] = ()) -> DataFrame:
    """Remove rows whose key is in ``doomed`` (plain equality,
    optional lower-casing of some key columns)."""
    def keyed(d):
        return d.select(*[(F.lower(F.col(c)) if c in fold_case else F.col(c)).alias(f"_k{i}")
                          for i, c in enumerate(cols)], *[F.col(c) for c in d.columns])
    k = [f"_k{i}" for i in range(len(cols))]
    # The id list is as large as its batch: one plain anti join, whose sides
    # come straight from the shuffle, so AQE can split a hot key.
    return _anti(keyed(df), keyed(doomed).select(*k), k, null_safe=False).select(*df.columns)


def drop_at_or_before(df: DataFrame, ts: str, watermark) -> DataFrame:
    """F8: drop staged rows at or before the watermark (``<=``); rows without a
    time are kept, as a delete with that condition keeps them."""
    wm = F.lit(watermark).cast("timestamp") if isinstance(watermark, str) else watermark
    return df.filter(~F.coalesce(F.col(ts) <= wm, F.lit(False)))


def split_missing_keys(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every key column present, rejected rows)."""
    ok = None
    for c in cols:
        cond = F.col(c).isNotNull()
        ok = cond if ok is None else ok & cond
    return df.filter(ok), df.filter(~ok)


# ---------------------------------------------------------------------------
# Upsert, insert-ignore, replace-by-group (M3–M7)
# ---------------------------------------------------------------------------
def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None, pos: str | None = None,
           batch_unique: bool = False) -> DataFrame:
    """M3: ``INSERT .. ON CONFLICT (keys) DO UPDATE SET update_cols``.

    One full outer join on ``keys`` (plain equality: a null key part never
    conflicts, as in a unique index).  The batch is first reduced to one
    row per key, the first by ``pos`` or else by its columns in order (Q27),
    unless the caller states that it is so already (``batch_unique``); batch
    rows with a null key part all stay.  Columns outside ``update_cols`` keep
    the current value on conflict.
    """
    cols = current.columns
    update_cols = list(update_cols) if update_cols is not None else [c for c in cols if c not in keys]
    inc = incoming
    if not batch_unique:
        order = [F.col(pos).asc()] if pos is not None else [F.col(c).asc_nulls_last() for c in inc.columns]
        # rows with a null key part are groups of their own, spread by their other columns
        alone = F.when(_any_null(keys), F.xxhash64(*[F.col(c) for c in inc.columns]))
        w = Window.partitionBy(*keys, alone).orderBy(*order)
        inc = inc.withColumn("_rn", F.row_number().over(w)).filter((F.col("_rn") == 1) | _any_null(keys)).drop("_rn")
    inc = inc.select(*[F.col(c) for c in cols if c in inc.columns])
    carried = set(inc.columns)
    inc = inc.withColumn("_spread", _spread(keys, inc.columns)).withColumn("_in", F.lit(True))
    cur = current.withColumn("_spread", _spread(keys, cols))
    on = F.col("c._spread") == F.col("i._spread")
    for c in keys:
        on = on & (F.col(f"c.{c}") == F.col(f"i.{c}"))
    hit = F.col("i._in").isNotNull()
    out = []
    for c in cols:
        if c in keys or (c in update_cols and c in carried):
            out.append(F.when(hit, F.col(f"i.{c}")).otherwise(F.col(f"c.{c}")).alias(c))
        elif c in carried:  # kept on conflict, taken from the batch on insert
            out.append(F.when(hit & F.col("c._cur").isNull(), F.col(f"i.{c}")).otherwise(F.col(f"c.{c}")).alias(c))
        else:
            out.append(F.col(f"c.{c}").alias(c))
    return cur.withColumn("_cur", F.lit(True)).alias("c").join(inc.alias("i"), on, "full_outer").select(*out)


def insert_ignore(current: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  pos: str | None = None) -> DataFrame:
    """M4: ``ON CONFLICT (keys) DO NOTHING``: new keys (first occurrence in the
    batch) are added, existing rows untouched."""
    inc = dedupe_first(incoming, keys, pos) if pos else incoming
    new = anti_existing(inc.select(*current.columns), current, keys, null_safe=False)
    return current.unionByName(new)


def replace_groups(current: DataFrame, incoming: DataFrame, group_cols: Sequence[str],
                   clear_groups: DataFrame | None = None, groups: DataFrame | None = None) -> DataFrame:
    """M5 / M6: every (group) present in ``incoming`` — plus ``clear_groups``,
    which clears groups even when their batch is empty (Q5/Q10) — is
    replaced wholesale; other groups are untouched.  ``groups`` are rows with the
    groups of ``incoming``, where they are had for less than by computing it.

    The group list is tiny (tenants × systems); AQE broadcasts it at run
    time when its measured size allows, otherwise the salted shuffle join
    spreads a big tenant's rows over many tasks.
    """
    groups = (incoming if groups is None else groups).select(*group_cols)
    if clear_groups is not None:
        groups = groups.unionByName(clear_groups.select(*group_cols))
    groups = groups.distinct()
    # A tenant can hold a large share of the table: salted anti join.
    kept = salted_join(current, groups, list(group_cols), "left_anti")
    return kept.unionByName(incoming.select(*current.columns))


# ---------------------------------------------------------------------------
# Reservation load (M1, M8) and cancellations (M2)
# ---------------------------------------------------------------------------
RES_BATCH_KEY = ["client_code", "reservation_id", "member_id"]
RES_STAGE_KEY = ["client_code", "event_id", "reservation_start_at", "reservation_created_at", "member_id"]
# In both keys: rows that differ in these never meet in a merge, so it can be made in parts by them.
RES_APART = ["client_code", "member_id"]


def merge_reservations(current: DataFrame, incoming: DataFrame, pos: str = "_pos",
                       refresh_existing: bool = False) -> DataFrame:
    """M1: batch dedupe (W5) -> stage dedupe (W1) -> null-safe anti join
    against production (J9, unless ``refresh_existing``) -> upsert on
    (client, reservation, member).

    Quirks kept: Q2 (changes of end/updated/cancelled time alone never
    land), Q4 (null members: null-safe in the batch, plain equality in
    the upsert).  Q3: the stage key includes the tenant.
    """
    b = dedupe_latest(incoming, RES_BATCH_KEY, "reservation_updated_at", pos)
    b = stage_dedupe(b, RES_STAGE_KEY, "reservation_updated_at", "created_at", tie=pos)
    if not refresh_existing:
        b = anti_existing(b, current, RES_STAGE_KEY, null_safe=True)
    return upsert(current, b.select(*current.columns), RES_BATCH_KEY, batch_unique=True)


CANCEL_KEY = ["client_code", "event_id", "reservation_start_at", "cancelled_on", "member_id"]


def merge_cancellations(current: DataFrame, incoming: DataFrame, pos: str = "_pos") -> DataFrame:
    """M2: W2 dedupe on the 5-key, null-safe anti join, append."""
    b = keep_first(incoming, CANCEL_KEY, [F.col("cancelled_on").desc_nulls_last(),
                                          F.col("created_at").desc(), F.col(pos).asc()])
    b = anti_existing(b, current, CANCEL_KEY, null_safe=True)
    return current.unionByName(b.select(*current.columns))


def split_cancelled(batch: DataFrame, cancelled_col: str = "reservation_cancelled_at"):
    """M8 input: (active rows, cancelled ids) of a system-A batch."""
    cancelled = batch.filter(F.col(cancelled_col).isNotNull()).select("client_code", "reservation_id")
    return batch.filter(F.col(cancelled_col).isNull()), cancelled


def apply_cancellations(current: DataFrame, batch: DataFrame, cancelled: DataFrame):
    """M8: drop cancelled (lower(client), reservation) from production and batch."""
    keys = ["client_code", "reservation_id"]
    return (delete_keys(current, cancelled, keys, fold_case=["client_code"]),
            delete_keys(batch, cancelled, keys, fold_case=["client_code"]))


def event_summary_merge(current: DataFrame, incoming: DataFrame, pos: str = "_pos") -> DataFrame:
    """M10 + M11: event summaries keyed by (event_id, program_date_time):
    W3 dedupe, delete the production rows of those keys (F9), append."""
    key = ["event_id", "program_date_time"]
    b = keep_first(incoming, key, [F.col(pos).desc()])
    kept = delete_keys(current, b, key)
    return kept.unionByName(b.select(*current.columns))


def fill_start_from_created(df: DataFrame) -> DataFrame:
    """``event_start_time = created_at`` where null."""
    return df.withColumn("event_start_time", F.coalesce("event_start_time", "created_at"))


def copy_column(target: DataFrame, source: DataFrame, key: str, col: str) -> DataFrame:
    """``UPDATE target SET col = source.col FROM source WHERE key = key``;
    of several source rows with a key, the least value is taken."""
    s = source.groupBy(F.col(key).alias("_k")).agg(F.min(col).alias("_v"))
    j = target.join(s, target[key] == s["_k"], "left")
    return j.select(*[(F.coalesce("_v", target[c]) if c == col else target[c]).alias(c) for c in target.columns])


def merge_reservations_observed(current: DataFrame, incoming: DataFrame, pos: str = "_pos"):
    """M1 + A7 in one pass: the same plan as :func:`merge_reservations` with a
    row-count ``Observation`` on each step.  The counts are filled in when
    the returned frame is written (one job), so no step is recomputed to be
    counted.  Returns ``(next, {step: Observation})``."""
    from pyspark.sql import Observation

    obs = {k: Observation(f"m1_{k}") for k in ("incoming", "batch_dedupe", "stage_dedupe", "new_vs_production")}

    def count(df, k):
        return df.observe(obs[k], F.count(F.lit(1)).alias("rows"))
    b = count(incoming, "incoming")
    b = count(dedupe_latest(b, RES_BATCH_KEY, "reservation_updated_at", pos), "batch_dedupe")
    b = count(stage_dedupe(b, RES_STAGE_KEY, "reservation_updated_at", "created_at", tie=pos), "stage_dedupe")
    b = count(anti_existing(b, current, RES_STAGE_KEY, null_safe=True), "new_vs_production")
    return upsert(current, b.select(*current.columns), RES_BATCH_KEY, batch_unique=True), obs


def audit_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """One row per load step with its row count, as a lazy union of
    global counts (each a single partial+final aggregate)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(step).alias("step"), "rows")
             for step, df in stages.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
