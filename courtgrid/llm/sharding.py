"""Sharding by sampled splitters.

Rows are ordered by the hash of their text and then by id.  A size-weighted
sample of these keys gives quantile boundaries of many narrow ranges; rows are
dealt into the ranges, and ranges whose exact size is over the allowed one are
split again with boundaries sampled inside them (first by hash, then, for one
hot text, by id, then, for one repeated row, by a number of the row).  Shards are runs of ranges of equal total size; a range that
holds a shard's edge is cut there by its running sum.  A group of equal texts
stays whole unless it is larger than ``GROUP_SHARE`` of a shard, so shard sizes
differ by a few hundredths at most.

Law: ``bytes``.  Only ids, hashes and sizes are shuffled, never texts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

SHARDS = 16
SAMPLE_PER_RANGE = 24      # sampled keys for each boundary
ROWS_PER_RANGE = 4_000     # aimed rows of a range
MOST_RANGES = 65_536       # beyond, ranges hold more rows; bounds what the driver holds and broadcasts (under 2 MB)
GROUP_SHARE = 0.01         # a group of equal texts up to this share of a shard is not cut
OVERFULL = 4               # times the aimed size from which a range is split again
MOST_ROUNDS = 8
SPREAD_BITS = 20           # of a tie, tell rows equal in text and id apart


def sized_rows(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32 and the ordering key of every row.

    ``tie`` orders equal texts: by the id's hash in its upper bits, and rows equal in
    id too by a number of the row in its lower ``SPREAD_BITS``, so that a row repeated
    any number of times is cut into ranges like other rows.  Store the result before
    use: the row's number is drawn when it is computed.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    spread = (1 << SPREAD_BITS) - 1
    of_id = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).bitwiseAND(F.lit(~spread))
    of_row = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(spread))
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                       F.xxhash64(text).alias("key"),
                       of_id.bitwiseOR(of_row).alias("tie"))


def _sample(rows: DataFrame, per_byte: Column) -> np.ndarray:
    """Keys drawn with a chance in proportion to their size, by a hash of the key: (key, tie, range)."""
    chance = F.pmod(F.xxhash64("key", "tie", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    got = rows.where(chance < F.col("size") * per_byte).select("key", "tie", "range").collect()
    return np.array([(r.key, r.tie, r.range) for r in got], np.int64).reshape(-1, 3)


def _deal(rows: DataFrame, edges: np.ndarray) -> DataFrame:
    """Set ``range``: the number of edges (key, tie) at or below the row's key."""
    keys, ties = edges[:, 0].copy(), edges[:, 1].copy()

    def place(key: pd.Series, tie: pd.Series) -> pd.Series:
        k, t = key.to_numpy(), tie.to_numpy()
        lo, hi = np.searchsorted(keys, k, side="left"), np.searchsorted(keys, k, side="right")
        out = lo.copy()
        for i in np.flatnonzero(hi > lo):  # only keys that are edges themselves
            out[i] = lo[i] + np.searchsorted(ties[lo[i]:hi[i]], t[i], side="right")
        return pd.Series(out)

    return rows.withColumn("range", F.pandas_udf(place, "long")("key", "tie"))


LEAST = np.iinfo(np.int64).min


def splitters(rows: DataFrame, ranges: int, total: int) -> tuple[np.ndarray, list]:
    """Edges of about ``ranges`` ranges and the exact (range, size, rows) of each.

    The sample holds about SAMPLE_PER_RANGE keys a range, so what reaches the
    driver is bounded by the number of ranges.
    """
    aim = total / ranges
    flat = rows.withColumn("range", F.lit(0).cast("long"))
    edges = np.zeros((0, 2), np.int64)
    overfull: dict[int, int] = {0: total}
    for _ in range(MOST_ROUNDS):
        found = _sample(flat.where(F.col("range").isin(list(overfull))), F.lit(SAMPLE_PER_RANGE / aim))
        fresh = []
        for r, size in overfull.items():
            own = found[found[:, 2] == r][:, :2]
            own = own[np.lexsort((own[:, 1], own[:, 0]))]
            pieces = max(2, round(size / aim))
            if len(own):
                picks = own[np.unique(np.arange(1, pieces) * len(own) // pieces)]
                # an edge stands before all rows of its text, unless one text fills more than a range
                same = np.concatenate(([False], picks[1:, 0] == picks[:-1, 0])) if len(picks) else np.zeros(0, bool)
                whole = picks.copy()
                whole[~same, 1] = LEAST
                fresh.append(whole)
        if not fresh:
            break
        edges = np.unique(np.concatenate((edges, *fresh)), axis=0)
        flat = _deal(rows, edges)
        sizes = flat.groupBy("range").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
        overfull = {r["range"]: r["size"] for r in sizes if r["size"] > OVERFULL * aim and r["n"] > 1}
        if not overfull:
            break
    return edges, sizes if len(edges) else [(0, total, None)]


def shard_by_size(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Put every row into one of ``shards`` shards of nearly equal size.

    Returns doc_id, size, text_crc32, shard, slot; slots number a shard's rows
    from 0 without gaps, in the order of the key.  Null texts have size 1;
    repeated rows are placed one by one (equal rows are interchangeable); null
    ids are ordinary ids; an empty table gives no rows.  Other columns of
    ``docs`` play no part.
    """
    rows = materialise(sized_rows(docs), "shard-rows")
    stats = rows.agg(F.sum("size").alias("total"), F.count("*").alias("n")).first()
    total, n = int(stats["total"] or 0), int(stats["n"])
    ranges = max(4 * shards, min(MOST_RANGES, -(-n // ROWS_PER_RANGE)))
    edges, sizes = splitters(rows, ranges, total) if n else (np.zeros((0, 2), np.int64), [])
    start, at = {}, 0
    for r, size, _ in sorted((tuple(x) for x in sizes)):
        start[r] = at
        at += size
    spark = docs.sparkSession
    starts = spark.createDataFrame(list(start.items()) or [(0, 0)], "range long, range_start long")
    share = F.lit(max(total, 1) / shards)
    order = Window.partitionBy("range").orderBy("key", "tie", "text_crc32")
    text = Window.partitionBy("range", "key")
    placed = (_deal(rows, edges).join(F.broadcast(starts), "range")
              .withColumn("row_start", F.col("range_start") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
                          - F.col("size"))
              .withColumn("group_size", F.sum("size").over(text))
              .withColumn("group_start", F.min("row_start").over(text))
              .withColumn("middle", F.when(F.col("group_size") <= share * GROUP_SHARE,
                                           F.col("group_start") + F.col("group_size") / 2)
                          .otherwise(F.col("row_start") + F.col("size") / 2))
              .withColumn("shard", F.least(F.floor(F.col("middle") / share), F.lit(shards - 1)).cast("int"))
              .select("doc_id", "size", "text_crc32", "range", "key", "tie", "shard"))
    placed = materialise(placed, "shard-placed")
    counts = placed.groupBy("shard", "range").agg(F.count("*").alias("n")).collect()
    base, used = [], {}
    for s, r, k in sorted(tuple(x) for x in counts):
        base.append((s, r, used.get(s, 0)))
        used[s] = used.get(s, 0) + k
    bases = spark.createDataFrame(base or [(0, 0, 0)], "shard int, range long, base long")
    inside = Window.partitionBy("range", "shard").orderBy("key", "tie", "text_crc32")
    return (placed.join(F.broadcast(bases), ["shard", "range"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("base") + F.row_number().over(inside) - 1).cast("long").alias("slot")))
