"""Exact top-k search by inner product over integer vectors, with bounds from
segment statistics at several resolutions.

A vector is cut into segments of equal length l.  With the segment means m and
deviations s of two vectors, their squared distance is at least
sum(l * ((m - m')^2 + (s - s')^2)), so their inner product, half of the two squared
norms less the distance, is at most sum(l * (m * m' + s * s')).  A task goes from
long segments to short ones: a candidate whose bound is not above the query's k-th
score so far goes, the next level looks only at what is left, and survivors get
their exact inner product.

Queries are blocks of rows, and every block meets all rows in parts: each group
(part, block) holds its block of queries and streams the candidates of its part by
ascending id, so a later candidate of equal score never displaces an earlier one.
A task's memory is one block of queries and one Arrow batch of candidates, whatever
the number of rows.  A group returns at most k rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise
from .vectors import EXACT, integer_vectors, matrix

LENGTHS = (64, 16, 4)       # segment lengths, coarse to fine
QUERY_BYTES = 32 << 20      # bytes of a block of queries
PART = 8192                 # least candidates of a part
TILE = 1024                 # queries, and
WIDE = 4096                 # candidates compared at a time
PAIRS = 1 << 15             # pairs gathered at a time
DENSE = 0.1                 # share of a tile from which one matrix product is cheaper than gathered pairs
PARTIAL = "query_id long, query_key long, vec_id long, score long"


def statistics(x: np.ndarray, length: int) -> np.ndarray:
    """Per segment of ``length`` components: mean and deviation, each times sqrt(length)."""
    short = -x.shape[1] % length
    cut = np.pad(x, ((0, 0), (0, short))).reshape(len(x), -1, length)
    total = cut.sum(2)
    spread = np.maximum((cut * cut).sum(2) - total * total / length, 0)
    return np.hstack((total / np.sqrt(length), np.sqrt(spread)))


class Vectors:
    """Integer vectors of a tile with their statistics at every level."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.far = float(np.abs(x.astype(np.float64)).max()) if x.size else 0.0
        self.real = x.astype(np.float64)
        self.norm = float(np.sqrt((self.real * self.real).sum(1)).max()) if x.size else 0.0
        self.levels = [statistics(self.real, n) for n in LENGTHS]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows a[i], b[i] in Python integers, held within a long."""
    out = (a.astype(object) * b.astype(object)).sum(1) if a.shape[1] else np.zeros(len(a), object)
    return np.clip(out, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class Best:
    """The k best candidates so far of every query of a block, by score, then by id (null last)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, keys: np.ndarray, k: int):
        self.ids, self.keys, self.k = ids, keys, k
        self.tiles = [Vectors(x[at:at + TILE]) for at in range(0, len(x), TILE)]
        n = len(ids)
        self.score = np.full((n, k), -(1 << 63), np.int64)
        self.found = np.zeros((n, k), bool)
        self.near = np.zeros((n, k), np.int64)
        self.null = np.zeros((n, k), bool)

    def offer(self, ids: np.ndarray, null: np.ndarray, x: np.ndarray) -> None:
        """Candidates by ascending id, after all that were offered before."""
        for at in range(0, len(ids), WIDE):
            part = slice(at, at + WIDE)
            seen = Vectors(x[part])
            for t, tile in enumerate(self.tiles):
                first = t * TILE
                own = self.ids[first:first + TILE, None] == np.where(null[part], 0, ids[part])[None, :]
                own &= ~null[part][None, :]
                self._tile(first, tile, seen, own, ids[part], null[part])

    def _tile(self, first: int, tile: Vectors, seen: Vectors, own: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        n = len(tile.x)
        full = self.found[first:first + n, -1]
        least = np.where(full, self.score[first:first + n, -1].astype(np.float64), -np.inf)
        exact = tile.far * seen.far * max(tile.x.shape[1], 1) < EXACT
        # A bound may be off by rounding, a score is an integer: what comes within half of it stays.
        floor = least - 0.5 - 1e-9 * tile.norm * seen.norm
        left = ~own
        for level in range(len(LENGTHS)):
            if left.mean() > DENSE:
                left &= (tile.levels[level] @ seen.levels[level].T) > floor[:, None]
            else:
                break
        else:
            level = len(LENGTHS)
        if not left.any():
            return
        if exact and left.mean() > DENSE:
            score = tile.real @ seen.real.T
            score[own] = -np.inf
            if score.shape[1] > self.k:
                least = np.maximum(least, np.partition(score, -self.k, axis=1)[:, -self.k] - 0.5)
            q, c = np.nonzero(left & (score > least[:, None]))
            got = score[q, c].astype(np.int64)
        else:
            q, c = np.nonzero(left)
            for finer in range(level, len(LENGTHS)):
                a, b = tile.levels[finer], seen.levels[finer]
                stay = np.concatenate([np.einsum("ij,ij->i", a[q[i:i + PAIRS]], b[c[i:i + PAIRS]])
                                       for i in range(0, len(q), PAIRS)] or [np.zeros(0)]) > floor[q]
                q, c = q[stay], c[stay]
            got = np.concatenate([np.einsum("ij,ij->i", tile.real[q[i:i + PAIRS]], seen.real[c[i:i + PAIRS]]).astype(np.int64)
                                  if exact else products(tile.x[q[i:i + PAIRS]], seen.x[c[i:i + PAIRS]])
                                  for i in range(0, len(q), PAIRS)] or [np.zeros(0, np.int64)])
            up = ~full[q] | (got > self.score[first + q, -1])
            q, c, got = q[up], c[up], got[up]
        if len(q):
            self._merge(first + q, c, got, ids, null)

    def _merge(self, q: np.ndarray, c: np.ndarray, got: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        rows = np.unique(q)
        old, place = np.nonzero(self.found[rows])
        row = np.concatenate((rows[old], q))
        score = np.concatenate((self.score[rows[old], place], got))
        near = np.concatenate((self.near[rows[old], place], ids[c]))
        none = np.concatenate((self.null[rows[old], place], null[c]))
        order = np.lexsort((near, none, -1 - score, row))  # -1 - score: no overflow at the least long
        row, score, near, none = row[order], score[order], near[order], none[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = rank < self.k
        row, rank = row[keep], rank[keep]
        self.score[row, rank], self.near[row, rank], self.null[row, rank] = score[keep], near[keep], none[keep]
        self.found[row, rank] = True

    def result(self) -> pa.RecordBatch:
        row, place = np.nonzero(self.found)
        return pa.RecordBatch.from_arrays([
            pa.array(self.ids[row]), pa.array(self.keys[row]),
            pa.array(self.near[row, place], mask=self.null[row, place]), pa.array(self.score[row, place])],
            names=["query_id", "query_key", "vec_id", "score"])


def _search(dim: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, best = None, [], None
        for batch in batches:
            part, block, side = (batch.column(i).to_numpy() for i in range(3))
            cut = np.flatnonzero(np.diff(part) | np.diff(block) | np.diff(side)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(part)], strict=True):
                if lo == hi:
                    continue
                group = (part[lo], block[lo])
                if group != now:
                    if best is not None:
                        yield best.result()
                    now, held, best = group, [], None
                run_of = batch.slice(lo, hi - lo)
                null = run_of.column(3).is_null().to_numpy(zero_copy_only=False)
                ids = run_of.column(3).fill_null(0).to_numpy()
                x = matrix(run_of.column(4), dim)
                if side[lo] == 0:
                    held.append((ids, x, run_of.column(5).to_numpy()))
                    continue
                if held:
                    best = Best(*(np.concatenate([h[i] for h in held]) for i in range(3)), k)
                    held = []
                if best is not None:
                    best.offer(ids, null, x)
        if best is not None:
            yield best.result()

    return run


def top_k(df: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``k`` rows of highest integer inner product of every query: query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by ``every``; candidates all rows of
    other ids (a null id is no query, and a candidate after all others on ties).
    Vectors that are null or hold null or non-finite components take no part.  Rows
    equal in id and vector count once; rows of one id with different vectors are
    queries of their own.  A short vector counts as filled up with zeros, an empty one
    as zero.  Scores outside a long are held at its ends.  A query alone in the table
    has no row; other columns of ``df`` are not read.
    """
    spark = df.sparkSession
    rows = materialise(integer_vectors(df, id_col, vec_col).distinct(), "topk-vectors")
    is_query = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    n, queries, wide = rows.agg(F.count(F.lit(1)), F.count_if(is_query), F.max(F.length("x"))).first()
    dim = (wide or 0) // 8
    blocks = max(1, -(-queries * max(dim, 1) * 8 // QUERY_BYTES))
    parts = max(1, min(-(-n // PART), -(-2 * spark.sparkContext.defaultParallelism // blocks)))
    key = F.xxhash64("vec_id", "x")
    asked = (rows.where(is_query)
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
             .select("part", F.pmod(key, F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("side"),
                     "vec_id", "x", key.alias("key")))
    offered = (rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
               .select(F.pmod(F.xxhash64("x", "vec_id"), F.lit(parts)).cast("int").alias("part"), "block",
                       F.lit(1).alias("side"), "vec_id", "x", key.alias("key")))
    found = (asked.unionByName(offered)
             .repartition(max(1, parts * blocks), "part", "block")
             .sortWithinPartitions("part", "block", "side", F.col("vec_id").asc_nulls_last(), "x")
             .mapInArrow(_search(dim, k), PARTIAL))
    order = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
