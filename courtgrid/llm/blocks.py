"""Comparison of rows that share a key, in blocks of bounded size, and
connected components of the links found.

A key with ``n`` rows gets ``ceil(n / block)`` blocks; every pair of blocks is
one group, so no task holds more than ``2 * block`` rows of a key, however hot
it is.  A pair of rows that shares several keys is counted under the first one
only, which each group decides from the rows' own key lists: only per-row
counts and one root per row leave a group, never its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def spread_blocks(df: DataFrame, key: str, n: str, ident: str, block: int) -> DataFrame:
    """Give each row of a key of ``n`` rows its block pairs: adds ``bi``, ``bj`` and ``own_block``.

    A row of block b goes to the pairs (b, x) and (x, b) of every block x.
    """
    blocks = F.ceil(F.col(n) / F.lit(block)).cast("int")
    return (df.withColumn("own_block", F.pmod(F.xxhash64(ident, key), blocks).cast("int"))
            .withColumn("__other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("bi", F.least("own_block", "__other"))
            .withColumn("bj", F.greatest("own_block", "__other"))
            .drop("__other"))


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Runs of rows with equal ``keys`` in a partition sorted by them, as columns of lists."""
    names: list[str] = []
    now, held = None, {}
    for batch in batches:
        names = batch.schema.names
        cols = {c: batch.column(i).to_pylist() for i, c in enumerate(names)}
        heads = list(zip(*(cols[k] for k in keys), strict=True))
        at = 0
        while at < len(heads):
            end = at + 1
            while end < len(heads) and heads[end] == heads[at]:
                end += 1
            if heads[at] != now:
                if now is not None:
                    yield now, held
                now, held = heads[at], {c: [] for c in names}
            for c in names:
                held[c].extend(cols[c][at:end])
            at = end
    if now is not None:
        yield now, held


def first_shared(keys: list[list[int]], key: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For pairs (left, right) of rows: is ``key`` the first in both rows' ordered key lists that they share?

    ``keys``: the row's keys in the order of precedence; all hold ``key``.
    """
    earlier: dict[int, list[int]] = {}
    for row, own in enumerate(keys):
        for k in own:
            if k == key:
                break
            earlier.setdefault(k, []).append(row)
    common = [rows for rows in earlier.values() if len(rows) > 1]
    if not common:
        return np.ones(len(left), bool)
    has = np.zeros((len(keys), len(common)), np.float32)
    for j, rows in enumerate(common):
        has[rows, j] = 1
    return ~((has @ has.T) > 0)[left, right]


def counts_and_roots(n: int, left: np.ndarray, right: np.ndarray, counted: np.ndarray,
                     weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of each row (weights of the partners of ``counted`` pairs) and its least connected row."""
    links = np.zeros(n, np.int64)
    np.add.at(links, left[counted], weight[right[counted]])
    np.add.at(links, right[counted], weight[left[counted]])
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, left, root[right])
        np.minimum.at(low, right, root[left])
        low = low[low]
        if (low == root).all():
            return links, root
        root = low


PARTIAL = "id binary, links long, root binary"


def compare_groups(df: DataFrame, keys: list[str], linked: Callable) -> DataFrame:
    """Apply ``linked(key, columns) -> (left, right, counted)`` to each group of ``keys``.

    ``df`` has the columns ``id`` and ``copies`` (long); returns a row per group
    and row with links: its partial count and the root it hangs on there.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {"id": [], "links": [], "root": []}
        for key, cols in grouped(batches, keys):
            if len(cols["id"]) < 2:
                continue
            left, right, counted = linked(key, cols)
            if not len(left):
                continue
            links, root = counts_and_roots(len(cols["id"]), left, right, counted, np.array(cols["copies"], np.int64))
            ids = cols["id"]
            for i in np.unique(np.concatenate((left, right))).tolist():
                out["id"].append(ids[i])
                out["links"].append(int(links[i]))
                out["root"].append(ids[root[i]])
            if len(out["id"]) > 20_000:
                yield _partial(out)
                out = {c: [] for c in out}
        if out["id"]:
            yield _partial(out)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, PARTIAL)


def _partial(out: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(out["id"], pa.binary()), pa.array(out["links"], pa.int64()),
                                       pa.array(out["root"], pa.binary())], names=["id", "links", "root"])


def components(edges: DataFrame) -> DataFrame:
    """Least id reachable over ``edges`` (columns a, b): a table (id, label).

    Each round takes the least label among a row's neighbours and then the
    label of its label, so chains halve; rounds are written to the shared
    folder and end when no label changes.  Joins have one plain row per id on
    one side, so a hot hub is split by the adaptive skew join.
    """
    both = materialise(edges.where(F.col("a") != F.col("b"))
                       .select(F.explode(F.array(F.struct(F.col("a"), F.col("b")),
                                                 F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
                       .select("e.a", "e.b").distinct(), "edges")
    labels = materialise(both.groupBy(F.col("a").alias("id"))
                         .agg(F.min("b").alias("low"))
                         .select("id", F.least("id", "low").alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("id").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("label").alias("low")))
        step = materialise(labels.join(near, "id").select("id", F.col("label").alias("was"),
                                                          F.least("label", "low").alias("label")), "labels")
        jump = step.select(F.col("id").alias("label"), F.col("label").alias("next"))
        new = materialise(step.join(jump, "label").select("id", "was", F.least("label", "next").alias("label")), "labels")
        labels = new.select("id", "label")
        if new.where(F.col("was") != F.col("label")).isEmpty():
            return labels
