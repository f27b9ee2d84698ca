"""Embedding near-duplicates over a forest of random-projection trees.

A tree splits the unit vectors recursively along random directions; vectors
within a margin of a split go to both sides (spill), so close vectors are seldom
parted.  Splits stand in the thinnest place between the 30 % and 70 % quantiles
of a bounded sample, so that they seldom cut a dense group; below the depth the
sample can fit they stand at zero.  The depth follows the number of vectors, so
leaves keep their size as the data grow.  All vectors of a leaf are compared in
double precision, in blocks (see ``blocks``): a dense group that no split can
part is many small groups.  Links of several trees are united; a pair is counted
in the first leaf that both vectors share.

A deeper tree parts more pairs, so the number of trees follows the depth: enough
for a pair exactly at the threshold to share a leaf with probability ``RECALL``,
both by the chance that a split at zero parts it and as counted on pairs planted
at the threshold around vectors of the sample, sent down the fitted trees.
"""

from __future__ import annotations

import hashlib
import math
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import compare_groups, components, first_shared, spread_blocks
from .common import materialise

TREES = 6              # least trees
MOST_TREES = 64        # what a leaf key has room for; a warning says when the recall would need more
RECALL = 0.9999        # chance that a pair at the threshold shares a leaf
PLANTED = 65_536       # pairs on which the fitted trees are tried
LEAF = 256             # aimed distinct vectors of a leaf before spill
SAMPLE = 16_384        # most vectors that the splits are fitted on (every vector is indexed and compared)
SPILL = 0.5            # margin on either side of a split, in standard deviations of a linked pair's distance along it
MIN_FIT = 32           # sampled vectors of a node from which its split is fitted
BLOCK = 768


def parted(dim: int, threshold: float, margin: float) -> float:
    """Chance that a split at zero along a random direction parts two unit vectors of cosine ``threshold``.

    Only the direction's share in the plane of the two counts: its squared length
    is Beta(1, (dim - 2) / 2), its angle uniform.
    """
    if dim < 2:
        return 0.0
    p = (np.arange(20_000) + 0.5) / 20_000
    length = np.sqrt(1 - (1 - p) ** (2 / (dim - 2))) if dim > 2 else np.ones(1)
    wide = np.arccos(np.minimum(margin / length, 1))  # angles on the far side of the margin, left and right
    return float(np.mean(np.maximum(2 * wide + math.acos(max(threshold, -1)) - math.pi, 0)) / math.pi)


def at_cosine(rows: np.ndarray, cosine: float, rng: np.random.Generator) -> np.ndarray:
    """A unit vector at the given cosine from each unit vector, in a random direction."""
    side = rng.standard_normal(rows.shape)
    side -= (side * rows).sum(1, keepdims=True) * rows
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    return cosine * rows + math.sqrt(max(1 - cosine * cosine, 0)) * side


class Forest:
    """Random-projection trees for unit vectors of each dimension met in the sample.

    Directions come from the tree and depth alone, so only split places are kept:
    at most one for every MIN_FIT / 2 sampled vectors and tree.
    """

    def __init__(self, sample: dict[int, np.ndarray], depth: int, threshold: float, recall: float = RECALL):
        self.depth, self._threshold = depth, threshold
        self._split: dict[tuple[int, int, int], float] = {}  # (dimension, tree, node) -> place
        self._fitted: dict[int, int] = dict.fromkeys(sample, 0)  # dimension -> trees fitted
        self.trees = TREES
        for dim, rows in sample.items():
            missed = 1 - (1 - parted(dim, threshold, self._margin(dim))) ** depth
            by_chance = math.ceil(math.log(1 - recall) / math.log(missed)) if 0 < missed < 1 else 1
            self.trees = max(self.trees, by_chance, self._tried(dim, rows, recall))
        if self.trees > MOST_TREES:
            warnings.warn(f"a recall of {recall} needs {self.trees} trees, {MOST_TREES} are built", stacklevel=2)
            self.trees = MOST_TREES
        for dim, rows in sample.items():
            self._need(dim, rows, self.trees)
        self._split = {k: v for k, v in self._split.items() if k[1] < self.trees}

    def _need(self, dim: int, rows: np.ndarray, trees: int) -> None:
        for t in range(self._fitted[dim], trees):
            self._fit(dim, t, rows)
        self._fitted[dim] = max(self._fitted[dim], trees)

    def _tried(self, dim: int, rows: np.ndarray, recall: float) -> int:
        """Least trees after which at most 1 - recall of the planted pairs have no leaf in common."""
        rng = np.random.default_rng([dim, 17])
        first = np.zeros(MOST_TREES + 2, np.int64)  # pairs by the first tree that joins them
        if dim < 2 or not self.depth:
            return 1
        own = np.unique(rows, axis=0)  # copies of one vector are one place to plant at
        step = max(256, (1 << 22) // dim)
        for at in range(0, PLANTED, step):
            left = own[rng.integers(0, len(own), min(step, PLANTED - at))]
            right = at_cosine(left, self._threshold, rng)
            for tree in range(MOST_TREES + 1):
                if not len(left) or tree == MOST_TREES:
                    first[tree + 1] += len(left)
                    break
                self._need(dim, rows, tree + 1)
                joined = self.together(left, right, tree)
                first[tree + 1] += joined.sum()
                left, right = left[~joined], right[~joined]
        missed = PLANTED - np.cumsum(first)
        return int(np.argmax(missed <= (1 - recall) * PLANTED))

    def together(self, left: np.ndarray, right: np.ndarray, tree: int) -> np.ndarray:
        """For each pair of unit vectors: do the two share a leaf of the tree?"""
        n, dim = left.shape
        margin = self._margin(dim)
        who, node = np.arange(n), np.ones(n, np.int64)
        for level in range(self.depth):
            direction = self._direction(dim, tree, level)
            one, two = (left @ direction)[who], (right @ direction)[who]
            split = self._places(dim, tree, node)
            low, high = np.maximum(one, two) < split + margin, np.minimum(one, two) >= split - margin
            who, node = (np.concatenate((who[low], who[high])),
                         np.concatenate((2 * node[low], 2 * node[high] + 1)))
        out = np.zeros(n, bool)
        out[who] = True
        return out

    def _places(self, dim: int, tree: int, node: np.ndarray) -> np.ndarray:
        places, back = np.unique(node, return_inverse=True)
        return np.array([self._split.get((dim, tree, int(p)), 0.0) for p in places])[back]

    def _margin(self, dim: int) -> float:
        return SPILL * math.sqrt(max(2 - 2 * self._threshold, 0) / dim)

    def _direction(self, dim: int, tree: int, level: int) -> np.ndarray:
        x = np.random.default_rng([dim, tree, level]).standard_normal(dim)
        return x / np.linalg.norm(x)

    def _fit(self, dim: int, tree: int, rows: np.ndarray) -> None:
        margin = self._margin(dim)
        nodes = {1: np.arange(len(rows))}
        for level in range(self.depth):
            along = rows @ self._direction(dim, tree, level)
            below: dict[int, np.ndarray] = {}
            for node, own in nodes.items():
                if len(own) < MIN_FIT:
                    continue
                at = np.sort(along[own])
                places = at[int(0.3 * len(at)):int(0.7 * len(at)) + 1]
                crowd = np.searchsorted(at, places + 2 * margin) - np.searchsorted(at, places - 2 * margin)
                middle = np.abs(np.arange(len(places)) - len(places) / 2)
                place = float(places[np.lexsort((middle, crowd))[0]])
                self._split[dim, tree, node] = place
                below[2 * node], below[2 * node + 1] = own[along[own] < place], own[along[own] >= place]
            nodes = below

    def leaves(self, rows: np.ndarray) -> list[list[int]]:
        """Leaf keys of each unit vector, tree by tree."""
        n, dim = rows.shape
        out: list[list[int]] = [[] for _ in range(n)]
        margin = self._margin(dim)
        for tree in range(self.trees):
            who, node = np.arange(n), np.ones(n, np.int64)
            for level in range(self.depth):
                along = (rows @ self._direction(dim, tree, level))[who]
                split = self._places(dim, tree, node)
                low, high = along < split + margin, along >= split - margin
                who, node = (np.concatenate((who[low], who[high])),
                             np.concatenate((2 * node[low], 2 * node[high] + 1)))
            order = np.lexsort((node, who))
            for w, leaf in zip(who[order].tolist(), node[order].tolist(), strict=True):
                out[w].append(((dim % 4096) << 50) | (tree << 44) | leaf)
        return out


def unit_rows(vectors: list) -> list[np.ndarray | None]:
    """Unit vectors in double precision; None for null, empty, zero or non-finite ones."""
    out: list[np.ndarray | None] = []
    for v in vectors:
        if v is None or len(v) == 0 or any(x is None for x in v):
            out.append(None)
            continue
        x = np.asarray(v, np.float64)
        big = np.abs(x).max()
        if not np.isfinite(x).all() or big == 0:
            out.append(None)
            continue
        x = x / big
        out.append(x / np.linalg.norm(x))
    return out


def _fit_forest(vectors: DataFrame, threshold: float) -> tuple[Forest, int]:
    n = vectors.count()
    picked = vectors.select("embedding").orderBy(F.xxhash64("embedding", F.lit("sample"))).limit(SAMPLE).collect()
    by_dim: dict[int, list] = {}
    for x in unit_rows([r[0] for r in picked]):
        if x is not None:
            by_dim.setdefault(len(x), []).append(x)
    depth = min(40, max(0, math.ceil(math.log2(max(n, 1) / LEAF))))
    return Forest({d: np.array(x) for d, x in by_dim.items()}, depth, threshold), n


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, block: int = BLOCK) -> DataFrame:
    """Links of every vector at cosine >= threshold, and its component.

    ``vectors`` has vec_id and embedding.  Returns one row per input row: vec_id,
    n_links, component_id (least vec_id reachable over links, itself included),
    kept (vec_id = component_id).  Equal vectors are one node of weight; all
    their rows link with each other.  Null, empty, zero and non-finite vectors, and
    those with null components, link with nothing, and vectors of different
    lengths never link.  Null ids are counted as links but never lead a component
    that has an id.  An empty table gives no rows; other columns play no part.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    forest, _ = _fit_forest(rows, threshold)
    kind = rows.schema["vec_id"].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                unit = unit_rows(part.column(1).to_pylist())
                leaves: list = [None] * len(unit)
                for dim in sorted({len(x) for x in unit if x is not None}):
                    own = [i for i, x in enumerate(unit) if x is not None and len(x) == dim]
                    for i, keys in zip(own, forest.leaves(np.array([unit[i] for i in own])), strict=True):
                        leaves[i] = keys
                raw = [None if x is None else x.tobytes() for x in unit]
                digests = [None if x is None else hashlib.blake2b(x, digest_size=16).digest() for x in raw]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(digests, pa.binary()), pa.array(raw, pa.binary()),
                     pa.array(leaves, pa.list_(pa.int64()))], names=["vec_id", "digest", "vector", "leaves"])

    indexed = materialise(rows.mapInArrow(index, f"vec_id {kind}, digest binary, vector binary, leaves array<long>"),
                          "vec-indexed")
    classes = materialise(indexed.where("digest is not null").groupBy(F.col("digest").alias("id"))
                          .agg(F.count("*").alias("copies"), F.min("vec_id").alias("head"),
                               F.min("vector").alias("vector"), F.min("leaves").alias("leaves")), "vec-classes")
    leaf_rows = classes.select("id", F.explode("leaves").alias("leaf"))
    leaf_sizes = materialise(leaf_rows.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1"), "vec-leaves")
    placed = (classes.select("id", "copies", "vector", "leaves", F.explode("leaves").alias("leaf"))
              .join(leaf_sizes, "leaf"))
    groups = spread_blocks(placed, "leaf", "n", "id", block).drop("n")

    def linked(key: tuple, cols: dict[str, list]):
        x = np.array([np.frombuffer(v, np.float64) for v in cols["vector"]])
        if key[1] == key[2]:
            left, right = np.nonzero(np.triu(x @ x.T >= threshold, 1))
        else:  # two blocks: only across them
            side = np.array(cols["own_block"])
            one, two = np.flatnonzero(side == key[1]), np.flatnonzero(side == key[2])
            left, right = np.nonzero(x[one] @ x[two].T >= threshold)
            left, right = one[left], two[right]
        return left, right, first_shared(cols["leaves"], key[0], left, right) if len(left) else np.zeros(0, bool)

    partial = materialise(compare_groups(groups, ["leaf", "bi", "bj"], linked), "vec-links")
    links = partial.groupBy("id").agg(F.sum("links").alias("links"))
    labels = components(partial.select(F.col("id").alias("a"), F.col("root").alias("b")))
    labelled = materialise(classes.select("id", "copies", "head").join(labels, "id", "left")
                           .withColumn("label", F.coalesce("label", "id")), "vec-labelled")
    heads = materialise(labelled.groupBy("label").agg(F.min("head").alias("component_id")), "vec-heads")
    info = materialise(labelled.join(heads, "label").join(links, "id", "left")
                       .select(F.col("id").alias("digest"), "component_id",
                               (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "vec-info")
    joined = indexed.select("vec_id", "digest").join(info, "digest", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
