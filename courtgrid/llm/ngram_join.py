"""N-gram Jaccard join over a MinHash LSH forest.

Every text is the set of its five-word shingles.  Equal sets form a class, whose
least row stands for it.  A forest of ``TREES`` prefix trees is built over
MinHash signatures: at depth d of a tree, classes that share the first d minima
are in one node.  Prefixes start at the deepest level and are shortened tree by
tree, the tree first whose next level adds the fewest pairs (counted over all
classes), until a pair at the threshold is found with at least ``TARGET_RECALL``:
1 - prod(1 - threshold ** depth_t).  Nodes with the same members in several
trees are compared once.  All pairs of a node are verified by the exact Jaccard
similarity of their shingle sets, in blocks (see ``blocks``), so a hot node is
many small groups and only counts and roots leave them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import compare_groups, components, first_shared, spread_blocks
from .common import materialise, mix64, random64, shingle_hashes, slices, utf8, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
TREES = 16
DEPTHS = (3, 4, 5)
TARGET_RECALL = 0.9999
BLOCK = 192            # rows of a block; a group holds two blocks at most
SEEN = 100_000         # ids of repeated rows that a task remembers (a row met again is dropped where it is compared)

_MIN = random64(2 * TREES * DEPTHS[-1], 101)


def signature_keys(shingles: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Node keys of rows with shingles: one per tree and depth, n x (TREES * len(DEPTHS))."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    first = off[:-1]
    n, deep = len(first), DEPTHS[-1]
    keys = np.empty((n, TREES * len(DEPTHS)), np.int64)
    for t in range(TREES):
        state = np.full(n, t + 1, np.uint64)
        for d in range(deep):
            a = np.uint32(_MIN[2 * (t * deep + d)] >> np.uint64(32)) | np.uint32(1)
            b = np.uint32(_MIN[2 * (t * deep + d) + 1] >> np.uint64(32))
            low = np.minimum.reduceat(short * a + b, first)
            state = mix64(state * np.uint64(0x9E3779B97F4A7C15) + low.astype(np.uint64) + np.uint64(1))
            if d + 1 in DEPTHS:
                keys[:, t * len(DEPTHS) + DEPTHS.index(d + 1)] = state.view(np.int64)
    return keys


def row_sets(part: pa.RecordBatch, column: str) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row of a batch."""
    data, off = utf8(part.column(part.schema.get_field_index(column)))
    shingles, at = shingle_hashes(*word_hashes(data, off), SHINGLE)
    return [np.unique(shingles[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, digest of the shingle set (null without words) and the node keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = row_sets(part, "text")
                full = [i for i, s in enumerate(sets) if len(s)]
                keys: list = [None] * len(sets)
                if full:
                    sizes = [len(sets[i]) for i in full]
                    rows = signature_keys(np.concatenate([sets[i] for i in full]),
                                          np.concatenate(([0], np.cumsum(sizes))))
                    for i, k in zip(full, rows, strict=True):
                        keys[i] = k
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(digests, pa.binary()),
                                                  pa.array(keys, pa.list_(pa.int64()))],
                                                 names=["doc_id", "text_key", "digest", "keys"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), text_key(docs).alias("text_key"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, digest binary, keys array<long>")


def text_key(docs: DataFrame):
    return F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))


def choose_depths(load: dict[tuple[int, int], float], threshold: float, target: float) -> list[int]:
    """Depth of each tree: shortened one step at a time, the cheapest first, until the target recall.

    ``load``: pairs of classes that share a node, by (tree, depth).
    """
    depth = [DEPTHS[-1]] * TREES

    def recall() -> float:
        return 1 - float(np.prod([1 - threshold ** d for d in depth]))

    while recall() < target and max(depth) > DEPTHS[0]:
        tree = min((t for t in range(TREES) if depth[t] > DEPTHS[0]),
                   key=lambda t: ((load.get((t, depth[t] - 1), 0.0) - load.get((t, depth[t]), 0.0))
                                  / np.log((1 - threshold ** depth[t]) / (1 - threshold ** (depth[t] - 1))), t))
        depth[tree] -= 1
    return depth


def similar(sets: list[np.ndarray], blocks: list[int], bi: int, bj: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (of the two blocks, or within the one) with Jaccard similarity >= threshold."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    if n == 2:
        common = np.array([[0, len(np.intersect1d(sets[0], sets[1], assume_unique=True))], [0, 0]], np.float64)
    else:
        flat = np.concatenate(sets)
        row = np.repeat(np.arange(n), sizes)
        order = np.argsort(flat, kind="stable")
        flat, row = flat[order], row[order]
        new = np.concatenate(([True], flat[1:] != flat[:-1]))
        place = np.cumsum(new) - 1
        often = np.bincount(place)[place] > 1   # a shingle of one row adds to no intersection
        row, place = row[often], np.cumsum(new)[often]
        place = np.unique(place, return_inverse=True)[1] if len(place) else place
        common = np.zeros((n, n), np.float32)
        width = 4096
        for at in range(0, int(place[-1]) + 1 if len(place) else 0, width):
            lo, hi = np.searchsorted(place, (at, at + width))
            has = np.zeros((n, width), np.float32)
            has[row[lo:hi], place[lo:hi] - at] = 1
            common += has @ has.T
    union = sizes[:, None] + sizes[None, :] - common
    found = np.triu(common >= threshold * union - 1e-6, 1)
    if bi != bj:
        side = np.array(blocks)
        found &= side[:, None] != side[None, :]
    return np.nonzero(found)


def join(docs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET_RECALL, block: int = BLOCK) -> DataFrame:
    """Near-duplicate class and number of links of every document.

    Returns one row per input row: doc_id, text_key, class_id (least doc_id
    reachable over links; null if no row of the class has an id), n_links (other
    rows whose shingle sets have similarity >= threshold, equal texts included),
    copies (rows of its own shingle set, itself included) and kept (the row with the least doc_id of its class; null ids come last).
    Texts without words link with nothing: class_id is their own id, kept is
    true.  Texts of one to four words have one shingle.  Repeated rows are links
    of each other; the operator reads doc_id and text only.
    """
    sig = materialise(signatures(docs), "ngram-signatures")
    classes = materialise(sig.where("digest is not null").groupBy("digest")
                          .agg(F.count("*").alias("copies"),
                               F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("least"),
                               F.min("keys").alias("keys")), "ngram-classes")
    nodes = materialise(classes.select(F.xxhash64("digest").alias("h"), F.posexplode("keys").alias("pos", "key"))
                        .groupBy("pos", "key").agg(F.count("*").alias("n"), F.bit_xor("h").alias("members"))
                        .where("n > 1"), "ngram-nodes")
    load = {(r["pos"] // len(DEPTHS), DEPTHS[r["pos"] % len(DEPTHS)]): r["pairs"]
            for r in nodes.groupBy("pos").agg(F.sum(F.col("n") * (F.col("n") - 1.0) / 2).alias("pairs")).collect()}
    depth = choose_depths(load, threshold, target)
    chosen = [t * len(DEPTHS) + DEPTHS.index(d) for t, d in enumerate(depth)]
    once = materialise(nodes.where(F.col("pos").isin(chosen)).groupBy("n", "members")
                       .agg(F.min(F.struct("pos", "key")).alias("node")).select("n", "node.pos", "node.key"), "ngram-once")
    own = F.array(*[F.col("keys")[p] for p in chosen])
    members = (classes.select("digest", F.explode(F.arrays_zip(F.array(*[F.lit(p) for p in chosen]).alias("pos"),
                                                               own.alias("key"))).alias("node"))
               .select("digest", "node.pos", "node.key").join(once, ["pos", "key"]))
    active = materialise(members.groupBy(F.col("digest").alias("id"))
                         .agg(F.collect_list(F.struct("pos", "key", "n")).alias("nodes")), "ngram-active")
    chosen_keys = classes.select(F.col("digest").alias("id"), "copies", "least", own.alias("own"))
    active = materialise(active.join(chosen_keys, "id").select(
        "id", "nodes", "copies", "own", F.col("least.doc_id").alias("rep_id"), F.col("least.text_key").alias("rep_key")),
        "ngram-active")
    texts = docs.select(F.col("doc_id").alias("rep_id"), F.col("text").cast("string").alias("text"), text_key(docs).alias("rep_key"))
    found = texts.join(active, texts["rep_id"].eqNullSafe(active["rep_id"]) & (texts["rep_key"] == active["rep_key"])) \
        .select("text", "id", "copies", "own", "nodes")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            # a repeated row (same id and text) is met once a task: a sorted join brings its
            # copies one after the other, a broadcast one has few ids
            first = []
            for id_, copies in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                first.append(copies == 1 or id_ not in seen)
                if copies > 1:
                    seen.add(id_)
            if len(seen) > SEEN:
                seen = {batch.column(1)[-1].as_py()}
            batch = batch.filter(pa.array(first))
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), part.column(3), part.column(4),
                     pa.array([s.tobytes() for s in row_sets(part, "text")], pa.binary())],
                    names=["id", "copies", "own", "nodes", "shingles"])

    nested = "array<struct<pos:int,key:long,n:long>>"
    filled = found.mapInArrow(sets, f"id binary, copies long, own array<long>, nodes {nested}, shingles binary")
    rows = filled.select("id", "copies", "own", "shingles", F.explode("nodes").alias("node")) \
        .select("id", "copies", "own", "shingles", "node.pos", "node.key", "node.n")
    groups = spread_blocks(rows, "key", "n", "id", block).drop("n")

    def linked(key: tuple, cols: dict[str, list]):
        # a repeated row may come once from each task that met it
        met = {x: i for i, x in reversed(list(enumerate(cols["id"])))}
        take = sorted(met.values())
        if len(take) < len(cols["id"]):
            for c in cols:
                cols[c] = [cols[c][i] for i in take]
        shingle_sets = [np.frombuffer(s, np.uint64) for s in cols["shingles"]]
        left, right = similar(shingle_sets, cols["own_block"], key[2], key[3], threshold)
        own_keys = cols["own"]
        return left, right, first_shared(own_keys, key[1], left, right) if len(left) else np.zeros(0, bool)

    partial = materialise(compare_groups(groups, ["pos", "key", "bi", "bj"], linked), "ngram-links")
    links = partial.groupBy(F.col("id").alias("digest")).agg(F.sum("links").alias("links"))
    labels = components(partial.select(F.col("id").alias("a"), F.col("root").alias("b")))
    labelled = materialise(classes.select("digest", "copies", "least")
                           .join(labels.select(F.col("id").alias("digest"), "label"), "digest", "left")
                           .withColumn("label", F.coalesce("label", "digest")), "ngram-labelled")
    heads = materialise(labelled.groupBy("label").agg(F.min("least").alias("head")), "ngram-heads")
    info = materialise(labelled.join(heads, "label").join(links, "digest", "left")
                       .select("digest", "copies", F.col("head").alias("head"),
                               (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "ngram-info")
    out = sig.select("doc_id", "text_key", "digest").join(info, "digest", "left")
    return out.select(
        "doc_id", "text_key",
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
        F.when(F.col("head").isNull(), F.lit(True))
        .otherwise(F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_key") == F.col("head.text_key"))).alias("kept"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each near-duplicate class; columns as they are.

    Rows equal in id and text are one document: one of them stays (texts without
    words all stay).
    """
    kept = join(docs.select("doc_id", "text"), threshold).where("kept").groupBy(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__text_key")).agg(F.max("copies").alias("__copies"))
    kept = materialise(kept, "ngram-kept")
    keyed = docs.withColumn("__text_key", text_key(docs))
    left = keyed.join(kept, keyed["doc_id"].eqNullSafe(kept["__id"]) & (keyed["__text_key"] == kept["__text_key"])) \
        .select(*[keyed[c] for c in keyed.columns], "__copies")
    # only rows whose set has copies can be repeated: the others do not move again
    once = left.where("__copies = 1").unionByName(left.where("__copies > 1").dropDuplicates(["doc_id", "__text_key"]))
    return once.select(*[F.col(f"`{c}`") for c in docs.columns])
