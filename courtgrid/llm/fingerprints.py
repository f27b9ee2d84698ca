"""Document fingerprints by content-defined chunking.

A gear hash runs over a text's bytes: every byte shifts the hash by one bit and
adds its table entry, so it depends on the last 32 bytes only.  A chunk ends
where the hash's upper bits are zero; below the normal size more bits must be
zero than above it (normalised chunking), and a chunk has a least and a greatest
size.  Boundaries move with the content, so an insertion changes only the chunks
around it.  The fingerprint is the set of chunk digests with their lengths;
containment of one text in another is the share of its weight, the length of its
distinct chunks, that the other has too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import random64, slices

LEAST, NORMAL, GREATEST = 24, 96, 384
HARD, EASY = 8, 5            # zero bits for a boundary below and above the normal size
ROWS_PER_RANGE = 2_000       # aimed rows of a range in which neighbours are found
MOST_RANGES = 65_536

_GEAR = (random64(256, 71) >> np.uint64(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash at every byte over the 32 bytes up to it, by doubling the window."""
    h = _GEAR[data]
    for span in (1, 2, 4, 8, 16):
        h[span:] = h[span:] + (h[:-span] << np.uint32(span))
    return h


def cuts(data: np.ndarray) -> list[int]:
    """Ends of the chunks of one text's bytes."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = gear(data)
    places = np.flatnonzero(h < np.uint32(1 << (32 - EASY))) + 1
    hard = (h[places - 1] < np.uint32(1 << (32 - HARD))).tolist()
    out, start, i, places = [], 0, 0, places.tolist()
    while n - start > LEAST:
        end = min(start + GREATEST, n)
        while i < len(places) and places[i] < start + LEAST:
            i += 1
        j = i
        while j < len(places) and places[j] <= end:
            if hard[j] or places[j] - start >= NORMAL:
                end = places[j]
                break
            j += 1
        out.append(end)
        start = end
    if start < n:
        out.append(n)
    return out


def chunk_weights(raw: bytes) -> dict[int, int]:
    """Digest of each distinct chunk and its length in bytes."""
    out, start, digest = {}, 0, xxhash.xxh3_64_intdigest
    for end in cuts(np.frombuffer(raw, np.uint8)):
        out[digest(raw[start:end])] = end - start
        start = end
    return out


def fingerprint(weights: dict[int, int]) -> str:
    """Text form: sorted ``digest:length`` in hexadecimal, separated by spaces."""
    return " ".join([f"{d:016x}:{w:x}" for d, w in sorted(weights.items())])


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of a's weight that is in b (two empty texts: 1, an empty one in another: 0)."""
    if not a or not b:
        return float(not a and not b)
    if a == b:
        return 1.0
    return sum(w for d, w in a.items() if d in b) / sum(a.values())


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_guests(rows: DataFrame) -> DataFrame:
    """Deal rows (doc_id, text, tie) into ranges of ids, so that each row's successor is in its range.

    Ranges end at quantiles of the ids.  The first row of a range is also a guest
    of the range before it, and the very first row one of the last range.  Only
    ids and one id per range (MOST_RANGES at most) reach the driver.  Returns
    doc_id, text, tie, range, guest.
    """
    spark, kind = rows.sparkSession, rows.schema["doc_id"].dataType.simpleString()
    ids = rows.select("doc_id")
    ranges = max(1, min(MOST_RANGES, ids.count() // ROWS_PER_RANGE))
    found = ids.select(F.approx_percentile("doc_id", [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0] \
        if ranges > 1 else []
    edges = np.array(sorted({e for e in found or []}), np.int64)

    def place(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, x.fillna(-1).to_numpy().astype(np.int64), side="right"))

    number = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.pandas_udf(place, "long")(F.col("doc_id").cast("long")))
    firsts = sorted((r["range"], r["first"]) for r in ids.where("doc_id is not null").select("doc_id", number.alias("range"))
                    .groupBy("range").agg(F.min("doc_id").alias("first")).collect())
    used = [r for r, _ in firsts] or [0]
    hosts = spark.createDataFrame([(first, used[i - 1]) for i, (_, first) in enumerate(firsts) if i], f"first {kind}, host long")
    head = rows.select("doc_id", "tie").orderBy(F.col("doc_id").asc_nulls_first(), "tie").limit(1).collect()
    dealt = rows.withColumn("range", number).join(F.broadcast(hosts), F.col("doc_id") == F.col("first"), "left")
    home = F.struct(F.col("range"), F.lit(0).alias("guest"))
    visits = [F.when(F.col("host").isNotNull(), F.struct(F.col("host").alias("range"), F.lit(1).alias("guest")))]
    if head:
        is_head = F.col("doc_id").eqNullSafe(F.lit(head[0]["doc_id"]).cast(kind)) & (F.col("tie") == head[0]["tie"])
        visits.append(F.when(is_head, F.struct(F.lit(used[-1]).cast("long").alias("range"), F.lit(2).alias("guest"))))
    return (dealt.select("doc_id", "text", "tie", F.explode(F.filter(F.array(home, *visits), lambda x: x.isNotNull())).alias("to"))
            .select("doc_id", "text", "tie", "to.range", "to.guest"))


RESULT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def fingerprint_rows(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text ends in the start of the next document's (ascending doc_id,
    null ids first, equal ids by a hash of the text; after the last the first).
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next: the shares of the text's weight that the edited
    text's and the next document's fingerprints contain.  Null texts are empty:
    their fingerprint is the empty string, like only to another empty one.
    Repeated rows follow one another; an empty table gives no rows; other
    columns play no part.  Integer ids are expected.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (range, doc_id, text, weights) of the row that waits for its successor
        for batch in batches:
            for part in slices(batch, "text"):
                out: list[tuple] = []
                cols = [part.column(part.schema.get_field_index(c)).to_pylist() for c in ("range", "guest", "doc_id", "text")]
                for number, guest, doc_id, text in zip(*cols, strict=True):
                    weights = chunk_weights(text.encode())
                    if held is not None and held[0] == number:
                        out.append(_result(held, text, weights))
                    held = None if guest else (number, doc_id, text, weights)
                if out:
                    columns = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0], batch.schema.field("doc_id").type), pa.array(columns[1], pa.int64()),
                         *(pa.array(c, pa.string()) for c in columns[2:5]), *(pa.array(c, pa.float64()) for c in columns[5:])],
                        names=["doc_id", *(c.split()[0] for c in RESULT.split(", "))])

    return (with_guests(rows).repartition("range").sortWithinPartitions("range", "guest", F.col("doc_id").asc_nulls_first(), "tie")
            .mapInArrow(run, f"doc_id {kind}, {RESULT}"))


def _result(held: tuple, following: str, following_weights: dict[int, int]) -> tuple:
    _, doc_id, text, weights = held
    changed = edited(text, following).encode()
    changed_weights = chunk_weights(changed)
    return (doc_id, len(text), hashlib.sha256(changed).hexdigest(), fingerprint(weights), fingerprint(changed_weights),
            containment(weights, changed_weights), containment(weights, following_weights))
