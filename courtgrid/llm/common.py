"""Helpers shared by the corpus operators: shared-folder tables, Arrow text
access, and vectorised word and shingle hashing.

Words are maximal runs of bytes outside space and ``\\t \\n \\v \\f \\r``;
A-Z are lower-cased before hashing.  A null text counts as empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 2 << 20  # text bytes that a task hashes at a time: bounds its memory


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    The written table cuts the lineage: a lost executor costs a re-read, not a
    recomputation, and several readers share one computation.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------------------
# Arrow batches
# ---------------------------------------------------------------------------
def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the n + 1 offsets of its rows (null: empty)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows of about ``most`` bytes of text (one row at least)."""
    _, off = utf8(batch.column(batch.schema.get_field_index(column)))
    n, at = batch.num_rows, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(off, off[at] + most, side="right")) - 1)
        end = min(end, n)
        yield batch.slice(at, end - at)
        at = end


# ---------------------------------------------------------------------------
# Hashing
# ---------------------------------------------------------------------------
def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and odd multipliers)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def random64(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                     + np.uint64(seed) * np.uint64(0xD1B54A32D192ED03))


_BYTE = random64(256, 11)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
HASHED = 1 << 16  # bytes whose words are hashed at a time: they fit a core's cache


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS, _INVERSES = _powers(HASHED, _BASE), _powers(HASHED, _INVERSE)


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the n + 1 offsets of each row's words."""
    solid = (data != 32) & (data - np.uint8(9) > 4)
    before = np.empty_like(solid)
    before[1:] = solid[:-1]
    if len(solid):
        before[0] = False
        before[off[:-1][off[:-1] < len(solid)]] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty_like(solid)
    after[:-1] = solid[1:]
    if len(solid):
        after[-1] = False
        ends = off[1:]
        after[ends[(ends > 0)] - 1] = False
    stops = np.flatnonzero(solid & ~after) + 1
    return starts, stops, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, off: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and the n + 1 offsets of each row's words.

    A word's bytes are a polynomial: the difference of two sums from the start of a
    block of words, over the power of the base where the word starts (modulo 2^64).
    """
    starts, stops, rows = word_spans(data, off)
    value, byte = np.empty(len(starts), np.uint64), _BYTE[_LOWER] if lower else _BYTE
    at = 0
    while at < len(starts):
        low = starts[at]
        end = max(at + 1, int(np.searchsorted(stops, low + HASHED, side="right")))
        n = int(stops[end - 1] - low)
        powers, inverses = (_POWERS, _INVERSES) if n <= HASHED else (_powers(n, _BASE), _INVERSES)  # one long word
        terms = byte.take(data[low:low + n])
        terms *= powers[:n]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        first = starts[at:end] - low
        value[at:end] = (sums.take(stops[at:end] - low) - sums.take(first)) * inverses.take(first)
        at = end
    return mix64(value ^ ((stops - starts).astype(np.uint64) << np.uint64(40))), rows


def shingle_hashes(words: np.ndarray, rows: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each row, and their n + 1 offsets.

    A row of 1 to ``size - 1`` words has one shingle, all its words; a row
    without words has none.
    """
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(rows), np.int64)
    per = np.diff(rows)
    end = np.repeat(rows[1:], per)
    at = np.arange(n)
    factor = random64(size, 29) | np.uint64(1)
    padded = np.concatenate((words, np.zeros(size, np.uint64)))
    total = np.zeros(n, np.uint64)
    for j in range(size):
        part = padded[j:j + n] * factor[j]
        part[at + j >= end] = 0
        total += part
    keep = (at + size <= end) | ((np.repeat(per, per) < size) & (at == np.repeat(rows[:-1], per)))
    count = np.concatenate(([0], np.cumsum(keep)))
    return mix64(total[keep]), count[rows]
