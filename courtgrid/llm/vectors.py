"""Integer vectors from embedding columns, shared by the vector operators.

A component c becomes floor(256 * c), c taken as a double.  Vectors that are null
or hold a null or non-finite component are left out.  Values beyond 2^62 are held
there, so that every vector has an integer form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 256
FAR = float(1 << 62)
EXACT = float(1 << 53)  # sums of products below this are exact in double precision


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows (vec_id long, x binary of little-endian 64-bit integers) of the usable vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.filter(pc.is_valid(batch.column(1)))
            if not rows.num_rows:
                continue
            lists = rows.column(1)
            off = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))).astype(np.int64)
            value = pc.fill_null(lists.flatten(), float("nan")).to_numpy(zero_copy_only=False)
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(value))))
            fine = np.where(np.isfinite(value), value, 0)
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(fine * SCALE), -FAR, FAR).astype("<i8")
            packed = pa.Array.from_buffers(pa.binary(), rows.num_rows, [
                None, pa.py_buffer((off * 8).astype(np.int32)), pa.py_buffer(x)])
            out = pa.RecordBatch.from_arrays([rows.column(0), packed], names=["vec_id", "x"])
            yield out.filter(pa.array(bad[off[1:]] == bad[off[:-1]]))

    return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"))
            .mapInArrow(run, "vec_id long, x binary"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a binary column of 64-bit integers as an int64 matrix, short rows filled up with zeros."""
    n = len(column)
    _, offsets, data = column.buffers()
    if not n:
        return np.zeros((0, dim), np.int64)
    off = np.frombuffer(offsets, np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]].view("<i8") if data is not None else np.zeros(0, np.int64)
    off = (off - off[0]) // 8
    if (np.diff(off) == dim).all():
        return raw.reshape(n, dim).astype(np.int64)
    out = np.zeros((n, dim), np.int64)
    row = np.repeat(np.arange(n), np.diff(off))
    out[row, np.arange(len(raw)) - off[row]] = raw
    return out
