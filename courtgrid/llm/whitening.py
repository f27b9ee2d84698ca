"""Whitening of embeddings from the singular values of the centred rows.

Sums over the distinct integer vectors are exact.  Tasks centre their rows and reduce
them to triangular factors block by block (QR); the factors are joined in rounds of
FAN at a time, so neither a task nor the driver holds more than a few triangles.  The
last triangle R has R'R = sum of the centred outer products without ever forming it:
its squared singular values over n are the eigenvalues, its right singular vectors the
components (see ``bidiagonal``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bidiagonal import leading
from .common import materialise
from .vectors import integer_vectors, matrix

FAN = 16            # triangles that one task joins in a round
COLUMNS = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double")


def _sums(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dim, object), 0
        for batch in batches:
            x = matrix(batch.column(0), dim)
            if x.size and float(np.abs(x.astype(np.float64)).max()) * len(x) >= 2.0 ** 62:
                x = x.astype(object)
            total = total + x.sum(0).astype(object)
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([
                pa.array(range(-1, dim), pa.int32()), pa.array([str(v) for v in [n, *total]])], names=["place", "total"])

    return run


def sums(distinct: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of rows and exact sum of every dimension (one row a dimension comes to the driver)."""
    parts = distinct.mapInArrow(_sums(dim), "place int, total string")
    rows = dict(map(tuple, parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()))
    return int(rows.get(-1, 0)), [int(rows.get(i, 0)) for i in range(dim)]


def centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """x less the means: whole parts in integers, the rest of the division in double precision."""
    whole = np.array([s // n for s in total], np.int64)
    rest = np.array([(s % n) / n for s in total], np.float64)
    return (x - whole).astype(np.float64) - rest


def _triangle(rows: np.ndarray) -> np.ndarray:
    """R of a QR factorisation, square, filled up with zero rows."""
    dim = rows.shape[1]
    r = np.linalg.qr(rows, mode="r") if len(rows) else np.zeros((0, dim))
    return np.vstack((r, np.zeros((dim - len(r), dim)))) if len(r) < dim else r


def triangle(distinct: DataFrame, dim: int, n: int, total: list[int]) -> np.ndarray:
    """R of the QR factorisation of all centred rows, by rounds of block factorisations."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            own = centred(matrix(batch.column(0), dim), n, total)
            r = _triangle(own if r is None else np.vstack((r, own)))
        if r is not None:
            yield packed(r)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for cell in batch.column(0):
                own = np.frombuffer(cell.as_buffer(), np.float64).reshape(dim, dim)
                r = own if r is None else _triangle(np.vstack((r, own)))
        if r is not None:
            yield packed(r)

    def packed(r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(r).tobytes()], pa.binary())], names=["r"])

    parts = materialise(distinct.mapInArrow(first, "r binary"), "whitening-triangles")
    count = parts.count()
    while count > FAN:
        count = -(-count // FAN)
        parts = materialise(parts.repartition(count).mapInArrow(joined, "r binary"), "whitening-triangles")
        count = parts.count()
    left = [np.frombuffer(row.r, np.float64).reshape(dim, dim) for row in parts.collect()]
    return _triangle(np.vstack(left))


def identity_error(distinct: DataFrame, dim: int, n: int, total: list[int], turn: np.ndarray) -> float:
    """Largest absolute entry of the whitened distinct rows' covariance less the identity."""
    k = turn.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sq = np.zeros((k, k))
        one = np.zeros(k)
        for batch in batches:
            w = centred(matrix(batch.column(0), dim), n, total) @ turn
            sq += w.T @ w
            one += w.sum(0)
        every = np.concatenate((sq.ravel(), one))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(every)), pa.int32()), pa.array(every)], names=["place", "total"])

    rows = dict(map(tuple, distinct.mapInArrow(run, "place int, total double")
                    .groupBy("place").agg(F.sum("total")).collect()))
    sq = np.array([rows.get(i, 0.0) for i in range(k * k)]).reshape(k, k) / n
    mean = np.array([rows.get(k * k + i, 0.0) for i in range(k)]) / n
    return float(np.abs(sq - np.outer(mean, mean) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, exact; null where it is beyond a long."""
    most = max([n * (abs(int(v)) + 1) for v in (x.max(initial=0), x.min(initial=0))] + [abs(s) for s in total] + [1]) * 2
    if most * most * max(len(total), 1) < 2 ** 63:
        return np.square(x * n - np.array(total, np.int64)).sum(1).tolist()
    gap = x.astype(object) * n - np.array(total, object)
    return [v if v < 2 ** 63 else None for v in (gap * gap).sum(1).tolist()]


def whiten(df: DataFrame, k: int = 4, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Whitened coordinates of every usable vector on the first ``k`` components.

    Vectors that are null or hold null or non-finite entries are left out, short ones
    count as filled up with zeros.  Repeated rows, and rows with a null id, have rows of
    their own; each distinct vector counts once in the fit.  A component whose variance
    is zero to rounding is not returned, so a table of one distinct vector, or an empty
    one, gives no row.  ``deviation`` is null where it is beyond a long.  Other columns
    are not read.
    """
    spark = df.sparkSession
    rows = integer_vectors(df, id_col, vec_col)
    wide = rows.agg(F.max(F.length("x"))).first()[0] or 0
    dim = wide // 8
    # Filled up before the distinct, so that vectors that differ in trailing zeros alone are one.
    filled = F.concat(F.col("x"), F.unhex(F.repeat(F.lit("00"), F.lit(wide) - F.length("x"))))
    rows = materialise(rows.select("vec_id", filled.alias("x")), "whitening-rows")
    distinct = materialise(rows.select("x").distinct(), "whitening-distinct")
    n, total = sums(distinct, dim)
    values, vectors = leading(triangle(distinct, dim, n, total), k) if n and dim else (np.zeros(0), np.zeros((0, 0)))
    count = vectors.shape[1]
    if not count:
        return spark.createDataFrame([], COLUMNS)
    turn = vectors / np.sqrt(values[:count] / n)
    explained = (values[:count] / math.fsum(values)).tolist()
    error = identity_error(distinct, dim, n, total, turn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), dim)
            at = np.repeat(np.arange(len(x)), count)
            w = centred(x, n, total) @ turn
            far = pa.array(deviations(x, n, total), pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(at), n, np.int64)), far.take(pa.array(at)), pa.array(w.ravel()),
                pa.array(np.tile(explained, len(x))), pa.array(np.full(len(at), error))], schema=schema)

    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])
    return rows.mapInArrow(run, COLUMNS)
