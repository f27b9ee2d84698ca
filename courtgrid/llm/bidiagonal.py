"""Singular values and right singular vectors of a small triangular matrix: Householder
bidiagonalisation, dqds for the singular values, twisted factorisations for the vectors.

Everything here is of the size of one vector's length, on the driver.
"""

from __future__ import annotations

import math

import numpy as np

EPS = np.finfo(np.float64).eps


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and upper diagonal of a bidiagonal B = U' R P, and the reflectors that make up P."""
    a = r.astype(np.float64, copy=True)
    d = a.shape[1]
    turns = []
    for k in range(d):
        v = _reflector(a[k:, k])
        a[k:, k:] -= np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            v = _reflector(a[k, k + 1:])
            a[k:, k + 1:] -= np.outer(a[k:, k + 1:] @ v, v)
            turns.append(v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), turns


def _reflector(x: np.ndarray) -> np.ndarray:
    """v with (I - v v') x a multiple of the first unit vector; zero if it is one already."""
    most = np.abs(x).max() if len(x) else 0.0
    if len(x) < 2 or not np.abs(x[1:]).max() > 0 or not most > 0:
        return np.zeros_like(x)
    v = x / most
    v[0] += math.copysign(np.linalg.norm(v), v[0])
    return v * (math.sqrt(2) / np.linalg.norm(v))


def back(z: np.ndarray, turns: list[np.ndarray]) -> np.ndarray:
    """P z for columns z, from the reflectors of ``bidiagonalise``."""
    z = z.copy()
    for k in range(len(turns) - 1, -1, -1):
        v = turns[k]
        z[k + 1:] -= np.outer(v, v @ z[k + 1:])
    return z


def dqds(diag: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, falling, by shifted differential qd steps.

    A step turns the factors of B'B into those of B'B less a shift without subtracting
    other than the shift.  A shift above the least value makes a negative pivot: the
    step is undone and tried with a quarter of it, at last with none, which always holds.
    """
    values: list[float] = []
    blocks = [(np.square(diag).tolist(), np.square(upper).tolist(), 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        shift, idle = 0.0, 0
        while q:
            n = len(q)
            if n == 1:
                values.append(q[0] + moved)
                break
            if e[-1] <= EPS * EPS * (moved + q[-1]) or e[-1] == 0.0:
                values.append(q.pop() + moved)
                e.pop()
                shift = 0.0
                continue
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= EPS * EPS * (moved + q[i])), None)
            if cut is not None:
                blocks.append((q[:cut + 1], e[:cut], moved))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if q[0] < q[-1] / 4:  # steps shrink the last entries: let the small values stand there
                q, e = _flip(q, e)
            while True:
                step = _step(q, e, shift)
                if step is not None:
                    break
                shift = shift / 4 if shift > EPS * moved else 0.0
            q, e, low = step
            moved += shift
            idle += 1
            # The least pivot is above the least value, and near it once the last entry is small.
            last = e[-1] / (e[-1] + q[-1]) if e[-1] + q[-1] > 0 else 0.0
            shift = low * (1 - math.sqrt(last)) if idle % 8 else 0.0
    return np.sort(np.array(values))[::-1]


def _flip(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The factors of the same values with rows in reverse order (the transposed bidiagonal, read backwards)."""
    return q[::-1], e[::-1]


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd step with a shift, and its least pivot; None where a pivot is negative."""
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    low = d
    for i in range(n - 1):
        if d < 0:
            return None
        new_q[i] = d + e[i]
        if new_q[i] == 0.0:
            new_e[i], d = 0.0, q[i + 1] - shift
        else:
            ratio = q[i + 1] / new_q[i]
            new_e[i] = e[i] * ratio
            d = d * ratio - shift
        low = min(low, d)
    if d < 0:
        return None
    new_q[-1] = d
    return new_q, new_e, max(low, 0.0)


def twisted_vector(diag: np.ndarray, upper: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B at an eigenvalue, from the twisted factorisation of B'B - value.

    The factorisations from the top and from the bottom meet where the remaining pivot
    is least; the vector follows from there by multiplications alone.
    """
    q = np.square(diag)
    low = np.linalg.norm(diag) * EPS
    ratio = upper / np.where(np.abs(diag[:-1]) < low, low, diag[:-1])
    n = len(diag)
    tiny = np.finfo(np.float64).tiny / EPS
    down, up = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = q[i] + s[i]
        pivot = pivot if abs(pivot) > tiny else math.copysign(tiny, pivot)
        down[i] = q[i] * ratio[i] / pivot
        s[i + 1] = down[i] * ratio[i] * s[i] - value
    p[-1] = q[-1] - value
    meet = np.zeros(n)
    meet[-1] = s[-1] + q[-1]
    for i in range(n - 2, -1, -1):
        pivot = q[i] * ratio[i] ** 2 + p[i + 1]
        pivot = pivot if abs(pivot) > tiny else math.copysign(tiny, pivot)
        t = q[i] / pivot
        up[i] = ratio[i] * t
        p[i] = p[i + 1] * t - value
        meet[i] = s[i] + t * p[i + 1]
    z = np.zeros(n)
    r = int(np.argmin(np.abs(meet)))
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def leading(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of R, falling, and the right singular vectors of the first ``k`` as columns.

    Values below the rounding of the largest count as zero and have no vector.  Vectors
    of values that agree to half the digits span their space and are made orthogonal there.
    """
    d = r.shape[1]
    diag, upper, turns = bidiagonalise(r)
    size = max(np.abs(diag).max(initial=0), np.abs(upper).max(initial=0))
    if not size > 0:
        return np.zeros(d), np.zeros((d, 0))
    diag, upper = diag / size, upper / size
    upper = np.where(np.abs(upper) <= EPS * EPS, 0.0, upper)
    values = np.maximum(dqds(diag, upper), 0)
    count = min(k, int((values > (d * EPS) ** 2 * values[0]).sum()))
    # A zero above the diagonal parts the matrix: each part has vectors of its own.
    ends = [0, *(np.flatnonzero(upper == 0) + 1).tolist(), d]
    parts = [(a, b, dqds(diag[a:b], upper[a:b - 1])) for a, b in zip(ends, ends[1:], strict=False)]
    ranked = sorted(((v, a, b) for a, b, own in parts for v in own.tolist()), key=lambda x: -x[0])[:count]
    vectors = np.zeros((d, count))
    for j, (value, a, b) in enumerate(ranked):
        z = np.zeros(d)
        z[a:b] = twisted_vector(diag[a:b], upper[a:b - 1], value)
        close = [i for i in range(j) if abs(ranked[i][0] - value) <= 1e-8 * max(value, EPS)]
        rest = z - vectors[:, close] @ (vectors[:, close].T @ z)
        if close and np.linalg.norm(rest) < 0.5:
            # The same vector again: another one of the space by inverse steps, each made orthogonal to those found.
            found, own = vectors[a:b][:, close], np.random.default_rng(j).standard_normal(b - a)
            for _ in range(4):
                own = _inverse_step(diag[a:b], upper[a:b - 1], value, own - found @ (found.T @ own))
                own -= found @ (found.T @ own)
                own /= np.linalg.norm(own)
            rest = np.zeros(d)
            rest[a:b] = own
        rest -= vectors[:, close] @ (vectors[:, close].T @ rest)
        vectors[:, j] = rest / np.linalg.norm(rest)
    return values * size * size, back(vectors, turns)


def _inverse_step(diag: np.ndarray, upper: np.ndarray, value: float, start: np.ndarray) -> np.ndarray:
    """Direction of (B'B - value)^-1 start."""
    b = np.diag(diag) + np.diag(upper, 1)
    m = b.T @ b - value * np.eye(len(diag))
    m += EPS * max(np.abs(m).max(), 1) * np.eye(len(diag))
    try:
        z = np.linalg.solve(m, start)  # least squares would cut off the very space that is sought
    except np.linalg.LinAlgError:  # exactly singular
        z = np.linalg.lstsq(m, start, rcond=None)[0]
    return z / np.linalg.norm(z)
