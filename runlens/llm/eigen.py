"""Leading eigenpairs of a symmetric matrix (dense, of bounded size).

Householder reflections make it tridiagonal, Sturm counts bisect the wanted
eigenvalues, inverse iteration gives their vectors; vectors of eigenvalues that lie
close together are orthogonalised against each other at every step.
"""

from __future__ import annotations

import numpy as np

#: Eigenvalues nearer than this part of the matrix's norm form a cluster.
CLUSTER = 1e-3
#: Steps of inverse iteration: one gives a residual near rounding, more are for clusters.
STEPS = 4


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, q) with ``q @ T @ q.T`` = ``matrix``."""
    a = np.array(matrix, dtype=np.float64)
    n = len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1:, k]
        scale = np.abs(x).max()
        if scale == 0:
            continue
        v = x / scale
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        sub = a[k + 1:, k + 1:]
        p = 2 * (sub @ v)
        w = p - (v @ p) * v
        sub -= np.outer(v, w) + np.outer(w, v)
        x -= 2 * (v @ x) * v
        a[k, k + 1:] = x
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def sturm_count(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each point of ``at``."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    squares = np.append(0.0, off ** 2)
    count = np.zeros(len(at), np.int64)
    d = np.ones(len(at))
    for k in range(len(diagonal)):
        d = diagonal[k] - at - squares[k] / d
        d = np.where(np.abs(d) < tiny, -tiny, d)
        count += d < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, wanted: int) -> np.ndarray:
    """The ``wanted`` largest eigenvalues, falling, each bisected to neighbouring doubles."""
    n = len(diagonal)
    radius = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    low, high = (diagonal - radius).min(), (diagonal + radius).max()
    margin = np.finfo(float).eps * n * max(abs(low), abs(high)) + np.finfo(float).tiny
    lo, hi = np.full(wanted, low - margin), np.full(wanted, high + margin)
    need = n - 1 - np.arange(wanted)   # eigenvalues below the k-th largest
    while True:
        mid = lo + (hi - lo) / 2
        if ((mid <= lo) | (mid >= hi)).all():
            return mid
        below = sturm_count(diagonal, off, mid) > need
        hi, lo = np.where(below, mid, hi), np.where(below, lo, mid)


def _solve(diagonal: np.ndarray, off: np.ndarray, b: np.ndarray, floor: float) -> np.ndarray:
    """x of (T - shift) x = b by elimination with row exchanges; ``diagonal`` is shifted."""
    n = len(diagonal)
    u0, u1, u2 = diagonal.copy(), np.append(off, 0.0), np.zeros(n)
    x = b.copy()
    for k in range(n - 1):
        if abs(off[k]) > abs(u0[k]):
            factor = u0[k] / off[k]
            own, nxt = u1[k], u0[k + 1]
            u0[k], u1[k], u2[k] = off[k], nxt, u1[k + 1]
            u0[k + 1], u1[k + 1] = own - factor * nxt, -factor * u2[k]
            x[k], x[k + 1] = x[k + 1], x[k] - factor * x[k + 1]
        else:
            factor = off[k] / u0[k] if u0[k] else 0.0
            u0[k + 1] -= factor * u1[k]
            x[k + 1] -= factor * x[k]
    u0[np.abs(u0) < floor] = floor
    for k in range(n - 1, -1, -1):
        x[k] -= (u1[k] * x[k + 1] if k + 1 < n else 0.0) + (u2[k] * x[k + 2] if k + 2 < n else 0.0)
        x[k] /= u0[k]
    return x


def vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix, one column for each of ``values`` (falling)."""
    n = len(diagonal)
    norm = max(np.abs(diagonal).max(initial=0), np.abs(off).max(initial=0), np.finfo(float).tiny)
    out = np.zeros((n, len(values)))
    first = 0
    rng = np.random.default_rng(0)
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k
        x = rng.standard_normal(n)
        for _ in range(STEPS):
            x = _solve(diagonal - value, off, x / np.linalg.norm(x), np.finfo(float).eps * norm)
            x /= np.abs(x).max()
            for _ in range(2):   # twice: the first leaves the rounding of a near parallel
                x -= out[:, first:k] @ (out[:, first:k].T @ x)
        out[:, k] = x / np.linalg.norm(x)
    return out


def leading_pairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of the ``wanted`` largest."""
    diagonal, off, q = tridiagonal(matrix)
    values = leading_values(diagonal, off, min(wanted, len(diagonal)))
    return values, q @ vectors(diagonal, off, values)
