"""Leading eigenpairs of a small symmetric matrix.

Householder reflections turn the matrix into a tridiagonal one.  The number of
its eigenvalues below x is the number of negative pivots of T - x I (Sturm), so
bisection finds each wanted eigenvalue to the last bits.  Inverse iteration on
T gives its vector; vectors of eigenvalues that lie close together are made
orthogonal to each other in every iteration.  The reflections, applied in
reverse, carry the vectors back.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
CLUSTER = 1e-3                  # eigenvalues this close, by the norm, are one cluster
ITERATIONS = 6


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """(diagonal, off-diagonal, reflectors) of a symmetric matrix."""
    a = np.array(matrix, float)
    reflectors: list[np.ndarray | None] = []
    for k in range(len(a) - 2):
        column = a[k + 1:, k]
        if not column[1:].any():
            reflectors.append(None)
            continue
        length = -np.copysign(np.linalg.norm(column), column[0])
        v = column.copy()
        v[0] -= length
        v /= np.linalg.norm(v)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] = a[k, k + 1:] = 0
        a[k + 1, k] = a[k, k + 1] = length
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def count_below(diagonal: np.ndarray, off: np.ndarray, x: float, least: float) -> int:
    """How many eigenvalues of the tridiagonal matrix are less than ``x``."""
    below, pivot = 0, 1.0
    for d, e in zip(diagonal.tolist(), [0.0, *off.tolist()], strict=True):
        pivot = d - x - e * e / pivot
        if abs(pivot) < least:
            pivot = -least
        below += pivot < 0
    return below


def largest_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> list[float]:
    """The ``k`` largest eigenvalues, falling, by bisection."""
    n = len(diagonal)
    reach = np.abs(np.append(off, 0)) + np.abs(np.insert(off, 0, 0))
    low, high = float((diagonal - reach).min()), float((diagonal + reach).max())
    norm = max(abs(low), abs(high))
    if norm == 0:
        return [0.0] * k
    least = max(np.finfo(float).tiny, _EPS * _EPS * norm)
    low, high = low - 4 * _EPS * norm, high + 4 * _EPS * norm
    found: list[float] = []
    for j in range(1, k + 1):
        lo, hi = low, high
        while True:
            middle = (lo + hi) / 2
            if middle in (lo, hi) or hi - lo <= _EPS * max(abs(lo), abs(hi)):
                break
            if count_below(diagonal, off, middle, least) > n - j:
                hi = middle
            else:
                lo = middle
        found.append((lo + hi) / 2)
        high = hi               # the next one is no larger
    return found


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """(T - shift I) y = b by elimination with row exchanges."""
    n = len(diagonal)
    d, up, up2 = (diagonal - shift).tolist(), off.tolist() + [0.0], [0.0] * n
    sub, y = off.tolist(), b.tolist()
    for i in range(n - 1):
        low = sub[i]
        if abs(low) > abs(d[i]):
            # Row i + 1 is (low, d[i + 1], up[i + 1]) and becomes the pivot row.
            f = d[i] / low
            d[i], up[i], up2[i], d[i + 1], up[i + 1] = low, d[i + 1], up[i + 1], up[i] - f * d[i + 1], -f * up[i + 1]
            y[i], y[i + 1] = y[i + 1], y[i] - f * y[i + 1]
        else:
            if abs(d[i]) < least:
                d[i] = least
            f = low / d[i]
            d[i + 1] -= f * up[i]
            y[i + 1] -= f * y[i]
    out = [0.0] * (n + 2)
    for i in range(n - 1, -1, -1):
        pivot = d[i] if abs(d[i]) >= least else least
        out[i] = (y[i] - up[i] * out[i + 1] - up2[i] * out[i + 2]) / pivot
    return np.array(out[:n])


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): the ``k`` largest eigenvalues, falling, and unit
    eigenvectors as columns; of each vector the largest entry is positive."""
    matrix = np.asarray(matrix, float)
    n, k = len(matrix), min(k, len(matrix))
    scale = float(np.abs(matrix).max()) if n else 0.0
    if not scale:
        return np.zeros(k), np.eye(n)[:, :k]
    diagonal, off, reflectors = tridiagonal(matrix / scale)
    values = largest_eigenvalues(diagonal, off, k)
    norm = max(map(abs, values)) or 1.0
    least = _EPS * norm
    random = np.random.default_rng(0)
    vectors: list[np.ndarray] = []
    shift = np.inf
    for j, value in enumerate(values):
        # Equal eigenvalues get shifts that differ in the last bits.
        shift = min(value, shift - 2 * least) if j and shift - value < 2 * least else value
        near = [vectors[i] for i in range(j) if values[i] - value <= CLUSTER * norm]
        y = random.standard_normal(n)
        for _ in range(ITERATIONS):
            y = _solve(diagonal, off, shift, y / np.linalg.norm(y), least)
            y /= np.abs(y).max()
            for _ in range(2):
                for other in near:
                    y = y - (other @ y) * other
        vectors.append(y / np.linalg.norm(y))
    back = np.array(vectors).T
    for at in range(len(reflectors) - 1, -1, -1):
        v = reflectors[at]
        if v is not None:
            back[at + 1:] -= 2 * np.outer(v, v @ back[at + 1:])
    back /= np.linalg.norm(back, axis=0)
    back *= np.where(back[np.abs(back).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
    return np.array(values) * scale, back
