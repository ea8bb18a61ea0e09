"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The inertia of ``a - s`` (signs of the pivots of a Bunch-Kaufman LDL' factorisation) counts
the eigenvalues above ``s``.  Bisection on these counts isolates each leading eigenvalue;
Rayleigh quotient iteration, which converges cubically, finds its vector from inside the
slice; a last pair of counts around every value certifies its number.  A run of eigenvalues
that agree to rounding cannot be sliced: its vectors are found one after another, each in the
orthogonal complement of those before.
"""

from __future__ import annotations

import numpy as np

_ALPHA = (1 + 17 ** 0.5) / 8
_EPS = np.finfo(float).eps


def count_above(a: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of ``a`` above ``shift``, from LDL' of ``a - shift``."""
    m = a - shift * np.eye(len(a))
    n, k, above = len(m), 0, 0

    def swap(i: int, j: int) -> None:
        if i != j:
            m[[i, j]] = m[[j, i]]
            m[:, [i, j]] = m[:, [j, i]]

    while k < n:
        size, pivot = 1, abs(m[k, k])
        below = np.abs(m[k + 1:, k])
        largest = below.max(initial=0.0)
        if pivot < _ALPHA * largest:
            r = k + 1 + int(below.argmax())
            row = np.abs(m[r, k:])
            row[r - k] = 0
            reach = row.max()
            if pivot * reach < _ALPHA * largest * largest:
                if abs(m[r, r]) >= _ALPHA * reach:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    size = 2
        if size == 1:
            d = m[k, k]
            above += bool(d > 0)
            if d != 0:
                v = m[k + 1:, k].copy()
                m[k + 1:, k + 1:] -= np.outer(v / d, v)
        else:
            e = m[k:k + 2, k:k + 2]
            # a pivot block of this kind has one eigenvalue of either sign
            above += 1 if e[0, 0] * e[1, 1] < e[0, 1] * e[1, 0] else 2 * bool(e[0, 0] + e[1, 1] > 0)
            c = m[k + 2:, k:k + 2].copy()
            m[k + 2:, k + 2:] -= c @ np.linalg.solve(e, c.T)
        k += size
    return above


def slices(a: np.ndarray, wanted: int, tolerance: float) -> list[tuple[float, float, int]]:
    """Disjoint intervals (low, high, count) from the top that hold the ``wanted`` largest
    eigenvalues: one each, or several that lie within ``tolerance``."""
    radius = np.abs(a).sum(axis=1).max() * (1 + 4 * _EPS) + tolerance  # no eigenvalue lies beyond
    todo, out = [(-radius, radius, len(a), 0)], []
    while todo:
        low, high, upto, before = todo.pop()
        if before >= wanted:
            continue
        if upto - before == 1 or high - low <= tolerance:
            out.append((low, high, upto - before))
            continue
        middle = (low + high) / 2
        at = min(max(count_above(a, middle), before), upto)
        if upto > at:
            todo.append((low, middle, upto, at))
        if at > before:
            todo.append((middle, high, at, before))
    return sorted(out, key=lambda s: -s[1])


def _solve(a: np.ndarray, shift: float, x: np.ndarray, nudge: float) -> np.ndarray:
    try:
        y = np.linalg.solve(a - shift * np.eye(len(a)), x)
        if np.isfinite(y).all():
            return y
    except np.linalg.LinAlgError:
        pass
    return np.linalg.solve(a - (shift + nudge) * np.eye(len(a)), x)


def _vector(a: np.ndarray, low: float, high: float, found: list[np.ndarray], scale: float,
            seed: int) -> tuple[float, np.ndarray] | None:
    """An eigenpair inside the slice by Rayleigh quotient iteration, or None if it left."""
    near = np.array(found) if found else np.zeros((0, len(a)))

    def unit(y: np.ndarray) -> np.ndarray:
        for _ in range(2):
            y = y - near.T @ (near @ y)
            y = y / np.linalg.norm(y)
        return y

    floor, slack = 8 * _EPS * scale, 64 * _EPS * scale
    x = unit(np.random.default_rng(seed).standard_normal(len(a)))
    for _ in range(3):  # inverse iteration draws the start to the slice
        x = unit(_solve(a, (low + high) / 2, x, floor))
    best = (np.inf, 0.0, x)
    for _ in range(30):
        value = float(x @ a @ x)
        residual = float(np.linalg.norm(a @ x - value * x))
        if residual >= best[0]:
            break
        best = (residual, value, x)
        x = unit(_solve(a, value, x, floor))
    residual, value, x = best
    if residual > 1e3 * len(a) * _EPS * scale or not low - slack <= value <= high + slack:
        return None
    return value, x


def leading(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors as columns.

    A vector's largest component (the first of equals) is positive."""
    a = (a + a.T) / 2
    scale = float(np.abs(a).sum(axis=1).max(initial=0.0))
    wanted = min(wanted, len(a))
    if not wanted or scale == 0:
        return np.zeros(wanted), np.eye(len(a))[:, :wanted]
    tolerance = 16 * len(a) * _EPS * scale
    values, vectors = [], []
    todo = slices(a, wanted, tolerance)[::-1]
    while todo and len(values) < wanted:
        low, high, count = todo.pop()
        got = _vector(a, low, high, vectors, scale, len(values))
        if got is None and high - low > tolerance:
            middle = (low + high) / 2  # it left the slice: halve and try again
            upper = min(max(count_above(a, middle) - len(values), 0), count)
            todo.append((low, middle, count) if not upper else (middle, high, count))
            continue
        if got is None:
            raise ArithmeticError("an eigenvector of a slice was not found")
        values.append(got[0])
        vectors.append(got[1])
        if count > 1:
            todo.append((low, high, count - 1))
    order = np.argsort(-np.array(values), kind="stable")
    value, vector = np.array(values)[order], np.array(vectors)[order].T
    for k, e in enumerate(value):
        if count_above(a, e + tolerance) > k or count_above(a, e - tolerance) < k + 1:
            raise ArithmeticError(f"eigenvalue {k + 1} is not certified by its counts")
    peak = vector[np.abs(vector).argmax(axis=0), np.arange(len(value))]
    return value, vector * np.where(peak < 0, -1.0, 1.0)
