"""Singular values and right singular vectors of a small matrix: Householder, dqds, twisted factorisations."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
TINY = np.finfo(np.float64).tiny


def stack(upper: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The triangular factor of both matrices, one above the other."""
    return np.linalg.qr(np.vstack([upper, rows]), mode="r")


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with r = U B V^T for some orthogonal U."""
    a = np.array(r, np.float64)
    m, n = a.shape
    if m < n:
        a = np.vstack([a, np.zeros((n - m, n))])
    v = np.eye(n)

    def mirror(x: np.ndarray) -> np.ndarray | None:
        """Unit normal of the reflection that leaves only the first component of x."""
        most = np.abs(x).max(initial=0)
        if len(x) < 2 or not np.abs(x[1:]).max(initial=0):
            return None
        u = x / most
        u[0] += np.copysign(np.linalg.norm(u), u[0])
        return u / np.linalg.norm(u)

    for k in range(n):
        if (u := mirror(a[k:, k].copy())) is not None:
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k < n - 1 and (u := mirror(a[k, k + 1 :].copy())) is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ u, u)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, bool]:
    """One differential quotient-difference step: (q, e, least d, whether all d before the last are positive).

    The last d is negative if the shift is above the least value.
    """
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    d = least = q[0] - shift
    for i in range(n - 1):
        if d < 0:
            return q, e, d, False
        new_q[i] = d + e[i]
        if new_q[i]:
            ratio = q[i + 1] / new_q[i]
            new_e[i], d = e[i] * ratio, d * ratio - shift
        else:
            d = q[i + 1] - shift
        least = min(least, d)
    new_q[-1] = d
    return new_q, new_e, least, True


def _step(q: list[float], e: list[float], bound: float) -> tuple[list[float], list[float], float, float]:
    """A step with the largest shift found that keeps all values positive: (q, e, least d, shift).

    ``bound`` is at or above the least value. If only the last d turns negative, shift
    plus that d is a lower bound of the least value, close to third order.
    """
    shift = bound
    for _ in range(4):
        if shift <= 0:
            break
        step = _dqds(q, e, shift)
        if step[3] and step[0][-1] >= 0:
            return *step[:3], shift
        shift = shift + step[0][-1] if step[3] and shift + step[0][-1] > 0 else shift / 4
    return *_dqds(q, e, 0.0)[:3], 0.0


def singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """All singular values of an upper bidiagonal matrix, falling."""
    most = max(np.abs(diagonal).max(initial=0), np.abs(upper).max(initial=0))
    if not most:
        return np.zeros(len(diagonal))
    found: list[float] = []
    # Squares of the matrix, and the sum of the shifts so far.
    pending = [(((diagonal / most) ** 2).tolist(), ((upper / most) ** 2).tolist(), 0.0)]
    while pending:
        q, e, moved = pending.pop()
        bound = 0.0
        while len(q) > 1:
            if e[-1] <= EPS * EPS * (moved + q[-1]):
                found.append(q.pop() + moved)
                e.pop()
                bound = min(bound, min(q))
                continue
            apart = [i for i, x in enumerate(e) if x <= EPS * EPS * moved or x < TINY]
            if apart:
                cut = apart[-1] + 1
                pending.append((q[:cut], e[: cut - 1], moved))
                q, e, bound = q[cut:], e[cut:], 0.0
                continue
            if q[0] < q[-1]:  # the transpose read from its other end: the small values belong last
                q, e = q[::-1], e[::-1]
            q, e, bound, shift = _step(q, e, bound)
            moved += shift
        found += [x + moved for x in q]
    return most * np.sqrt(np.sort(np.maximum(found, 0))[::-1])


def _twisted(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(above, below, gamma): factors of B^T B - value from the top, from the bottom, and the twist pivots."""
    n = len(a)
    q, e, f = a * a, b * b, a[:-1] * b
    least = EPS * EPS * max(q.max(), e.max(initial=0), TINY)
    # A pivot of zero is moved by a rounding error.
    above, below = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
    s, p = np.empty(n), np.empty(n)
    s[0], p[-1] = -value, q[-1] - value
    for i in range(n - 1):
        d = s[i] + q[i]
        d, s[i] = (d, s[i]) if abs(d) > least else (least, least - q[i])
        above[i] = f[i] / d
        s[i + 1] = e[i] * (s[i] / d) - value
    for i in range(n - 2, -1, -1):
        d = p[i + 1] + e[i]
        d, p[i + 1] = (d, p[i + 1]) if abs(d) > least else (least, least - e[i])
        below[i] = f[i] / d
        p[i] = p[i + 1] * (q[i] / d) - value
    return above, below, s + p + value


def _vector(above: np.ndarray, below: np.ndarray, twist: int) -> np.ndarray:
    z = np.zeros(len(above) + 1)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -z[i + 1] * above[i]
    for i in range(twist, len(above)):
        z[i + 1] = -z[i] * below[i]
    return z / np.linalg.norm(z)


def right_vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A unit right singular vector per given singular value, as columns, at right angles to each other.

    The twist stands where its pivot is least. Where that gives a vector found before,
    as equal values do, the next places are tried.
    """
    n = len(diagonal)
    out = np.zeros((n, len(values)))
    most = max(np.abs(diagonal).max(initial=0), np.abs(upper).max(initial=0), TINY)
    for k, value in enumerate(values / most):
        above, below, gamma = _twisted(diagonal / most, upper / most, value * value)
        best, size = None, 0.0
        for twist in np.argsort(np.abs(gamma), kind="stable"):
            z = _vector(above, below, int(twist))
            for _ in range(2):
                z = z - out[:, :k] @ (out[:, :k].T @ z)
            left = np.linalg.norm(z)
            if left > size:
                best, size = z / left, left
            if left > 0.5:
                break
        out[:, k] = best
    return out


def principal(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all singular values, the first k directions as columns, how many of these are sound).

    Directions of values at rounding level are not sound.
    """
    diagonal, upper, v = bidiagonalise(r)
    values = singular_values(diagonal, upper)
    sound = int((values[:k] > len(values) * EPS * values[:1].max(initial=0)).sum())
    return values, v @ right_vectors(diagonal, upper, values[:sound]), sound
