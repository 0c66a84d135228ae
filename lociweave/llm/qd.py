"""Singular values and right singular vectors of a small dense matrix by bidiagonal qd algorithms.

Householder reflections bring the matrix to upper bidiagonal form B.  The differential qd algorithm with shifts (dqds)
finds the eigenvalues of BᵀB to high relative accuracy from the squares of B's entries.  Each eigenvector comes from a
twisted factorisation of BᵀB - λ: a stationary qd step from the top, a progressive one from the bottom, joined where
the pivot is smallest.  Vectors of close eigenvalues are made orthogonal by inverse iteration in the same
factorisation.  Everything here is of the size of the matrix, never of the data.
"""

import numpy as np

EPS = float(np.finfo(float).eps)
TINY = float(np.finfo(float).tiny)
MOST_STEPS = 100  # qd steps for each eigenvalue; far more than are ever needed
CLOSE = 1e-3  # eigenvalues that differ by a smaller share are treated as a cluster


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B, and V with ``matrix = U B Vᵀ`` for some orthogonal U; for a square matrix."""
    a = np.array(matrix, float)
    n = len(a)
    v = np.eye(n)
    for k in range(n):
        reflect(a[k:, k:])
        if k + 2 < n:
            w = householder(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(2 * (a[k:, k + 1 :] @ w), w)
            v[:, k + 1 :] -= np.outer(2 * (v[:, k + 1 :] @ w), w)
    return a.diagonal().copy(), a.diagonal(1).copy(), v


def householder(x: np.ndarray) -> np.ndarray:
    """The unit vector whose reflection turns ``x`` into a multiple of the first axis; zero if it is one already."""
    w = x.copy()
    scale = np.abs(w).max(initial=0.0)
    if scale == 0:
        return np.zeros_like(w)
    w /= scale
    w[0] += np.copysign(np.linalg.norm(w), w[0])
    return w / np.linalg.norm(w)


def reflect(block: np.ndarray) -> None:
    """Clear the first column of the block below its first entry."""
    w = householder(block[:, 0])
    block -= np.outer(2 * w, w @ block)


# --- eigenvalues


def newton_bound(q: list[float], e: list[float]) -> float:
    """A lower bound of the smallest eigenvalue: one over the trace of the inverse."""
    w = total = 0.0
    for k in reversed(range(len(q))):
        w = (1 + (e[k] * w if k < len(e) else 0.0)) / max(q[k], TINY)
        total += w
        if total > 1e300:
            return 0.0
    return 1 / total


def qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds transform; None if the shift is too large."""
    d, new_q, new_e = q[0] - shift, [], []
    if d < 0:
        return None
    for k in range(len(e)):
        total = d + e[k]
        new_q.append(total)
        t = q[k + 1] / total if total > 0 else 0.0
        new_e.append(e[k] * t)
        d = d * t - shift
        if d < 0:
            return None
    return [*new_q, d], new_e


def eigenvalues(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Eigenvalues of BᵀB, falling."""
    biggest = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if biggest == 0:
        return np.zeros(len(diagonal))
    parts = [([float(x) ** 2 for x in diagonal / biggest], [float(x) ** 2 for x in above / biggest], 0.0)]
    found = []
    limit = (10 * EPS) ** 2
    while parts:
        q, e, moved = parts.pop()
        if q[0] < q[-1]:  # small values settle at the end; read backwards, BBᵀ is the product of these squares
            q, e = q[::-1], e[::-1]
        for _ in range(MOST_STEPS * len(q)):
            cut = next((k for k in reversed(range(len(e))) if e[k] <= limit * (moved + min(q[k], q[k + 1])) or e[k] <= TINY), None)
            if cut is not None:
                parts.append((q[: cut + 1], e[:cut], moved))
                parts.append((q[cut + 1 :], e[cut + 1 :], moved))
                break
            if len(q) == 1:
                found.append(moved + q[0])
                break
            shift = newton_bound(q, e) * (1 - 4 * EPS * len(q))
            if shift <= EPS * moved:
                shift = 0.0  # it would be lost in the sum
            step = qd_step(q, e, shift)
            while step is None:
                shift = shift / 2 if shift > EPS * EPS else 0.0
                step = qd_step(q, e, shift)
            (q, e), moved = step, moved + shift
        else:
            raise RuntimeError("the qd algorithm does not settle")
    return np.sort(np.array(found))[::-1] * biggest * biggest


# --- eigenvectors


class Twisted:
    """The factorisation of BᵀB - λ, twisted where its pivot is smallest."""

    def __init__(self, q: np.ndarray, l: np.ndarray, shift: float):
        n = len(q)
        self.down, self.up = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
        self.top, self.bottom = np.zeros(n), np.zeros(n)
        small = max(abs(shift), TINY / EPS) * EPS * EPS
        s = np.zeros(n)
        s[0] = -shift
        for k in range(n):
            self.top[k] = nonzero(q[k] + s[k], small)
            if k < n - 1:
                self.down[k] = q[k] * l[k] / self.top[k]
                s[k + 1] = self.down[k] * l[k] * s[k] - shift
        p = q[n - 1] - shift
        gamma = np.zeros(n)
        gamma[n - 1] = s[n - 1] + p + shift
        self.bottom[n - 1] = nonzero(p, small)
        for k in reversed(range(n - 1)):
            pivot = nonzero(q[k] * l[k] * l[k] + p, small)
            self.up[k] = l[k] * q[k] / pivot
            self.bottom[k + 1] = pivot
            p = p * q[k] / pivot - shift
            gamma[k] = s[k] + p + shift
        self.twist = int(np.argmin(np.abs(gamma)))
        self.gamma = nonzero(gamma[self.twist], small)

    def vector(self) -> np.ndarray:
        """The unit vector that the factorisation brings to a multiple of the axis of the twist."""
        z = np.zeros(len(self.top))
        z[self.twist] = 1
        for k in reversed(range(self.twist)):
            z[k] = -self.down[k] * z[k + 1]
        for k in range(self.twist, len(z) - 1):
            z[k + 1] = -self.up[k] * z[k]
        return z / np.linalg.norm(z)

    def solve(self, y: np.ndarray) -> np.ndarray:
        """The solution of (BᵀB - λ) x = y."""
        x, r, n = y.copy(), self.twist, len(y)
        for k in range(r):
            x[k + 1] -= self.down[k] * x[k]
        for k in reversed(range(r, n - 1)):
            x[k] -= self.up[k] * x[k + 1]
        x[:r] /= self.top[:r]
        x[r] /= self.gamma
        x[r + 1 :] /= self.bottom[r + 1 :]
        for k in reversed(range(r)):
            x[k] -= self.down[k] * x[k + 1]
        for k in range(r, n - 1):
            x[k + 1] -= self.up[k] * x[k]
        return x


def nonzero(x: float, least: float) -> float:
    return x if abs(x) > least else -least


def eigenvectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors of BᵀB (columns) for its largest eigenvalues, given falling and above zero."""
    n = len(diagonal)
    biggest = max(np.abs(diagonal).max(), np.abs(above).max(initial=0.0))
    # a zero on the diagonal would break the quotients; moved by less than rounding
    a = np.where(np.abs(diagonal) <= EPS * EPS * biggest, EPS * EPS * biggest, diagonal)
    q, l = a * a, above / a[:-1]
    vectors, rng, begin = np.zeros((n, len(values))), np.random.default_rng(5), 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLOSE * values[i - 1]:
            begin = i
        twisted = Twisted(q, l, float(value))
        z, others = twisted.vector(), vectors[:, begin:i]
        if others.shape[1]:
            rest = z - others @ (others.T @ z)
            if np.linalg.norm(rest) < 0.5:
                rest = rng.normal(size=n)
            for _ in range(4):
                rest -= others @ (others.T @ rest)
                rest -= others @ (others.T @ rest)
                z = rest / np.linalg.norm(rest)
                rest = twisted.solve(z)
            rest -= others @ (others.T @ rest)
            z = rest / np.linalg.norm(rest)
            z -= others @ (others.T @ z)
            z /= np.linalg.norm(z)
        vectors[:, i] = z
    return vectors


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of ``matrixᵀ matrix`` (at most ``most``, none that is zero to rounding) and their vectors."""
    n = len(matrix)
    diagonal, above, v = bidiagonalise(matrix)
    values = eigenvalues(diagonal, above)
    real = values > (EPS * n) ** 2 * 16 * values.max(initial=0.0)
    values = values[real][:most]
    return values, v @ eigenvectors(diagonal, above, values) if len(values) else np.zeros((n, 0))
