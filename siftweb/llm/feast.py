"""The largest eigenpairs of a symmetric matrix by contour integration (FEAST).

For an eigenvalue interval the projector onto its eigenvectors is the contour
integral of the resolvent around it; ``NODES`` quadrature points of a circle
give a filter, applied to a block by complex shifted solves ``(zI - A) Y = Q``.
Rayleigh-Ritz on the filtered block extracts the pairs, and the filter is
applied again to the Ritz vectors until their residuals are at rounding level;
where they fall slowly, for eigenvalues lie close outside, the block grows.

Inertia counts say how many eigenvalues lie above a shift: the number of
positive pivots of a symmetric elimination of ``A - shift I`` (Sylvester).  They
choose the intervals by bisection, set the size of the blocks, and verify that
no interval misses a pair.

The matrix is dim x dim, whatever the number of rows it was made from.
"""

from __future__ import annotations

import numpy as np

NODES, MOST, ROUNDS = 12, 8, 60
#: Widths relative to the matrix, and to an interval: clusters that stay together, room around shifts.
NARROW, CLOSE = 1e-4, 1e-4
#: Residual, relative to the matrix, at which a pair is done.
EXACT = 1e-14


def pivots(a: np.ndarray) -> np.ndarray | None:
    """Pivots of the elimination of a symmetric matrix, rows swapped on the
    diagonal (largest first); None where no safe pivot is left."""
    a = a.copy()
    out, scale = [], max(float(np.abs(a).max(initial=0)), 1e-300)
    for k in range(len(a)):
        j = k + int(np.argmax(np.abs(np.diagonal(a)[k:])))
        if j != k:
            a[[k, j]] = a[[j, k]]
            a[:, [k, j]] = a[:, [j, k]]
        d = a[k, k]
        rest = a[k + 1:, k]
        if abs(d) <= 1e-13 * scale or np.abs(rest).max(initial=0) > 1e6 * abs(d):
            return None
        out.append(d)
        a[k + 1:, k + 1:] -= np.outer(rest, rest / d)
    return np.array(out)


def above(a: np.ndarray, shift: float) -> int | None:
    """How many eigenvalues of ``a`` lie above ``shift``; None if one lies on it."""
    d = pivots(a - shift * np.eye(len(a)))
    return None if d is None else int((d > 0).sum())


def _filter(a: np.ndarray, q: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block ``q`` projected onto the eigenvectors of (low, high)."""
    middle, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(q)
    for k in range(NODES):  # upper half circle; the lower half is its conjugate
        turn = np.exp(1j * np.pi * (k + 0.5) / NODES)
        solved = np.linalg.solve((middle + radius * turn) * np.eye(len(a)) - a, q.astype(complex))
        out += (radius * turn * solved).real / NODES
    return out


def pairs_in(a: np.ndarray, low: float, high: float, count: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of (low, high), by falling eigenvalue."""
    d, rng, before = len(a), np.random.default_rng(7), np.inf
    q = rng.normal(size=(d, min(d, count + max(4, count // 2))))
    for _ in range(ROUNDS):
        q, _ = np.linalg.qr(_filter(a, q, low, high))
        ritz, turn = np.linalg.eigh(q.T @ a @ q)
        q = q @ turn
        inside = np.flatnonzero((ritz > low) & (ritz < high))
        gone = np.linalg.norm(a @ q[:, inside] - q[:, inside] * ritz[inside], axis=0).max(initial=0)
        if len(inside) == count and gone <= EXACT * np.sqrt(d) * scale:
            return ritz[inside[::-1]], q[:, inside[::-1]]
        if gone > 0.05 * before and q.shape[1] < d:  # neighbours outside fade slowly: take them into the block
            q = np.hstack([q, rng.normal(size=(d, min(d, 2 * q.shape[1]) - q.shape[1]))])
            gone = np.inf
        before = gone
    raise ArithmeticError(f"{count} eigenvalues counted in ({low}, {high}), {len(inside)} extracted")


def _part(a: np.ndarray, low: float, high: float) -> tuple[float, int]:
    """A shift near the middle of the interval with no eigenvalue close by, and
    the number of eigenvalues above it."""
    close = CLOSE * (high - low)
    for k in range(1, 200):
        shift = low + (high - low) * (0.5 + (-1) ** k * (k // 2) / 400)
        upper, lower = above(a, shift + close), above(a, shift - close)
        if upper is not None and upper == lower:
            return shift, upper
    raise ArithmeticError(f"no shift without an eigenvalue close by in ({low}, {high})")


def intervals(a: np.ndarray, k: int, scale: float) -> list[tuple[float, float, int]]:
    """(low, high, count) of disjoint intervals, falling, that hold at least the
    ``k`` largest eigenvalues; each holds at most ``MOST`` or is ``NARROW``."""
    off = np.abs(a).sum(1) - np.abs(np.diagonal(a))  # Gershgorin
    top = float((np.diagonal(a) + off).max()) + 0.01 * scale
    bottom = float((np.diagonal(a) - off).min()) - 0.01 * scale
    found, done = [], 0
    todo = [(bottom, top, len(a))]
    while todo and done < k:
        low, high, n = todo.pop()
        if not n:
            continue
        if n <= min(MOST, 2 * (k - done)) or high - low <= NARROW * scale:
            found.append((low, high, n))
            done += n
            continue
        shift, upper = _part(a, low, high)
        upper -= done  # of the intervals above, all are taken
        todo += [(low, shift, n - upper), (shift, high, upper)]
    return found


def largest(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as columns) of the ``k`` largest eigenvalues of a
    symmetric matrix, falling; vectors are of unit length."""
    a = (a + a.T) / 2
    d, scale = len(a), float(np.abs(a).sum(1).max(initial=0))
    k = min(k, d)
    if not scale or not k:
        return np.zeros(k), np.eye(d)[:, :k]
    vectors = []
    for low, high, n in intervals(a, k, scale):
        vectors.append(pairs_in(a, low, high, n, scale)[1])
    q, _ = np.linalg.qr(np.concatenate(vectors, axis=1))  # vectors of different intervals
    e, turn = np.linalg.eigh(q.T @ a @ q)
    return e[::-1][:k], (q @ turn)[:, ::-1][:, :k]
