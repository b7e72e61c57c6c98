"""Largest eigenpairs of a symmetric matrix by contour integration (FEAST), in Spark tasks.

The spectrum is cut into slices by inertia counts: the signs of the pivots of
A - s I tell how many eigenvalues lie above s (Sylvester).  For each slice
the spectral projector is the contour integral of the resolvent around it;
Gauss-Legendre quadrature on the half circle turns it into a few complex shifted
solves, each a task of its own.  Applied to a random block, the quadrature
filters out what lies outside the slice; Rayleigh-Ritz on the filtered block
gives the eigenpairs, and the block is filtered again until the residuals are at
rounding level.  At the end the pairs found in a slice must be as many as the
inertia counts say, else the slice is done again with a larger block.

The matrix is dense and broadcast: its order is limited to ``MAX_ORDER``
(134 MB), whatever the number of rows it was summed from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

MAX_ORDER = 4096
#: Eigenvalues of a slice at most (but for equal ones), and quadrature nodes.
SLICE, NODES = 8, 8
#: Filter steps of one attempt, and attempts with blocks of twice the size.
STEPS, ATTEMPTS = 12, 4
#: Halvings that move the lowest cut into a gap of the spectrum.
GAP = 10
#: A pivot must have so much of its row's size; others would spoil the count.
GROWTH = 1e-4


class _TinyPivot(ArithmeticError):
    pass


def count_above(a: np.ndarray, shift: float) -> tuple[int, float]:
    """Eigenvalues greater than a shift (positive pivots of A - shift I = L D L'), and
    that shift: the given one, or one beside it where that one lies on an eigenvalue."""
    scale = max(float(np.abs(a).max(initial=0.0)), abs(shift))
    for k in range(40):
        try:
            return _positive_pivots(a, shift, scale), shift
        except _TinyPivot:
            shift += (-1) ** k * 2.0 ** k * 1e-13 * scale
    raise ArithmeticError("no inertia count near this shift")


def _positive_pivots(a: np.ndarray, shift: float, scale: float) -> int:
    m = a - shift * np.eye(len(a))
    positive = 0
    for k in range(len(m)):
        pivot, row = m[k, k], m[k, k + 1:]
        if abs(pivot) <= max(1e-14 * scale, GROWTH * float(np.abs(row).max(initial=0.0))):
            raise _TinyPivot
        positive += int(pivot > 0)
        m[k + 1:, k + 1:] -= np.outer(row / pivot, row)
    return positive


def slices(a: np.ndarray, k: int, floor: float) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) from the top down, holding the ``k`` greatest over ``floor``."""
    top = float(np.abs(a).sum(1).max(initial=0.0))
    eps = 1e-12 * top
    total, low = count_above(a, floor)
    high, want = top * (1 + 1e-6), min(k, total)
    if not want:
        return []
    # A higher low bound that still has them all and few others.
    under, over, inside = low, high, total
    while inside > want + SLICE // 2 and over - under > eps:
        n, mid = count_above(a, (under + over) / 2)
        if n >= want:
            under, inside = mid, n
        else:
            over = mid
    # Move it up into the gap above what is left out: the filter falls off faster there.
    over = high
    for _ in range(GAP):
        n, mid = count_above(a, (under + over) / 2)
        if n == inside:
            under = mid
        elif mid > under:
            over = mid
    out, todo = [], [(under, high, inside, 0)]
    while todo:
        lo, hi, above_lo, above_hi = todo.pop()
        n = above_lo - above_hi
        middle, mid = count_above(a, (lo + hi) / 2) if n > SLICE and hi - lo > eps else (0, lo)
        if lo < mid < hi:
            todo += [(mid, hi, middle, above_hi), (lo, mid, above_lo, middle)]
        elif n:
            out.append((lo, hi, n))
    return sorted(out, reverse=True)


def _filtered(spark: SparkSession, a: np.ndarray, blocks: dict[int, tuple[float, float, np.ndarray]]) -> dict[int, np.ndarray]:
    """The blocks of each slice (low, high, block) after the quadrature, one shifted solve a task."""
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    which = sorted(blocks)
    shared = spark.sparkContext.broadcast((a, blocks))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.column(0).to_pylist():
                matrix, held = shared.value
                at, node = which[task // NODES], task % NODES
                low, high, block = held[at]
                turn = (high - low) / 2 * np.exp(0.5j * np.pi * (1 - nodes[node]))
                z = (low + high) / 2 + turn
                part = (turn * np.linalg.solve(z * np.eye(len(matrix)) - matrix, block.astype(complex))).real * (weights[node] / 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at], pa.int32()), pa.array([node], pa.int32()), pa.array([part.ravel()], pa.list_(pa.float64()))],
                    names=["slice", "node", "part"])

    n = len(which) * NODES
    parts = spark.range(0, n, 1, n).mapInArrow(solve, "slice int, node int, part array<double>").toArrow()
    out = {at: np.zeros_like(blocks[at][2]) for at in which}
    order = sorted(range(n), key=lambda r: (parts["slice"][r].as_py(), parts["node"][r].as_py()))
    for r in order:  # in one order, so reruns agree
        at = parts["slice"][r].as_py()
        out[at] += np.asarray(parts["part"][r].values).reshape(out[at].shape)
    shared.unpersist()
    return out


def _ritz(a: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, vectors and residual norms of a block."""
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    q = u[:, s > 1e-13 * s[0]] if len(s) and s[0] > 0 else u[:, :0]
    value, w = np.linalg.eigh(q.T @ a @ q)
    vector = q @ w
    return value, vector, np.linalg.norm(a @ vector - vector * value, axis=0)


def largest(spark: SparkSession, a: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest eigenvalues over ``floor`` (falling) and their unit vectors, as columns."""
    d = len(a)
    if d > MAX_ORDER:
        raise ValueError(f"the matrix has {d} rows, more than {MAX_ORDER}")
    cuts = slices(a, k, floor) if d else []
    norm = float(np.abs(a).sum(1).max(initial=0.0))
    done: dict[int, np.ndarray] = {}
    for attempt in range(ATTEMPTS):
        random = np.random.Generator(np.random.PCG64(attempt))
        size = lambda n: min(d, (2 * n + 4) << attempt)
        blocks = {i: random.standard_normal((d, size(n))) for i, (_, _, n) in enumerate(cuts) if i not in done}
        worst: dict[int, float] = {}
        for _ in range(STEPS):
            if not blocks:
                break
            new = _filtered(spark, a, {i: (*cuts[i][:2], b) for i, b in blocks.items()})
            for i, b in new.items():
                low, high, n = cuts[i]
                value, vector, left = _ritz(a, b)
                inside = (value > low) & (value <= high)
                error = float(left[inside].max(initial=0.0))
                if inside.sum() == n and (error <= 4e-15 * norm or (error <= 1e-12 * norm and error >= worst.get(i, np.inf) / 2)):
                    done[i] = vector[:, inside]
                    del blocks[i]
                    continue
                worst[i] = error if inside.sum() == n else np.inf
                blocks[i] = vector
    if len(done) < len(cuts):
        raise ArithmeticError("some slices lack eigenpairs that the inertia counts promise")
    if not cuts:
        return np.empty(0), np.empty((d, 0))
    # One more Rayleigh-Ritz step over all slices makes the vectors orthogonal to each other.
    q, _ = np.linalg.qr(np.hstack([done[i] for i in sorted(done)]))
    value, w = np.linalg.eigh(q.T @ a @ q)
    order = np.argsort(-value, kind="stable")[:k]
    return value[order], q @ w[:, order]
