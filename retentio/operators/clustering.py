"""K-means over many (k, restart) models at once (M7).

All models are fitted together: one scan an iteration assigns every row to its nearest
centroid in each model that still moves and sums rows by centroid, so the number of
scans is that of the slowest model's iterations, whatever the number of models.
Sums are of integers (values scaled by ``UNITS``), hence equal whatever the order of
tasks.  What reaches the driver is one row per centroid and feature.

The first centroids are those of k-means++, drawn from all rows: a row's chance is its
squared distance to the nearest centroid so far, and the draw is the row of greatest
ln(u) / distance with u hashed from (key, model, step), a maximum that tasks find in
one scan a step for all models.  So the fit is a function of the rows, and a SQL
engine can compute the same.  The silhouette (squared Euclidean) follows from
cluster moments in two scans for all candidates together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .anomaly import mix32

#: Integer parts of one unit of a scaled feature.
UNITS = 1 << 30
#: Rows whose distances are held at once.
CHUNK = 1024
#: Squared distance up to which a row counts as equal to a centroid.
FLAT = 1e-9


@dataclass
class Fit:
    """One model: centroids as rows, rows of each, the sum of squared distances and the iterations it took."""

    k: int
    restart: int
    centroids: np.ndarray
    sizes: np.ndarray
    cost: float = float("inf")
    iterations: int = 0
    moving: bool = True


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        x = _matrix(batch.column(0))
        for k in range(0, len(x), CHUNK):
            yield x[k:k + CHUNK]


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids."""
    return _apart(x, c).T


def _apart(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances, a line of rows per centroid, computed in place."""
    out = c @ x.T
    out *= -2.0
    out += (x * x).sum(1)[None, :]
    out += (c * c).sum(1)[:, None]
    return np.maximum(out, 0.0, out=out)


def _owners(apart: np.ndarray, start: np.ndarray) -> np.ndarray:
    """1.0 where a centroid (line) is its model's nearest to a row (column), the first on a tie."""
    own = np.empty(apart.shape)
    for a, b in zip(start[:-1], start[1:]):
        least, free = apart[a:b].min(0), np.ones(apart.shape[1], bool)
        for j in range(a, b):
            nearest = (apart[j] == least) & free
            own[j] = nearest
            free &= ~nearest
    return own


#: Bits of the low part of an integer: sums of the parts of CHUNK rows are exact as doubles.
LOW = 26


def _sums(own: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Exact sums of integer rows by owner, and the rows' number as last column.

    Both parts of each integer are summed by a matrix product of doubles, below 2**53 each.
    """
    d = whole.shape[1]
    parts = np.column_stack([whole >> LOW, whole & ((1 << LOW) - 1), np.ones(len(whole), np.int64)]).astype(float)
    got = (own @ parts).astype(np.int64)
    return np.column_stack([(got[:, :d] << LOW) + got[:, d:2 * d], got[:, 2 * d]])


def _mix32(x: np.ndarray) -> np.ndarray:
    """:func:`.anomaly.mix32` of an array."""
    x = x.astype(np.uint64) & np.uint64(0xFFFFFFFF)
    x ^= x >> np.uint64(16)
    x = x * np.uint64(2246822507) & np.uint64(0xFFFFFFFF)
    x ^= x >> np.uint64(13)
    x = x * np.uint64(3266489909) & np.uint64(0xFFFFFFFF)
    return x ^ x >> np.uint64(16)


def numbered(df: DataFrame, key: str) -> Column:
    """The number that a row is hashed by: an integer key itself, else its 64-bit hash; modulo 2^32."""
    k = F.col(key)
    whole = isinstance(df.schema[key].dataType, T.IntegralType)
    return F.pmod(F.coalesce(k.cast("long"), F.lit(0).cast("long")) if whole else F.xxhash64(k), F.lit(1 << 32))


def seeds(points: DataFrame, number: str, vector: str, ks, restarts: int, seed: int) -> list[Fit]:
    """K-means++ starts of every model, one scan for each further centroid of all models.

    A model whose rows are fewer than its centroids (or not apart) stays short and is left out.
    """
    fits = [Fit(k, r, np.empty((0, 0)), np.zeros(k, np.int64)) for k in ks for r in range(max(1, restarts))]
    start = {(f.k, f.restart): f for f in fits}
    for step in range(max(ks, default=0)):
        open_ = [f for f in fits if f.k > step and len(f.centroids) == step]
        held = [(f.k, f.restart, f.centroids) for f in open_]
        shared = points.sparkSession.sparkContext.broadcast(held)

        def one(batches: Iterator[pa.RecordBatch], step: int = step, shared=shared) -> Iterator[pa.RecordBatch]:
            best: dict[tuple[int, int], tuple[float, int, list[float]]] = {}
            for batch in batches:
                n, every = batch.column(0).to_numpy(), _matrix(batch.column(1))
                for at in range(0, len(n), CHUNK):
                    x, number = every[at:at + CHUNK], n[at:at + CHUNK].astype(np.uint64)
                    for k, r, c in shared.value:
                        apart = _distances(x, c).min(1) if len(c) else np.ones(len(x))
                        use = np.flatnonzero(apart > FLAT)
                        if not len(use):
                            continue
                        salt = mix32(mix32(mix32(seed * 7919 + step) + k) + r)
                        u = (_mix32(number[use] + np.uint64(salt)).astype(float) + 0.5) / (1 << 32)
                        score = np.log(u) / apart[use]
                        top = int(score.argmax())
                        found = (float(score[top]), -int(number[use][top]), x[use[top]].tolist())
                        best[k, r] = max(best.get((k, r), found), found)
            names = ["k", "r", "score", "number", "x"]
            cols = list(zip(*[(k, r, *v) for (k, r), v in best.items()])) or [()] * 5
            kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

        rows = (points.select(number, vector).mapInArrow(one, "k int, r int, score double, number long, x array<double>")
                .groupBy("k", "r").agg(F.max(F.struct("score", "number", "x")).alias("v")).collect())
        for row in rows:
            f = start[row.k, row.r]
            new = np.array([row.v.x])
            f.centroids = np.concatenate([f.centroids, new]) if len(f.centroids) else new
        shared.unpersist()
    return [f for f in fits if len(f.centroids) == f.k]


def _moments(points: DataFrame, vector: str, fits: list[Fit]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One scan: rows, sums and sums of squared lengths by the centroids of all fits, in their order."""
    start = np.concatenate(([0], np.cumsum([f.k for f in fits])))
    every = np.concatenate([f.centroids for f in fits])
    shared = points.sparkSession.sparkContext.broadcast(every)
    d = every.shape[1]

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        n, total = np.zeros(len(c), np.int64), np.zeros((len(c), d + 1), np.int64)
        for x in _chunks(batches):
            whole = np.rint(np.column_stack([x, (x * x).sum(1)]) * UNITS).astype(np.int64)
            got = _sums(_owners(_apart(x, c), start), whole)
            total += got[:, :-1]
            n += got[:, -1]
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)),
                                          pa.array(total.ravel()), pa.array(np.repeat(n, d + 1))], names=["i", "j", "v", "n"])

    rows = (points.select(vector).mapInArrow(one, "i int, j int, v long, n long").groupBy("i", "j")
            .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"), F.sum("n").alias("n")).collect())
    sums, sizes = np.zeros((len(every), d + 1)), np.zeros(len(every), np.int64)
    for r in rows:
        sums[r.i, r.j], sizes[r.i] = float(int(r.v) / UNITS), r.n
    shared.unpersist()
    return sizes, sums[:, :d], sums[:, d]


def fit_many(points: DataFrame, number: str, vector: str, ks, restarts: int = 10, seed: int = 42, max_iter: int = 300,
             tol: float = 1e-4) -> list[Fit]:
    """Lloyd's iterations of all models, one scan each; a centroid without rows stays where it is."""
    fits = seeds(points, number, vector, ks, restarts, seed)
    for _ in range(max_iter):
        moving = [f for f in fits if f.moving]
        if not moving:
            break
        sizes, sums, squares = _moments(points, vector, moving)
        at = 0
        for f in moving:
            n, s, q = sizes[at:at + f.k], sums[at:at + f.k], squares[at:at + f.k]
            at += f.k
            new = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], f.centroids)
            # Squared distances to the centroids that were used, from the moments.
            f.cost = float((q - 2.0 * (f.centroids * s).sum(1) + n * (f.centroids ** 2).sum(1)).sum())
            f.moving = bool(((new - f.centroids) ** 2).sum(1).max(initial=0.0) > tol * tol)
            f.centroids, f.sizes, f.iterations = new, n, f.iterations + 1
    return fits


def silhouettes(points: DataFrame, vector: str, fits: list[Fit]) -> list[float]:
    """Mean silhouette (squared Euclidean) of every fit, in two scans; rows alone in a cluster count 0."""
    sizes, sums, squares = _moments(points, vector, fits)
    start = np.concatenate(([0], np.cumsum([f.k for f in fits])))
    every = np.concatenate([f.centroids for f in fits])
    shared = points.sparkSession.sparkContext.broadcast((every, sizes, sums, squares))

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, n, s, q = shared.value
        total, rows = np.zeros(len(start) - 1, np.int64), 0
        safe = np.maximum(n, 1)
        for x in _chunks(batches):
            apart = _distances(x, c)
            # Mean squared distance of a row to all rows of a cluster.
            mean = (x * x).sum(1)[:, None] + (q / safe)[None, :] - 2.0 * (x @ s.T) / safe[None, :]
            rows += len(x)
            for m, (a, b) in enumerate(zip(start[:-1], start[1:])):
                own = apart[:, a:b].argmin(1)
                at = np.arange(len(x))
                inside = mean[at, a + own] * n[a + own] / np.maximum(n[a + own] - 1, 1)
                others = np.where(n[a:b][None, :] > 0, mean[:, a:b], np.inf)
                others[at, own] = np.inf
                near = others.min(1)
                most = np.maximum(inside, near)
                score = np.where((n[a + own] > 1) & np.isfinite(near) & (most > 0), (near - inside) / np.where(most > 0, most, 1.0), 0.0)
                total[m] += np.rint(score * UNITS).astype(np.int64).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total),
                                          pa.array(np.full(len(total), rows, np.int64))], names=["m", "v", "n"])

    got = {r.m: int(r.v) / UNITS / r.n if r.n else 0.0 for r in points.select(vector).mapInArrow(one, "m int, v long, n long").groupBy("m").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v"), F.sum("n").alias("n")).collect()}
    shared.unpersist()
    return [got.get(m, 0.0) for m in range(len(fits))]


def assign(points: DataFrame, vector: str, centroids: np.ndarray, out: str = "cluster") -> DataFrame:
    """``points`` with the index of the nearest centroid (the least on a tie); a JVM expression."""
    apart = [F.aggregate(F.zip_with(F.col(vector), F.array(*[F.lit(float(v)) for v in c]), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
             for c in centroids]
    nearest = F.array_min(F.array(*[F.struct(a.alias("d"), F.lit(k).alias("k")) for k, a in enumerate(apart)]))
    return points.withColumn(out, nearest["k"])
