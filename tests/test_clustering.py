"""K-means of many models at once, against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from retentio.operators import clustering as CL
from retentio.operators import models as MD


def blobs(spark, centres, per, seed=0, spread=0.3):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, spread, (per, len(c))) for c in centres])
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    return x, spark.createDataFrame(rows, "n long, x array<double>").repartition(5)


def lloyd(x, c, tol=1e-4, most=300):
    for k in range(most):
        label = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[label == j].mean(0) if (label == j).any() else c[j] for j in range(len(c))])
        moved = ((new - c) ** 2).sum(1).max() > tol * tol
        c = new
        if not moved:
            break
    return c, k + 1


def test_all_models_follow_lloyd(spark):
    x, df = blobs(spark, [(0, 0), (4, 0), (0, 5), (6, 6)], 60, spread=1.2)
    starts = {(f.k, f.restart): f.centroids.copy() for f in CL.seeds(df, "n", "x", range(2, 6), 3, 7)}
    for f in CL.fit_many(df, "n", "x", range(2, 6), 3, 7):
        want, rounds = lloyd(x, starts[f.k, f.restart])
        assert np.allclose(f.centroids, want, atol=1e-6) and f.iterations == rounds and f.sizes.sum() == len(x)
        label = ((x[:, None] - f.centroids[None]) ** 2).sum(2).argmin(1)
        assert abs(((x - f.centroids[label]) ** 2).sum() - f.cost) < 1e-3 * f.cost


def test_scans_do_not_grow_with_the_models(spark, monkeypatch):
    x, df = blobs(spark, [(0, 0), (5, 5), (9, 0)], 40)
    scans = []
    real = CL._moments
    monkeypatch.setattr(CL, "_moments", lambda *a: scans.append(len(a[2])) or real(*a))
    fits = CL.fit_many(df, "n", "x", range(2, 6), 6, 1)
    assert len(fits) == 24 and scans[0] == 24 and len(scans) == max(f.iterations for f in fits)


def test_starts_are_far_apart_draws(spark):
    """Of well separated groups every start takes one each, almost always; the same seed gives the same starts."""
    _, df = blobs(spark, [(0, 0), (50, 0), (0, 50), (50, 50)], 30)
    a, b = (CL.seeds(df, "n", "x", [4], 20, 3) for _ in range(2))
    assert all(np.array_equal(p.centroids, q.centroids) for p, q in zip(a, b))
    assert sum(len({tuple(np.round(c / 50)) for c in f.centroids}) == 4 for f in a) >= 18


def silhouette(x, label):
    out = []
    for i in range(len(x)):
        d = ((x - x[i]) ** 2).sum(1)
        own = label == label[i]
        if own.sum() < 2:
            out.append(0.0)
            continue
        a = d[own].sum() / (own.sum() - 1)
        b = min(d[label == j].mean() for j in set(label) - {label[i]})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_silhouettes(spark):
    x, df = blobs(spark, [(0, 0), (4, 0), (0, 5)], 40, spread=1.0)
    fits = CL.fit_many(df, "n", "x", [2, 3, 4], 2, 5)
    for f, got in zip(fits, CL.silhouettes(df, "x", fits)):
        label = ((x[:, None] - f.centroids[None]) ** 2).sum(2).argmin(1)
        assert abs(got - silhouette(x, label)) < 1e-5


@pytest.mark.parametrize("rows", [0, 1, 2, 30])
def test_few_and_equal_rows(spark, rows):
    """No model has more centroids than different rows; without any model there are no rows."""
    df = spark.range(rows).select(F.col("id").alias("key"), (F.col("id") % 2).cast("double").alias("a"), F.lit(None).cast("double").alias("b"),
                                  F.col("id").cast("double").alias("lifetime_value"))
    got = MD.kmeans_segments(df, "key", ["a", "b"], ks=range(2, 4), restarts=2).collect()
    assert len(got) == (rows if rows >= 2 else 0)
    assert not got or {r.k for r in got} == {2} and len({r.cluster for r in got}) == 2


def test_sums_by_owner_are_exact_and_ties_go_to_the_first():
    """The matrix products give the integers' sums, whatever their size, and one owner a row and model."""
    import numpy as np
    rng = np.random.default_rng(1)
    x = rng.normal(size=(CL.CHUNK, 3)) * 100
    c = np.concatenate([x[:2], x[:1], rng.normal(size=(4, 3)) * 100])  # centroids 0 and 2 are equal
    start = np.array([0, 3, 7])
    own = CL._owners(CL._apart(x, c), start)
    whole = np.rint(np.column_stack([x, (x * x).sum(1)]) * CL.UNITS).astype(np.int64)
    got = CL._sums(own, whole)
    want = [[0] * 5 for _ in c]
    for row, d in zip(whole.tolist(), CL._distances(x, c)):
        for a, b in zip(start[:-1], start[1:]):
            k = a + int(d[a:b].argmin())
            want[k] = [s + v for s, v in zip(want[k], [*row, 1])]
    assert got.tolist() == want and want[2][-1] == 0
