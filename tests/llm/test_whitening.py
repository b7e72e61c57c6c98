import numpy as np
import pytest

from retentio.llm import feast, whitening


def symmetric(kind, d, seed=0):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    if kind == "sample":
        x = rng.standard_normal((50 * d, d))
        a = x.T @ x / len(x)
    elif kind == "ties":
        a = q @ np.diag([100.0] * 12 + [50.0] * 12 + [10.0] * (d - 24)) @ q.T
    elif kind == "decay":
        a = q @ np.diag(1e6 * 0.7 ** np.arange(d)) @ q.T
    elif kind == "close":
        a = q @ np.diag(100 + 1e-7 * np.arange(d)) @ q.T
    else:
        x = rng.standard_normal((3, d))
        a = x.T @ x
    return (a + a.T) / 2


@pytest.mark.parametrize("kind,d", [("sample", 64), ("sample", 1), ("sample", 5), ("ties", 64), ("decay", 60), ("close", 50), ("rank 3", 40)])
def test_eigenpairs(spark, kind, d):
    a = symmetric(kind, d)
    floor = 1e-10 * np.abs(a).sum(1).max()
    value, vector = feast.largest(spark, a, 32, floor)
    want = np.linalg.eigvalsh(a)[::-1]
    want = want[want > floor][:32]
    assert len(value) == len(want) and np.allclose(value, want, rtol=0, atol=1e-13 * want[0])
    assert np.abs(a @ vector - vector * value).max() <= 1e-13 * want[0]
    assert np.abs(vector.T @ vector - np.eye(len(value))).max() < 1e-12


def test_inertia_and_slices():
    a = symmetric("ties", 40)
    assert [feast.count_above(a, s)[0] for s in (200, 75, 30, 5)] == [0, 12, 24, 40]
    n, used = feast.count_above(a, 50.0)  # lies on an eigenvalue: a shift beside it is used
    assert n == (12 if used > 50 else 24)
    cuts = feast.slices(a, 20, 1e-8)
    assert sum(n for *_, n in cuts) >= 20 and all(hi > lo for lo, hi, _ in cuts)


def reference(vectors):
    """n, deviations, whitened and explained by numpy alone."""
    x = np.array([[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(0)
    deviation = [int(sum((n * c - t) ** 2 for c, t in zip(row, s))) for row in x]
    y = np.array(n * x - s, float) / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:32], u[:, ::-1][:, :32]
    return n, deviation, y @ u / np.sqrt(e), e / np.trace(v)


def test_components_match_numpy(spark):
    rng = np.random.default_rng(3)
    good = rng.standard_normal((400, 48)).astype(np.float32) * np.linspace(1, 3, 48).astype(np.float32)
    rows = [(k, [float(c) for c in v], 1, "x") for k, v in enumerate(good)]
    bad = [(1000, None), (1001, [float("nan")] * 48), (1002, [None] + [0.0] * 47), (1003, [float("inf")] + [0.0] * 47),
           (1004, [1.0] * 47), (1005, []), (1006, [1e30] * 48)]
    docs = spark.createDataFrame(rows + [(i, v, 1, "x") for i, v in bad], "vec_id long, embedding array<float>, n int, _vector string").repartition(5)
    got = whitening.components(docs, whitening.fit(docs)).collect()
    n, deviation, white, explained = reference(good)
    assert {r.vec_id for r in got} == set(range(400)) and len(got) == 400 * 32
    out = np.zeros((400, 32))
    for r in got:
        out[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and int(r.deviation) == deviation[r.vec_id] and r.identity_error < 1e-9
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-10
    signs = np.sign((out * white).sum(0))
    assert np.abs(out * signs - white).max() < 1e-8


def test_few_and_equal_rows(spark):
    """An empty table and one without vectors give no rows; a table of copies has
    no variance and so no components; small ranks give as many components."""
    schema = "vec_id long, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [2.0, 3.0])], [(k, [2.0, 3.0]) for k in range(9)]):
        docs = spark.createDataFrame(rows, schema)
        got = whitening.components(docs, whitening.fit(docs))
        assert got.collect() == []
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    docs = spark.createDataFrame([(None, [0.0, 0.0, 5.0]), (1, [1.0, 2.0, 5.0]), (1, [2.0, 4.0, 5.0]), (2, [3.0, 6.0, 5.0])], schema)
    got = whitening.components(docs, whitening.fit(docs)).collect()
    assert len(got) == 4 and all(abs(r.explained - 1) < 1e-12 for r in got)


def test_huge_entries_stay_exact(spark):
    """Deviations beyond a long are exact decimals, and sums beyond one are too."""
    docs = spark.createDataFrame([(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [0.5, 7.0])], "vec_id long, embedding array<double>")
    model = whitening.fit(docs)
    rows = {r.vec_id: int(r.deviation) for r in whitening.whiten(docs, model).collect()}
    x = [[64 * 10 ** 12 + 10 ** 6, 10 ** 6], [-64 * 10 ** 12 + 10 ** 6, 10 ** 6 + 64], [10 ** 6 + 32, 10 ** 6 + 448]]
    s = [sum(r[j] for r in x) for j in (0, 1)]
    assert rows == {k + 1: sum((3 * r[j] - s[j]) ** 2 for j in (0, 1)) for k, r in enumerate(x)}
