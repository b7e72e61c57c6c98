import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
from retentio.llm import quality as Q
from retentio.llm.text import utf8

from ..conftest import SF01


def stats(text):
    return dict(zip(Q.NAMES, Q.statistics(*utf8(pa.array([text], pa.string())))[0]))


def test_statistics():
    s = stats("The cat. The CAT!\nThe cat. The CAT!\nx | y")
    assert np.isclose(s["log_words"], np.log1p(11)) and np.isclose(s["distinct_words"], 6 / 11)
    assert s["top_word"] == 4 / 11
    assert np.isclose(s["repeated_lines"], 1 / 3) and s["upper"] > 0 and s["pipes"] > 0
    assert all(v == 0 for v in stats(None).values()) and all(v == 0 for v in stats("").values())
    assert all(np.isfinite(v) for v in stats("\n \n").values()) and all(np.isfinite(v) for v in stats("日" * 300_000).values())


def test_texts_of_a_batch_do_not_mix():
    texts = ["a b a", None, "X! X!\nX! X!", "", "日本 c", "| | |"]
    one = np.vstack([Q.statistics(*utf8(pa.array([t], pa.string()))) for t in texts])
    assert np.allclose(one, Q.statistics(*utf8(pa.array(texts, pa.string()))))


def training(spark, n=600):
    rng = np.random.default_rng(0)
    rows = []
    for k in range(n):
        good = k % 4 > 0
        words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(rng.integers(5, 80))]
        rows.append((k, " ".join(words) if good else "%% ".join(w.upper() for w in words), int(good)))
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(k, q) for k, _, q in rows], "doc_id long, quality int")


def test_normal_equations_match_a_direct_solution(spark):
    docs, labels = training(spark)
    rows = Q.training_rows(docs, labels)
    model = Q.fit(rows)
    got = rows.toPandas()
    x, y = np.vstack(got.x), got.label.to_numpy(float)
    z = model.features(x)
    want = np.linalg.solve(z.T @ z + Q.RIDGE * np.eye(z.shape[1]), z.T @ y)
    assert np.allclose(z @ want, model.ridge(x), atol=1e-6)
    assert np.all(np.diff(model.knots[0]) >= 0) and np.all(np.diff(model.knots[1]) >= 0)
    assert np.mean((model.score(x) >= 0.5) == y) > 0.98
    # Calibrated: the mean score is the share of good rows.
    assert abs(model.score(x).mean() - y.mean()) < 0.02


def test_features_approximate_a_gaussian_kernel():
    rng = np.random.default_rng(1)
    d = len(Q.NAMES)
    model = Q.Model(np.zeros(d), np.ones(d))
    x = rng.normal(size=(40, d)) * 0.7
    z = model.features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * d))
    assert np.abs(z @ z.T - exact).max() < 0.25


def test_edges(spark):
    """Without labels of both kinds the score is constant; rows repeat; empty tables."""
    docs, labels = training(spark, 20)
    only = Q.fit(Q.training_rows(docs, labels.where("quality = 1")))
    assert Q.scan(docs, only).where("score <> 1.0").count() == 0
    none = Q.fit(Q.training_rows(docs, labels.limit(0)))
    frame = spark.createDataFrame([(1, None, 3.0), (1, None, 3.0), (2, "", 3.0), (3, "x " * 200_000, 3.0)], "doc_id long, text string, score double")
    assert [r.score for r in Q.scan(frame, none).collect()] == [0.5] * 4
    assert Q.scan(frame.limit(0), none).collect() == [] and Q.scan(frame, Q.fit(Q.training_rows(docs, labels))).count() == 4


def test_held_out_accuracy(spark):
    df = E.queries()["op3_quality"](spark, SF01)
    t = df.join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert df.count() == 1000 and df.where("score is null or score < 0 or score > 1").count() == 0
    assert (t.predicted == t.quality).mean() > 0.93


def test_scores_match_brute_force(spark):
    """Statistics by definition, the exact kernel features, and the min-max formula of isotonic regression."""
    from . import brute
    docs, labels = training(spark, 240)
    rows = Q.training_rows(docs, labels)
    model = Q.fit(rows)
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = {r.doc_id: r.quality for r in labels.collect()}
    x = np.array([brute.quality_statistics(texts[k]) for k in sorted(texts)])
    y = np.array([want[k] for k in sorted(texts)], float)
    assert np.allclose(x, np.vstack([Q.statistics(*utf8(pa.array([texts[k]], pa.string()))) for k in sorted(texts)]))
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, np.where(x.std(0) == 0, 1, x.std(0)))
    z = model.features(x)
    r = z @ np.linalg.solve(z.T @ z + Q.RIDGE * np.eye(z.shape[1]), z.T @ y)
    bins = {}
    for a, b in zip(r, y):
        bins.setdefault(np.floor(abs(a) * Q.BINS + 0.5) * np.sign(a), []).append((a, b))
    points = [(np.mean([a for a, _ in v]), np.mean([b for _, b in v]), len(v)) for _, v in sorted(bins.items())]
    level = brute.isotonic(points)
    got = {d.doc_id: d.score for d in Q.scan(docs, model).collect()}
    exact = np.clip(np.interp(r, [p[0] for p in points], level), 0, 1)
    assert np.abs(np.array([got[k] for k in sorted(texts)]) - exact).max() < 0.02


def test_statistics_match_brute_force(spark):
    from . import brute
    texts = [r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").limit(150).collect()] + [None, "", "a", "\n\n", "é! |\n|", "A a\nA a\n"]
    x = Q.statistics(*utf8(pa.array(texts, pa.string())))
    assert np.allclose(x, [brute.quality_statistics(t) for t in texts])
