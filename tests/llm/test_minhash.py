import random

import numpy as np
import pytest

from retentio.llm import minhash

from . import brute
from .test_jaccard import near_copies


def as_rows(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80), (2, 90)])
def test_components_match_brute_force(spark, size, percent):
    docs = list(enumerate(near_copies(size + 20)))
    got = minhash.groups(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), shingle=size, percent=percent)
    want = brute.jaccard_groups(docs, size, percent)
    assert as_rows(got) == want and len({c for _, c in want.values()}) < len(docs)
    assert {r.doc_id for r in got.collect() if r.kept} == {i for i, (_, c) in want.items() if i == c}


def test_links_between_components(spark):
    """A list whose leader's component is left by some members: outsiders are compared too."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(120)]

    def changed(at):
        return " ".join(f"x{rng.randrange(10 ** 9)}" if k in at else w for k, w in enumerate(base))

    docs = [changed(set()) for _ in range(3)] + [changed({k}) for k in range(0, 120, 6)]
    docs += [changed({k, k + 20, k + 40}) for k in range(0, 60, 4)] + [changed(set(range(k, k + 40, 8))) for k in range(0, 70, 5)]
    docs = list(enumerate(docs))
    rng.shuffle(docs)
    got = minhash.groups(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    want = brute.jaccard_groups(docs, 3, 85)
    assert as_rows(got) == want and 2 < len({c for _, c in want.values()})


def test_chain_is_one_component(spark):
    words = [f"w{k}" for k in range(80)]
    docs = [(100 - k, " ".join(words[2 * k:2 * k + 50])) for k in range(15)]
    assert as_rows(minhash.groups(spark.createDataFrame(docs, "doc_id long, text string"))) == brute.jaccard_groups(docs, 3, 85)


def test_edges(spark):
    """Null and empty texts, short and very long ones, repeated and null ids, clashing columns, an empty table."""
    long = " ".join(f"u{k}" for k in range(20_000))
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (4, "a b"), (5, "A  B"), (6, "a b c"), (None, "a b"), (7, "x " * 5000),
            (8, "x " * 6000), (9, "é À a b"), (10, "É À a b"), (11, long), (12, long + " end"), (None, "p " + long), (None, None), (13, "one"),
            (14, "two"), (14, "one")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    clash = frame.withColumn("sid", frame.text).withColumn("list", frame.text).withColumn("key", frame.doc_id)
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.groups(clash).collect()), key=str)
    assert rows == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (4, 1, 4, True), (5, 1, 4, False),
                           (6, 1, 6, True), (None, 1, 4, False), (7, 1, 7, True), (8, 1, 7, False), (9, 2, 9, True), (10, 2, 10, True),
                           (11, 19998, 11, True), (12, 19999, 11, False), (None, 19999, 11, False), (None, 0, None, True),
                           (13, 1, 13, True), (14, 1, 14, True), (14, 1, 13, False)], key=str)
    empty = minhash.groups(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    kept = minhash.dedup(clash).select("doc_id", "text", "sid").collect()
    assert {r.doc_id for r in kept} == {1, 2, 3, 4, 6, 7, 9, 10, 11, 13, 14, None}
    assert [r.text for r in kept if r.doc_id in (None, 14)] == [None, "two"] or [r.text for r in kept if r.doc_id in (None, 14)] == ["two", None]


def test_links_through_a_null_id(spark):
    """A text that only a row without id has still joins its neighbours."""
    words = [f"w{k}" for k in range(100)]
    docs = [(5, " ".join(words[:80])), (None, " ".join(words[4:84])), (2, " ".join(words[8:88])), (3, " ".join(words[50:]))]
    got = minhash.groups(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == {5: 2, None: 2, 2: 2, 3: 3}


def test_keys_meet_as_often_as_they_should():
    """Shares of pairs that share a key, against the formula; bucket counts never bound an overlap too low."""
    rng = np.random.default_rng(1)
    for j in (0.3, 0.6, 0.85, 0.95):
        n, trials = 200, 300
        common = round(2 * n * j / (1 + j))
        met = 0
        for _ in range(trials):
            x = rng.integers(0, 1 << 63, 2 * n - common, dtype=np.uint64) * np.uint64(2)
            sets = [np.sort(x[:n]), np.sort(x[n - common:])]
            k = minhash.half_keys(minhash.minhashes(sets))
            same = k[0] == k[1]
            met += same[:minhash.HALVES].any() and same[minhash.HALVES:].any()
            c = minhash.bucket_counts(sets)
            held = [int(np.bitwise_count(v.view(np.uint64)).sum()) for v in c]
            most = int(np.bitwise_count((c[0] & c[1]).view(np.uint64)).sum()) + min(n - h for h in held)
            assert common <= most <= common + 60
        assert abs(met / trials - minhash.recall(j)) < 0.12 if j < 0.85 else met == trials
    assert minhash.recall(0.85) > 0.9999


def test_bucket_counts_of_many_and_large_sets():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in [1, 5000, *rng.integers(1, 40, 5000)]]
    c = minhash.bucket_counts(sets)
    for k in (0, 1, 2, 2047, 2050, 5001):
        counts = np.bincount((sets[k] >> np.uint64(20)).astype(np.int64) % minhash.BUCKETS, minlength=minhash.BUCKETS)
        assert int(np.bitwise_count(c[k].view(np.uint64)).sum()) == np.minimum(counts, minhash.LEVELS).sum()
