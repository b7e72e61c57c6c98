import random

import pytest

from retentio.llm import jaccard

from . import brute


def near_copies(seed=3, base=6, copies=12):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    docs = []
    for _ in range(base):
        words = [rng.choice(vocab) for _ in range(rng.randint(30, 120))]
        for _ in range(copies):
            w = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            docs.append(" ".join(w) if rng.random() < 0.8 else "  ".join(w).upper() + "\n")
    docs += [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 8))) for _ in range(40)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("size,percent,frequent_min", [(4, 85, 2), (4, 85, 10 ** 9), (5, 80, 8), (2, 60, 3)])
def test_components_match_brute_force(spark, monkeypatch, size, percent, frequent_min):
    monkeypatch.setattr(jaccard, "FREQUENT_MIN", frequent_min)
    docs = list(enumerate(near_copies(size)))
    got = jaccard.groups(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), shingle=size, percent=percent)
    want = brute.jaccard_groups(docs, size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want
    assert len({c for _, c in want.values()}) < len(docs)


def test_chain_is_one_component(spark):
    """Each text links with the next only; the group is held together by all."""
    words = [f"w{k}" for k in range(60)]
    docs = [(100 - k, " ".join(words[k:k + 40])) for k in range(15)]
    got = jaccard.groups(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute.jaccard_groups(docs, 4, 85)
    assert {r.component_id for r in got.collect()} == {86}


def test_edges(spark):
    """Null and empty texts link with nothing, repeated ids count as documents,
    short texts are one shingle, clashing columns don't matter."""
    docs = [(1, None, 0), (2, "", 0), (3, " \t\n", 1), (4, "a b", 1), (4, "a b", 1), (5, "A  B", 2), (6, "a b c", 3),
            (None, "a b", 4), (7, "x " * 5000, 5), (8, "x " * 6000, 5), (9, "é À a b", 5), (10, "É À a b", 5)]
    got = jaccard.groups(spark.createDataFrame(docs, "doc_id long, text string, n long").withColumnRenamed("n", "sid"))
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str)
    assert rows == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (5, 1, 4), (6, 1, 6), (None, 1, 4),
                           (7, 1, 7), (8, 1, 7), (9, 1, 9), (10, 1, 10)], key=str)
    empty = jaccard.groups(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_shingles", "component_id"]


def test_keep_one(spark):
    docs = list(enumerate(near_copies(9)))
    frame = spark.createDataFrame([(i, t, "s", "sid") for i, t in docs] + [(999, None, "s", "x")], "doc_id long, text string, n string, root string")
    kept = jaccard.keep_one(frame)
    want = {c for _, c in brute.jaccard_groups(docs, 5, 80).values()} | {999}
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_links_through_a_null_id(spark):
    """A text that only a row without id has still joins its neighbours."""
    words = [f"w{k}" for k in range(120)]
    docs = [(5, " ".join(words[:90])), (None, " ".join(words[5:95])), (2, " ".join(words[10:100])), (3, " ".join(words[60:]))]
    got = jaccard.groups(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == {5: 2, None: 2, 2: 2, 3: 3}


def test_keep_one_tells_rows_apart(spark):
    """Repeated ids lose only the row that is a copy; columns may have any name."""
    docs = [(1, "a b c d e f g"), (14, "one two three four five six"), (14, "a b c d e f g"), (None, "a b c d e f g"), (20, "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 _gone", "2 _near_copy", "3 sid", "4 key", "5 _h")
    out = jaccard.keep_one(frame)
    assert out.schema == frame.schema
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, "a b c d e f g"), (14, "one two three four five six"), (20, "x")]


def test_passage_once_in_every_chunk(spark, monkeypatch):
    """A passage that no chunk holds twice is not known as frequent; its long list gives the same groups."""
    monkeypatch.setattr(jaccard, "CHUNK", 1)
    rng = random.Random(8)
    shared = " ".join(f"s{k}" for k in range(30))
    docs = [(k, shared + " " + " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(rng.randint(20, 30)))) for k in range(150)]
    docs += [(1000 + k, docs[k][1] + " more") for k in range(0, 150, 10)]
    got = jaccard.groups(spark.createDataFrame(docs, "doc_id long, text string").repartition(40))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute.jaccard_groups(docs, 4, 85)
