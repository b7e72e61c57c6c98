import random

import pytest

from retentio.llm import decontam

from . import brute


def case(seed=2):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(30)] + ["é", "ÄB", "日本"]
    item = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(k, item(rng.choice([0, 1, 3, 9, 10, 11, 30]))) for k in range(25)] + [(77, None), (78, "?!"), (5, "W1, w2-w3")]
    docs = []
    for k in range(60):
        parts = [item(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            t = rng.choice(items)[1] or ""
            parts += [rng.choice([t, t.upper(), t.replace(" ", ",  ")]), item(5)]
        docs.append((k, rng.choice([". ", "\n"]).join(parts)))
    return docs + [(100, None), (101, ""), (102, "...")], items


@pytest.mark.parametrize("block_words", [10 ** 6, 60])
def test_matches_brute_force(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", block_words)
    docs, items = case()
    d = spark.createDataFrame([(*x, "c") for x in docs], "doc_id long, text string, n_words string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, sorted({h.item_id for h in r.hits})) for r in decontam.scan(d, b).collect()}
    want = brute.contamination(docs, [(str(i), t) for i, t in items])
    assert got == want
    kept = decontam.drop_contaminated(d, b)
    assert kept.schema == d.schema and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, x in want.items() if not x[1])


def test_offsets_are_those_of_the_original(spark):
    text = "Ünïcode first: ONE,two;  three! après"
    hits = decontam.scan(spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string"),
                         spark.createDataFrame([(9, "one two three")], "item_id long, text string")).collect()
    assert [[text[h.start:h.end] for h in r.hits] for r in hits] == [["ONE,two;  three"]] * 2


def test_empty_tables(spark):
    docs, items = case()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    none = decontam.scan(d, b.limit(0))
    assert none.where("n_hit > 0 or size(hits) > 0").count() == 0 and none.count() == len(docs)
    assert decontam.scan(d.limit(0), b).collect() == [] and decontam.drop_contaminated(d, b.limit(0)).count() == len(docs)


def test_long_text(spark):
    text = "filler words " * 200_000 + "a b c d e f g h i j k"
    r = decontam.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"),
                      spark.createDataFrame([(1, "a b c d e f g h i j k l")], "item_id long, text string")).first()
    assert (r.n_words, r.n_hit) == (400_011, 11)
