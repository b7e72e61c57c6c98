import random

from retentio.llm import mixing

from . import brute


def corpus(seed=4, n=400):
    rng = random.Random(seed)
    sources = ["a", "b", "c", "é", None, "tiny"]
    return [(k, " ".join(["w"] * rng.choice([0, 1, 5, 20, 300])), rng.choices(sources, [8, 1, 1, 1, 1, 0.1])[0]) for k in range(n)]


def check(spark, docs):
    got = mixing.take(spark.createDataFrame([(i, t, s, "x") for i, t, s in docs], "doc_id long, text string, source string, size string")).collect()
    want, targets = brute.mix([(i, s, brute.n_words(t)) for i, t, s in docs])
    assert {r.doc_id: r.taken for r in got} == want and len(got) == len(docs)
    assert all(r.target == targets[r.source] and r.taken == r.copies * r["size"] <= 3 * r["size"] for r in got)
    return got, targets


def test_matches_brute_force(spark):
    got, targets = check(spark, corpus())
    for s, t in targets.items():
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - t) <= 300


def test_many_buckets_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    check(spark, corpus(6, 300))


def test_saturated_sources_pass_their_excess_on(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got == brute.targets({"a": 10, "b": 1000, "c": 500, None: 0})
    assert got["a"] == 30 and abs(sum(got.values()) - 1510) < 1e-6


def test_edges(spark):
    """Null and empty texts have size 0; repeated rows are documents of their own;
    an empty table gives an empty mix."""
    docs = [(1, None, "a"), (2, "", "a"), (3, "x y", "a"), (3, "x y", "a"), (None, "z", None), (4, "w " * 50000, "b")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = mixing.take(frame).collect()
    assert len(got) == len(docs) and sorted(r["size"] for r in got) == [0, 0, 1, 2, 2, 50000]
    assert sum(r.taken for r in got) <= 50005
    assert mixing.take(frame.limit(0)).collect() == []
    clash = frame.selectExpr("*", "1 as copies", "2 as target")
    kept = mixing.mix(clash)
    assert set(kept.columns) == set(clash.columns) and kept.columns[-1] == "copies" and mixing.mix(clash.limit(0)).collect() == []
    assert kept.where("copies < 1 or copies > 3").count() == 0


def test_all_empty(spark):
    got = mixing.take(spark.createDataFrame([(1, "", "a"), (2, None, "b")], "doc_id long, text string, source string")).collect()
    assert [(r.taken, r.target) for r in got] == [(0, 0.0)] * 2


def test_columns_of_any_name(spark):
    docs = spark.createDataFrame([(k, f"w{k} " * (k % 7 + 1), f"s{k % 3}") for k in range(60)] + [(None, "a b", None)], "doc_id long, text string, source string")
    clash = docs.selectExpr("*", "1 _id", "'x' _source", "7 _copies", "2 copies", "3 size", "4 h")
    out = mixing.mix(clash)
    assert out.columns == [c for c in clash.columns if c != "copies"] + ["copies"]
    plain = {(r.doc_id, r.copies) for r in mixing.mix(docs).collect()}
    assert {(r.doc_id, r.copies) for r in out.collect()} == plain and {(r._id, r._source, r._copies) for r in out.collect()} == {(1, "x", 7)}


def test_number_of_ranges_has_no_bearing(spark):
    docs = spark.createDataFrame([(k, f"w{k} " * (k * 37 % 11), f"s{k * k % 4}") for k in range(400)], "doc_id long, text string, source string")
    old, got = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (2, 50):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            got.append(sorted((r.doc_id, r.taken) for r in mixing.take(docs).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[0] == got[1] and any(t for _, t in got[0])
