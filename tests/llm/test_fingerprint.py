import hashlib
import random

import pytest

from retentio.llm import fingerprint as FP


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    syll = ["the", "ing", "ré", "en", "ß", "日", "on", " ", " ", ". "]
    docs = [(k * 3, "".join(rng.choice(syll) for _ in range(rng.choice([0, 1, 2, 50, 400])))) for k in range(n)]
    docs += [(1, None), (2, docs[5][1]), (-4, docs[5][1])]
    rng.shuffle(docs)
    return docs


@pytest.fixture
def partitions(spark, request):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("partitions,kind", [(2, "long"), (60, "long"), (7, "string")], indirect=["partitions"])
def test_next_and_edited_match_brute_force(spark, partitions, kind):
    docs = [(i if kind == "long" else f"id {i}", t) for i, t in corpus()]
    got = {r.doc_id: r for r in FP.edit_likeness(spark.createDataFrame([(*d, "x") for d in docs], f"doc_id {kind}, text string, fingerprint string")).collect()}
    order = sorted(((i, t or "") for i, t in docs), reverse=True)
    prints = {t: FP.fingerprints(FP.pa.array([t]))[0] for _, t in order}
    assert len(got) == len(docs)
    for k, (i, t) in enumerate(order):
        follow = order[(k + 1) % len(order)][1]
        e = t[:len(t) - len(t) // 3] + follow[:len(t) // 3]
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint) == (len(t), hashlib.sha256(e.encode()).hexdigest(), prints[t])
        assert r.edited_fingerprint == FP.fingerprints(FP.pa.array([e]))[0]
        assert r.near_edited == FP.likeness([r.fingerprint], [r.edited_fingerprint])[0]
        assert r.near_next == FP.likeness([r.fingerprint], [prints[follow]])[0]


def test_digest_counts_quartiles():
    text = "the cat sat on the mat; the dog did not. " * 20
    raw = text.encode()
    counts = [0] * FP.BUCKETS
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        counts[FP._T[3][FP._T[0][a] ^ FP._T[1][b]] ^ FP._T[2][c]] += 1
    s = sorted(counts)
    q = [s[FP.BUCKETS * k // 4 - 1] for k in (1, 2, 3)]
    codes = [sum(c > x for x in q) for c in counts]
    digest = bytes.fromhex(FP.fingerprints(FP.pa.array([text]))[0])
    assert len(digest) * 2 == FP.DIGEST_CHARS
    assert [digest[4 + k // 4] >> (6 - 2 * (k % 4)) & 3 for k in range(FP.BUCKETS)] == codes


def test_likeness_is_bounded_and_ranks_edits():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    a, b = " ".join(words[:2000]), " ".join(words[2000:])
    few = a.replace(words[7], "zzzz")
    fa, fb, fe = FP.fingerprints(FP.pa.array([a, b, few]))
    same, edit, other = FP.likeness([fa] * 3, [fa, fe, fb])
    assert same == 1.0 and edit > 0.8 and 0 <= other < edit


def test_edges(spark):
    """One document follows itself; repeated ids follow one another; null is empty."""
    one = FP.edit_likeness(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1.0
    twice = FP.edit_likeness(spark.createDataFrame([(5, "abc"), (5, "abc"), (None, "x"), (6, None)], "doc_id long, text string")).collect()
    assert sorted(str(r.doc_id) for r in twice) == ["5", "5", "6", "None"]
    assert FP.edit_likeness(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    long = "Long text, é. " * 60_000
    nulls = FP.edit_likeness(spark.createDataFrame([(None, f"text {k}") for k in range(50)] + [(1, long), (0, "end")], "doc_id long, text string")).collect()
    assert len(nulls) == 52 and {r.n_chars for r in nulls if r.doc_id == 1} == {len(long)}
    frame = spark.createDataFrame([(1, None, 2), (2, "", 3)], "doc_id long, text string, fingerprint int")
    got = FP.add_fingerprint(frame).collect()
    assert got[0].fingerprint == got[1].fingerprint and FP.add_fingerprint(frame.limit(0)).collect() == []
