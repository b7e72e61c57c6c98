import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from retentio.llm import periodic
from retentio.llm.text import utf8, words

from . import brute


def patchwork(seed, pieces=6, kinds=(1, 2, 3, 30)):
    """Words in stretches that repeat between once and six times."""
    rng = random.Random(seed)
    k, out = rng.choice(kinds), []
    for _ in range(rng.randint(0, pieces)):
        period = [f"w{rng.randrange(k)}" for _ in range(rng.randint(1, 40))]
        whole = period * rng.randint(1, 6)
        out += whole[:len(whole) - rng.randrange(len(period))]
    return " ".join(out)


def test_runs_match_brute_force():
    texts = [patchwork(s) for s in range(300)]
    data, off = utf8(pa.array(texts))
    w = words(data, off, fold=False)
    got = periodic.find_runs(w.hash, w.off)
    want = [(k, *r) for k, t in enumerate(texts) for r in brute.runs(t.split())]
    assert got == want and len(want) > 200


@pytest.mark.parametrize("period,times,tail", [(1, 24, 0), (1, 23, 0), (7, 3, 2), (7, 3, 3), (8, 3, 0), (17, 3, 0), (17, 3, -1),
                                               (500, 3, 0), (500, 4, 499), (333, 40, 5)])
def test_borders_of_length_and_exponent(period, times, tail):
    p = [f"p{k}" for k in range(period)]
    whole = ["a", "b"] + (p * (times + 1))[:period * times + tail] + ["c"]
    data, off = utf8(pa.array([" ".join(whole)]))
    w = words(data, off, fold=False)
    length = period * times + tail
    assert periodic.find_runs(w.hash, w.off) == ([(0, 2, length, period)] if length >= max(24, 3 * period) else [])


def test_scan(spark):
    """Runs and collapsed texts of every row: null, empty and very long texts,
    repeated rows, clashing columns, letters in either case as they stand."""
    texts = [None, "", " \t\n", "x " * 24, "x " * 23, "é y z " * 12 + "end", "a A " * 20, "x " * 24,
             " ".join(f"u{k % 3000}" for k in range(20_000)), " ".join(str(k) for k in range(30_000))] + [patchwork(s) for s in range(40)]
    docs = spark.createDataFrame([(None if k == 3 else k % 45, t, "s", "r") for k, t in enumerate(texts)],
                                 "doc_id int, text string, runs string, collapsed string").repartition(4)
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.scan(docs).collect()), key=repr)
    want = []
    for k, t in enumerate(texts):
        w = brute.ascii_words(t)
        runs = brute.runs(w) if len(w) < 5000 else ([(0, 20_000, 3000)] if len(w) == 20_000 else [])
        gone = {i for s, n, p in runs for i in range(s + p, s + n)}
        want.append((None if k == 3 else k % 45, len(w), runs, " ".join(x for i, x in enumerate(w) if i not in gone)))
    assert got == sorted(want, key=repr)
    empty = periodic.scan(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_words", "runs", "collapsed"]


def test_strongest_run(spark):
    runs = "array<struct<start:bigint,length:bigint,period:bigint>>"
    rows = [[(0, 30, 10), (5, 31, 10), (40, 62, 20)], [(9, 60, 20), (3, 30, 10), (3, 60, 20)], [], None]
    got = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], f"k int, runs {runs}").select(
        "k", periodic.strongest(F.col("runs")).alias("x")).orderBy("k").collect()
    assert [r.x and tuple(r.x) for r in got] == [(5, 31, 10), (9, 60, 20), None, None]


def test_many_occurrences_take_linear_work():
    """A gram at 20,000 places gives one stretch, not their pairs."""
    h = np.full(20_000, 7, np.uint64)
    lag, at = periodic._seeds(np.full(19_985, 5, np.uint64), 16, 0, np.zeros(20_000, np.int64), np.array([0, 20_000]))
    assert len(lag) == 19_984 and set(lag) == {1}
    assert periodic.find_runs(h, np.array([0, 20_000])) == [(0, 0, 20_000, 1)]


def test_planted_tail(spark):
    """The test texts: words from place a on repeat, for one id in ten."""
    import zlib
    docs = [(k, " ".join(f"w{k}x{j}" for j in range(k % 97))) for k in range(200)] + [(None, "a b c"), (7, None)]
    got = {r.doc_id: r.t for r in spark.createDataFrame(docs[:200], "doc_id long, text string").select(
        "doc_id", periodic.repeated_tail(F.col("text"), F.col("doc_id")).alias("t")).collect()}
    for k, text in docs[:200]:
        h, w = zlib.crc32(str(k).encode()), text.split()
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(n))
        assert got[k] == text
    rest = spark.createDataFrame(docs[200:], "doc_id long, text string").select(periodic.repeated_tail(F.col("text"), F.col("doc_id")).alias("t"))
    assert {r.t for r in rest.collect()} == {"a b c", None}
