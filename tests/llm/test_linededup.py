import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from retentio.llm import linededup as L
from retentio.llm.text import utf8

from . import brute


def texts(seed=5, n=30):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(120)]
    lines = [[rng.choice(vocab) for _ in range(rng.randint(1, 70))] for _ in range(25)]
    out = []
    for k in range(n):
        own = []
        for _ in range(rng.randint(0, 6)):
            x = list(rng.choice(lines))
            for _ in range(rng.choice([0, 0, 0, 1, 2])):
                x[rng.randrange(len(x))] = rng.choice(vocab)
            own.append(rng.choice([" ", ", "]).join(x) if rng.random() < 0.8 else " ".join(x).upper() + "!")
        out.append((k * 7 % n, "\n".join(own + [rng.choice(["", "--", "unique %d a b c" % k])])))
    return out


def dropped(spark, docs, parts=4, **options):
    got = L.dropped_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(parts), **options)
    return {r.doc_id: list(r.lines) for r in got.collect()}


@pytest.mark.parametrize("seed,similarity", [(5, 0.8), (8, 0.9), (9, 0.6), (10, 0.97), (11, 1.0)])
def test_matches_brute_force(spark, seed, similarity):
    docs = texts(seed)
    want = brute.dropped_lines(docs, similarity)
    assert dropped(spark, docs, similarity=similarity) == want and any(want.values())


def test_large_components_are_compared_with_others(spark, monkeypatch):
    """With every component of two counted as large the groups stay the same."""
    docs = texts(21, 60)
    want = brute.dropped_lines(docs, 0.8)
    monkeypatch.setattr(L, "LARGE", 2)
    assert dropped(spark, docs) == want
    monkeypatch.setattr(L, "simhash_pairs", lambda classes: classes.where("false").selectExpr("h a", "h b"))
    assert dropped(spark, docs) == want  # the exact lists alone find as much


def test_a_class_gets_its_root_once(spark, monkeypatch):
    """Classes are joined with the roots before they are dealt to their lists."""
    monkeypatch.setattr(L, "LARGE", 2)
    beside = []
    met = L._met
    monkeypatch.setattr(L, "_met", lambda a, b, *more: beside.append(b) or met(a, b, *more))
    shape = [F.lit(0).cast("long").alias(c) for c in L.PARITIES]
    classes = spark.range(6).select(F.col("id").alias("h"), F.lit(20).alias("n"), *shape, F.expr("array(1, 2, 3, 100 + int(id))").alias("pre"))
    roots = spark.createDataFrame([(0, 0), (1, 0), (2, 2), (3, 2)], "node long, root long")
    got = {(r.a, r.b) for r in L.large_component_pairs(classes, roots, 0.8).collect()}
    assert got == {(a, b) for a in range(4) for b in range(a + 1, 6) if a // 2 != b // 2}
    plan = beside[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")


def test_lines_less_one_word_are_joined_in_parts(spark, monkeypatch):
    """Each part is written, and its shuffle files deleted, before the next; together they have all links."""
    parts = []
    cut = L.cut
    monkeypatch.setattr(L, "cut", lambda df: parts.append(cut(df)) or parts[-1])
    classes = spark.createDataFrame([(1, [-5, 6, 7]), (2, [-5, 8]), (3, [8, 9]), (4, [6, 11]), (5, [12])], "h long, rest array<long>")
    got = sorted((r.a, r.b) for r in L.one_word_apart(classes).collect())
    assert got == [(1, 2), (1, 4), (2, 3)]
    assert len(parts) == L.REST_ROUNDS and sum(x.count() for x in parts) == 3


def test_simhash_is_a_weighted_majority():
    rng = random.Random(1)
    line = " ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 12))) for _ in range(400))
    lines = L.Lines(*utf8(pa.array([line])))
    voters = [L.mix(lines.hash ^ np.uint64(x)).tolist() for x in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    votes = [0] * 80
    for v, m, w in zip(*voters, brute.simhash_words(line)):
        for i in range(80):
            votes[i] += (1 if len(w) <= 3 else 2 if len(w) <= 6 else 3) * (1 if (v | m << 64) >> i & 1 else -1)
    assert sum(int(b[0]) << 20 * k for k, b in enumerate(lines.simhashes())) == sum(1 << i for i in range(80) if votes[i] > 0)


def test_simhash_blocks_bring_near_lines_together(spark):
    """Long lines with one or two words changed mostly share a block with their group's leader."""
    rng = random.Random(4)
    docs = []
    for k in range(40):
        x = [f"w{rng.randrange(5000)}" for _ in range(60)]
        y = list(x)
        y[rng.randrange(60)] = "other"
        docs += [(2 * k, " ".join(x)), (2 * k + 1, " ".join(y))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    classes = L.line_table(frame, "doc_id", "text", more=True).withColumn("c", F.lit(1))
    assert L.simhash_pairs(classes).count() >= 25


@pytest.mark.parametrize("similarity", [0.6, 0.8, 0.9])
def test_near_lines_share_a_posted_word(similarity):
    """Any two near lines that allow two edits post a common word or pair of words, long ones too."""
    rng = random.Random(12)
    levels = np.random.default_rng(1).integers(7, 60, 1 << L.LEVEL_BITS).astype(np.uint8)
    for _ in range(300):
        n = rng.choice([8, 10, 13, 30, 39, 40, 45, 49, 50, 52, 55, 80, 130, 260])
        x = [f"w{rng.randrange(400)}" for _ in range(n)]
        y = list(x)
        for _ in range(rng.randint(0, L.edits(n, similarity))):
            at = rng.randrange(len(y))
            y[at:at + 1] = rng.choice([[f"v{rng.randrange(400)}"], [], [y[at], "v"]])
        m = max(len(x), len(y))
        if L.edits(m, similarity) < 2 or brute.edit_distance(x, y) > L.edits(m, similarity):
            continue
        a, b = L.Lines(*utf8(pa.array([" ".join(x), " ".join(y)]))).prefixes(levels, similarity).to_pylist()
        assert set(a) & set(b), (len(x), len(y))


def test_left_out_words_meet():
    """Lines of 5 to 9 words share a rest exactly when they are one word apart."""
    rng = random.Random(6)
    lines = [" ".join(rng.choice("abc") for _ in range(rng.randint(3, 11))) for _ in range(300)]
    rest = L.Lines(*utf8(pa.array(lines))).left_out(0.8).to_pylist()
    for i, a in enumerate(lines):
        for j in range(i):
            x, y = a.split(), lines[j].split()
            if x != y and 5 <= max(len(x), len(y)) <= 9:
                assert bool(set(rest[i]) & set(rest[j])) == (brute.edit_distance(x, y) <= 1)


def test_documents_are_told_apart_by_id_and_text(spark):
    """Repeated and null ids lose only lines that stay elsewhere; columns may have any name."""
    docs = [(1, "common line of five words"), (5, "common line of five words\nunique beta text that is long enough"),
            (5, "unique alpha text that stays too\ncommon line of five words"), (None, "common line of five words\nonly here without id now"),
            (None, "a line that null holds here"), (9, "a line that null holds there")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("_id", "_gone", "row", "lines", "key", "h")})
    out = L.dedup(frame)
    assert out.schema == frame.schema
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, "common line of five words"), (5, "unique beta text that is long enough"), (5, "unique alpha text that stays too"),
                          (None, "only here without id now"), (9, "a line that null holds there")], key=str)
    assert L.report(frame).count() == len(docs)


def test_edges(spark):
    """No lines in null or empty texts; the least (id, line) stays; repeated ids
    keep the same lines; an emptied document goes, one without words stays."""
    docs = [(3, "Same line here.\nown three", 9, "k"), (1, "same LINE here\n\n--\n--", 9, "k"), (2, None, None, "k"), (4, "", 0, "k"),
            (5, "same line here", 14, "k"), (5, "same line here", 14, "k"), (6, "--\n--", 5, "k"), (7, "x " * 30000 + "\n" + "x " * 30000, 1, "k")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, n_chars long, keep string")
    out = {r.doc_id: r for r in L.dedup(frame).collect()}
    assert sorted(out) == [1, 2, 3, 4, 6, 7] and L.dedup(frame).schema == frame.schema
    assert out[3].text == "own three" and out[3].n_chars == 9 and out[1].text == "same LINE here\n\n--\n--"
    assert out[2].text is None and out[6].text == "--\n--" and out[7].n_chars == 60000
    rep = {r.doc_id: r for r in L.report(frame).collect()}
    assert len(L.report(frame).collect()) == len(docs)
    assert (rep[5].n_dropped, rep[5].dropped, rep[5].n_chars) == (1, "0", 0) and rep[2].n_lines == 0
    assert L.dedup(frame, drop_emptied=False).count() == len(docs)
    empty = spark.createDataFrame([], frame.schema)
    assert L.dedup(empty).collect() == [] and L.report(empty).collect() == []


def test_edit_similarity_alone_decides(spark):
    """One of 10 to 14 words replaced, dropped or added: all are near, whatever their SimHashes."""
    rng = random.Random(2)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    docs = []
    for k in range(60):
        x = [rng.choice(vocab) for _ in range(rng.choice([5, 10, 12, 14, 30, 90]))]
        y = list(x)
        for _ in range(rng.randint(1, len(x) // 5)):
            at = rng.randrange(len(y))
            y[at:at + 1] = rng.choice([[rng.choice(vocab)], [], [y[at], rng.choice(vocab)]])
        docs += [(2 * k, " ".join(x)), (2 * k + 1, " ".join(y) + "\nown %d" % k)]
    got = dropped(spark, docs)
    assert got == brute.dropped_lines(docs, 0.8)
    assert len(got) >= 50


def test_classes_of_large_components_are_not_all_paired(spark, monkeypatch):
    """Two large components of near lines, which no SimHash list joins, meet by few of their members."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(40)]
    docs = []
    for k in range(100):
        x = list(base)
        x[rng.randrange(40)] = f"v{k}"
        docs.append((k, " ".join(x + ["more"] * (k % 2))))
    monkeypatch.setattr(L, "LARGE", 8)
    monkeypatch.setattr(L, "simhash_pairs", lambda classes: classes.join(classes.groupBy("n").agg(F.min("h").alias("a")), "n")
                        .where("a < h").selectExpr("a", "h b"))
    found, old = [], L.rare_word_pairs
    monkeypatch.setattr(L, "rare_word_pairs", lambda *a: (found.append(old(*a).count()), old(*a))[1])
    got = dropped(spark, docs)
    assert got == {k: [0] for k in range(1, 100)}
    assert found == [0]


def test_classes_that_share_many_lists_meet_once(spark, monkeypatch):
    """The join of the lists makes one row of a pair, in the first list that both have, whatever they share."""
    shape = [F.lit(0).cast("long").alias(c) for c in L.PARITIES]
    pre = F.expr("if(id < 4, array(-7, 1, 2, 3, 4), array(3, 4, 90 + int(id)))").alias("pre")
    classes = spark.range(6).select(F.col("id").alias("h"), F.lit(20).alias("n"), *shape, pre, F.lit(None).cast("long").alias("root"))
    entries = L._entries(classes, "h", "n", *L.PARITIES, "root")
    monkeypatch.setattr(L, "_pairs", lambda q: q)
    got = sorted((r.h_a, r.h_b, r.list_a) for r in L._met(entries, entries, 0.8, F.col("h_a") < F.col("h_b")).collect())
    assert got == [(a, b, -7 if b < 4 else 3) for a in range(6) for b in range(a + 1, 6)]


def test_lengths_tighten_the_parity_bound(spark):
    """Of lines that differ by d words, d edits change one parity each: one more differing pair is ruled out, real ones stay."""
    rng = random.Random(3)
    rows = []
    for _ in range(200):
        x = [f"w{rng.randrange(300)}" for _ in range(rng.randint(10, 60))]
        y = list(x)
        for _ in range(rng.randint(0, L.edits(len(x), 0.8))):
            at = rng.randrange(len(y))
            y[at:at + 1] = rng.choice([["v%d" % rng.randrange(300)], [], [y[at], "v"]])
        if brute.edit_distance(x, y) <= L.edits(max(len(x), len(y)), 0.8):
            lines = L.Lines(*utf8(pa.array([" ".join(x), " ".join(y)])))
            p = [v.tolist() for v in lines.parities()]
            rows.append((len(x), len(y), *[v[0] for v in p], *[v[1] for v in p]))
    cols = ["n_a", "n_b"] + [c + s for s in ("_a", "_b") for c in L.PARITIES]
    assert spark.createDataFrame(rows, cols).where(~L._possible(0.8)).count() == 0
    far = spark.createDataFrame([(20, 24, (1 << 5) - 1, 0, 0, 0, 0, 0, 0, 0)], cols)  # 5 odd kinds may come from 4 words more and an edit less
    assert far.where(L._possible(0.8)).count() == 0


def test_leaders_lead_few_lists(spark, monkeypatch):
    """However many lists a component's leaders are in, a class meets each of them in few; links are the same."""
    shape = [F.lit(0).cast("long").alias(c) for c in L.PARITIES]
    classes = spark.range(6).select(F.col("id").alias("h"), F.lit(20).alias("n"), *shape, F.sequence(F.lit(1), F.lit(40)).alias("pre"))
    roots = spark.createDataFrame([(0, 0), (1, 0)], "node long, root long")
    monkeypatch.setattr(L, "LARGE", 2)
    monkeypatch.setattr(L, "_pairs", lambda q: q.select(F.col("h_a").alias("a"), F.col("h_b").alias("b")))
    rows = [(r.a, r.b) for r in L.large_component_pairs(classes, roots, 0.8).collect()]
    assert set(rows) == {(a, b) for a in (0, 1) for b in range(2, 6)} and len(rows) == 8 * L.LED
