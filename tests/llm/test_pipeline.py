"""Every stage against its brute-force version on a small corpus."""

import pytest

import corpus_pipeline as C
from retentio.llm import linededup, toxicity
from retentio.llm.queries import learnable

from ..conftest import SF001
from . import brute


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Documents before the first and after every stage, written between."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    extra = spark.createDataFrame([(9001, "", "en", "src1", 0), (9002, None, None, None, None)], docs.schema)
    docs = docs.unionByName(extra)
    out = [docs]
    for k, (_, stage) in enumerate(C.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, out[-1], SF001).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_order_and_columns(stages):
    assert [n for n, _ in C.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights"]
    assert all(s.columns == stages[0].columns for s in stages[1:-1])
    assert stages[-1].columns == [*stages[0].columns, "copies"]


def test_toxicity(spark, stages):
    lex = toxicity.fit(toxicity.training_sample(stages[0], learnable(spark.read.parquet(f"{SF001}/labels.parquet"))))
    assert set(rows(stages[1])) == {i for i, r in rows(stages[0]).items() if lex.score(r.text) < toxicity.THRESHOLD}


def test_line_dedup(stages):
    before, after = rows(stages[1]), rows(stages[2])
    docs = [(i, r.text) for i, r in before.items()]
    gone = brute.dropped_lines(docs, linededup.SIMILARITY)
    want = {i: linededup.without_lines(t, set(gone.get(i, []))) for i, t in docs}
    want = {i: t for i, t in want.items() if i not in gone or t.strip()}
    assert {i: r.text for i, r in after.items()} == want
    assert all(r.n_chars == len(r.text) for i, r in after.items() if i in gone)


def test_jaccard(stages):
    docs = [(i, r.text) for i, r in rows(stages[2]).items()]
    groups = brute.jaccard_groups(docs, 5, 80)
    assert set(rows(stages[3])) == {i for i, (n, c) in groups.items() if not n or c == i}


def test_decontamination(spark, stages):
    docs = [(i, r.text) for i, r in rows(stages[3]).items()]
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    hits = brute.contamination(docs, items)
    assert set(rows(stages[4])) == {i for i, h in hits.items() if not h[1]}


def test_mixing(stages):
    docs = [(i, r.source, brute.n_words(r.text)) for i, r in rows(stages[4]).items()]
    taken, _ = brute.mix(docs)
    size = {i: n for i, _, n in docs}
    got = rows(stages[5])
    assert {i: r.copies * size[i] for i, r in got.items() if size[i]} == {i: t for i, t in taken.items() if t}


def test_run_and_empty_tables(spark, stages):
    assert sorted(r.doc_id for r in C.run(spark, SF001).collect()) == sorted(i for i in rows(stages[5]) if i < 9000)
    empty = stages[0].limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, empty, SF001).collect() == []
