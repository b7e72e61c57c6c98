import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from retentio.llm import toxicity as T

from ..conftest import SF01
from . import brute

LEX = T.Lexicon({"idiot": 5.0, "trash": 4.0, "scum": 3.0})


def found(text):
    return [(text[a:b], t) for a, b, t, _ in LEX.matches(text)]


def test_folding_keeps_the_length_and_undoes_disguise():
    for text in ("IDIOT", "1d10t", "іdіоt", "ｉｄｉｏｔ", "idi0t", "i!diot".replace("!", ""), "!diot"):
        assert T.fold(text).strip() == "idiot" and len(T.fold(text)) == len(text), text
    text = "ǅ ß İ ﬁ 日本 $$$ a$$ 2024 x2 \U0001f600 5%"
    assert len(T.fold(text)) == len(text)
    assert T.fold("stupid$$$ wait!! 100").split() == ["stupid", "wait"]


def test_matches_have_original_offsets():
    assert found("You ID1OT, you tr4sh!") == [("ID1OT", "idiot"), ("tr4sh", "trash")]
    assert found("Ünï іdіоt日") == [("іdіоt", "idiot")]
    assert found("the trashcan") == [("trash", "trash")]  # begins with the term
    assert found("inscumbent patriotidiot") == []  # not at the start of a word


def test_exceptions_cancel_matches():
    assert found("the trash can is full") == [] and found("pond scum") == []
    assert found("trash cannot") == [("trash", "trash")]
    assert found("trash can, trash") == [("trash", "trash")]


def test_score_is_normalised_by_length():
    short, long = "idiot", "idiot " + "fine words here " * 200
    assert LEX.density(short) > LEX.density(long) > 0 == LEX.density("fine") == LEX.density(None)
    assert math.isclose(LEX.density(short), 5 / math.sqrt(1.05))


def test_edges(spark):
    """Null and empty texts score as documents without matches; rows repeat."""
    docs = [(1, None, 0.5), (2, "", 0.5), (3, "idiot", 0.5), (3, "idiot", 0.5), (4, "fine " * 100_000, 0.5)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score double")
    got = sorted((r.doc_id, round(r.score, 3), len(r.matches)) for r in T.scan(frame, LEX).collect())
    assert [g[0] for g in got] == [1, 2, 3, 3, 4] and [g[2] for g in got] == [0, 0, 1, 1, 0]
    assert T.scan(frame.limit(0), LEX).collect() == []
    kept = T.drop_toxic(frame, LEX)
    assert kept.schema == frame.schema and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]
    empty = spark.createDataFrame([], "text string, label int, weight double")
    assert T.fit(empty).terms == {} and T.Lexicon({}).score("idiot") < T.THRESHOLD


def test_learning_finds_terms_and_exceptions(spark):
    rows = []
    for k in range(300):
        rows.append((f"the quick text number {'abcdefghij'[k % 10] * 5} runs", 0, 1.0))
        if k % 3 == 0:
            rows.append((f"you blorg{'abcdefghij'[k % 10]} {'xyz'[k % 3]}", 1, 1.0))
        if k % 30 == 0:
            rows.append(("a blorga fish swims", 0, 1.0))
    lex = T.fit(spark.createDataFrame(rows, "text string, label int, weight double"))
    assert "blorg" in lex.terms and any("fish" in e for e in lex.exceptions)
    assert lex.score("you blorgz") > 0.5 > lex.score("the quick text") and lex.score("a blorga fish") < 0.3


@pytest.fixture(scope="module")
def scored(spark):
    df = E.queries()["op1_toxicity"](spark, SF01)
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    return df, df.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").toPandas()


def test_held_out_accuracy(spark, scored):
    df, t = scored
    assert df.count() == 1000 and df.where("score < 0 or score > 1 or score is null").count() == 0
    assert df.where(F.col("predicted") != (F.col("score") >= 0.3).cast("int")).count() == 0
    clean = t[t.toxic == 0]
    assert (clean.predicted == 0).mean() > 0.97 and t[t.toxic == 1].predicted.mean() > 0.6


def test_folding_of_styled_and_accented_letters():
    for text in ("𝐢𝐝𝐢𝐨𝐭", "ídiot", "ÌDIÓT", "𝓲𝓭𝓲𝓸𝓽", "ⓘⓓⓘⓞⓣ", "idïöt"):
        assert T.fold(text) == "idiot" and len(T.fold(text)) == len(text), text
    assert T.fold("日本 한국어 мир") == "日本 한국어 " + T.fold("мир") and "\U00020000"  # other scripts stay letters


def test_short_terms_are_whole_words():
    lex = T.Lexicon({"kys": 6.0, "git": 4.0, "stupid": 3.0})
    hits = lambda t: [(t[a:b], w) for a, b, w, _ in lex.matches(t)]
    assert hits("KYS you git") == [("KYS", "kys"), ("git", "git")] and hits("gitar kysh digit") == []
    assert hits("git git stupidly") == [("git", "git"), ("git", "git"), ("stupid", "stupid")]


def test_scores_match_brute_force(spark):
    """A learnt lexicon over all documents, every word looked at."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    lex = T.fit(T.training_sample(docs, spark.read.parquet(f"{SF01}/labels.parquet")))
    lex.terms.update({"the": 0.5, "and": 0.25, "wor": 0.125})
    lex._automaton = None
    got = {r.doc_id: r.score for r in T.scan(docs, lex).collect()}
    assert any(len(t) < 4 for t in lex.terms) and len(lex.terms) > 5
    for r in docs.select("doc_id", "text").collect():
        if len(r.text or "") < 20_000:
            assert math.isclose(got[r.doc_id], brute.toxic_score(r.text, lex, T.fold), rel_tol=1e-9), r.doc_id
