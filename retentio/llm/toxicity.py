"""Toxicity scores: a weighted lexicon matched by Aho-Corasick.

Texts are folded code point by code point: capitals, accented, wide and styled forms
and look-alike letters of other scripts become small Latin letters, digits and signs that
stand for letters inside a word are undone, everything but letters is a space.  Folding
keeps the length, so matches have the original's offsets.  A term matches at
the start of a word, one of under four letters a whole word only; one automaton holds all terms and all exception phrases,
and a match inside an exception phrase does not count.

The lexicon is learnt from labels: words and word beginnings that are far more
frequent in toxic than in clean documents, weighted by their log odds.  Words
around matches that only clean documents have become exception phrases, beside
the given ones.  The sum of a document's weights is divided by the square root
of its length and turned into a probability by a logistic curve fitted on the
same rows.

Learning reads a bounded sample (``MAX_TOXIC`` and ``MAX_CLEAN`` documents);
scoring covers every whole text.  Null, empty and foreign texts without a
match score as documents without matches do.  Where there are no labels of
both kinds, the given lexicon's default curve is used.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import pieces

THRESHOLD = 0.3
#: Bounds of the training sample.
MAX_TOXIC, MAX_CLEAN = 3_000, 4_500
#: Lengths of word beginnings tried as terms, and least length of a whole word.
STEMS, SHORT = range(4, 11), 2
#: Least documents, log-likelihood ratio and log odds of a term.
MIN_DOCS, MIN_G2, MIN_ODDS = 3, 20.0, 3.0

#: Phrases in which a term is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "clownfish", "pathetic fallacy", "pond scum")

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = dict(zip(
    "абвгекмнорстухіјѕԁһԛԝɡıΑΒΕΖΗΙΚΜΝΟΡΤΥΧαβεηικνορτυχγωʙɪɴʀ",
    "abbrekmhopctyxijsdhqwgiabezhikmnoptyxabeniknoptyxywbinr"))
#: Digits and signs that stand for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}


#: Code points that are folded: the first two planes hold all styled and accented Latin letters.
FOLDED = 0x20000


def _base(c: str) -> str:
    """The letter under accents, where it is Latin or looks Latin."""
    base = unicodedata.normalize("NFKD", c)[:1]
    return base if base != c and (base.isascii() and base.isalpha() or base in HOMOGLYPHS) else c


def _fold_table() -> str:
    """Folded character of every code point below ``FOLDED``."""
    out = []
    for i in range(FOLDED):
        c = chr(i)
        if c in SUBSTITUTES or "0" <= c <= "9":
            out.append(c)
            continue
        c = _base(c)
        low = HOMOGLYPHS.get(c) or c.lower()
        low = HOMOGLYPHS.get(low, low)
        low = _base(unicodedata.normalize("NFKC", low)[:1].lower()[:1])
        out.append(low if low.isalpha() else c if 0xD800 <= i < 0xE000 else " ")
    return "".join(out)


_FOLD = _fold_table()
_DIGITS = re.compile(r"(?<=[a-z])[0134578]+(?![0-9])|[0134578]+(?=[a-z])")
_SIGNS = re.compile(r"(?<![@$!])[@$!](?=[a-z])")
_REST = {ord(c): " " for c in "0123456789@$!"}


def fold(text: str) -> str:
    """The folded text, as long as the original."""
    t = text.translate(_FOLD)
    undo = lambda m: "".join(SUBSTITUTES[c] for c in m[0])
    if any(c in t for c in "0134578"):
        t = _DIGITS.sub(undo, t)
    if "@" in t or "$" in t or "!" in t:
        t = _SIGNS.sub(undo, t)
    return t.translate(_REST)


@dataclass
class Lexicon:
    """Terms with weights, exception phrases, and the logistic curve."""

    terms: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    slope: float = 8.0
    offset: float = -4.0
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            a = ahocorasick.Automaton()
            for term, weight in self.terms.items():
                # A short term ends with its word: the space after it belongs to the key.
                short = len(term) < STEMS[0]
                a.add_word(" " + fold(term) + " " * short, (len(term), weight, term, int(short)))
            for phrase in self.exceptions:
                key = " ".join(fold(phrase).split())
                a.add_word(f" {key} ", (len(key), None, phrase, 1))
            if len(a):
                a.make_automaton()
            self._automaton = a
        return self._automaton

    def matches(self, text: str | None) -> list[tuple[int, int, str, float]]:
        """(start, end, term, weight) of the counting matches.

        The heaviest term counts where several begin at the same place.
        """
        a = self.automaton()
        if not text or not len(a):
            return []
        found = list(a.iter(f" {fold(text)} "))
        if not found:
            return []
        best: dict[int, tuple[int, int, str, float]] = {}
        # Phrases and short terms end before their closing space.
        calm = [(e - 1 - n, e - 1) for e, (n, w, _, _) in found if w is None]
        for e, (n, w, term, closed) in found:
            e -= closed
            s = e - n
            if w is None or any(x <= s and e <= y for x, y in calm):
                continue
            if s not in best or w > best[s][3]:
                best[s] = (s, e, term, w)
        return sorted(best.values())

    def density(self, text: str | None) -> float:
        """Sum of weights over the square root of the length in hundred characters."""
        hits = self.matches(text)
        return sum(h[3] for h in hits) / math.sqrt(1 + len(text) / 100) if hits else 0.0

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.offset + self.slope * self.density(text)))))


def training_sample(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> DataFrame:
    """(text, label, weight) of at most about MAX_TOXIC + MAX_CLEAN labelled documents.

    ``labels`` must hold only rows that may be learnt from.  Rows are chosen
    by a hash of the id; the weight undoes the sampling.  The chosen ids are
    bounded by the parameters, so they are broadcast to the scan of texts.
    """
    lab = (labels.where(F.col(label_col).isin(0, 1))
           .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")))
    n = {r.label: r.n for r in lab.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = {1: min(1.0, MAX_TOXIC / max(1, n.get(1, 0))), 0: min(1.0, MAX_CLEAN / max(1, n.get(0, 0)))}
    u = F.pmod(F.xxhash64(F.lit("toxicity"), "_id"), F.lit(1_000_000)) / 1_000_000
    limit = F.when(F.col("label") == 1, F.lit(share[1])).otherwise(F.lit(share[0]))
    chosen = F.broadcast(lab.where(u < limit).withColumn("weight", 1 / limit))
    return (docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("string").alias("text"))
            .join(chosen, F.col("_doc") == F.col("_id")).select("text", "label", "weight"))


_WORD = re.compile(r"[^ ]+")


def _terms_of(text: str) -> set[str]:
    words = set(fold(text).split())
    out = {w for w in words if len(w) >= SHORT}
    for n in STEMS:
        out |= {w[:n] for w in words if len(w) > n}
    return out


def fit(sample: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Learn a lexicon from (text, label, weight) rows."""
    n = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    if not pos or not neg:
        return Lexicon({}, exceptions)
    lexicon = Lexicon(_learn_terms(sample, pos, neg), exceptions)
    lexicon.exceptions = exceptions + _learn_exceptions(sample, lexicon)
    lexicon._automaton = None
    _learn_curve(sample, lexicon)
    return lexicon


def _learn_terms(sample: DataFrame, pos: int, neg: int) -> dict[str, float]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[label].update(_terms_of(text or ""))
        # A term must be in a toxic document somewhere; that is known after the sum.
        terms = list(total[0].keys() | total[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([total[1][t] for t in terms], pa.int64()),
                                          pa.array([total[0][t] for t in terms], pa.int64())], names=["term", "p", "n"])

    sums = (sample.select("text", "label").mapInArrow(count, "term string, p long, n long")
            .groupBy("term").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
            .where((F.col("p") >= MIN_DOCS) & (F.col("p") * neg > F.col("n") * pos)))
    # Log-likelihood ratio of the term's share in toxic against all documents.
    part = lambda k, m: F.when(k > 0, k * F.log(k * F.lit(float(pos + neg)) / ((F.col("p") + F.col("n")) * F.lit(float(m))))).otherwise(0.0)
    sums = (sums.withColumn("g2", 2 * (part(F.col("p"), pos) + part(F.col("n"), neg)))
            .withColumn("odds", F.log((F.col("p") + 0.5) / (pos + 1.0)) - F.log((F.col("n") + 0.5) / (neg + 1.0)))
            .where((F.col("g2") >= MIN_G2) & (F.col("odds") >= MIN_ODDS)))
    # Few terms pass: their number is bounded by the sample.
    rows = {r.term: (r.p, r.n, r.odds) for r in sums.collect()}
    # A beginning gives way to a longer term that has nearly all of its documents ...
    full = {t for t in rows if not any(u.startswith(t) and len(u) > len(t) and rows[u][0] >= 0.9 * rows[t][0] for u in rows)}
    # ... and a term to a beginning that stays, covers it and is as telling.
    covered = lambda t: any(t[:k] in full and rows[t[:k]][2] >= rows[t][2] - 0.25 for k in range(STEMS[0], len(t)))
    return {t: rows[t][2] for t in sorted(full) if not covered(t)}


def _learn_exceptions(sample: DataFrame, lexicon: Lexicon) -> tuple[str, ...]:
    """Phrases around matches that only clean documents have, in two or more."""
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hits = shared.value.matches(text)
                if not hits:
                    continue
                words = [m.span() for m in _WORD.finditer(fold(text))]
                at = {a: k for k, (a, _) in enumerate(words)}
                folded, own = fold(text), set()
                for s, *_ in hits:
                    k = at.get(s)
                    if k is None:
                        continue
                    here = folded[slice(*words[k])]
                    own.add(here)
                    if k:
                        own.add(folded[slice(*words[k - 1])] + " " + here)
                    if k + 1 < len(words):
                        own.add(here + " " + folded[slice(*words[k + 1])])
                total[label].update(own)
        keys = list(total[0].keys() | total[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([total[1][t] for t in keys], pa.int64()),
                                          pa.array([total[0][t] for t in keys], pa.int64())], names=["phrase", "p", "n"])

    rows = (sample.select("text", "label").mapInArrow(phrases, "phrase string, p long, n long")
            .groupBy("phrase").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
            .where("p = 0 and n >= 2").collect())
    return tuple(sorted(r.phrase for r in rows))


def _learn_curve(sample: DataFrame, lexicon: Lexicon) -> None:
    """Logistic curve of the density, by Newton steps with a small ridge."""
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)

    def densities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [shared.value.density(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column(1).cast(pa.int32()), batch.column(2).cast(pa.float64())],
                                             names=["x", "label", "weight"])

    # At most MAX_TOXIC + MAX_CLEAN rows, grouped by their rounded density.
    rows = (sample.select("text", "label", "weight").mapInArrow(densities, "x double, label int, weight double")
            .groupBy(F.round("x", 2).alias("x"), "label").agg(F.sum("weight").alias("w")).orderBy("x", "label").collect())
    x = np.array([[1.0, r.x] for r in rows])
    y, w = np.array([r.label for r in rows], float), np.array([r.w for r in rows])
    beta = np.zeros(2)
    ridge = np.diag([1e-3, 1e-2])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (w * (y - p)) - ridge @ beta)
        beta += np.clip(step, -3, 3)
    lexicon.offset, lexicon.slope = float(beta[0]), float(max(0.0, beta[1]))


MATCHES = "array<struct<start:int,end:int,term:string,weight:double>>"


def scan(docs: DataFrame, lexicon: Lexicon, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, score (0 to 1) and matches (original code points) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    q = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    schema = q.select(id_col, F.lit(0.0).alias("score"), F.array().cast(MATCHES).alias("matches")).schema
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("term", pa.string()), ("weight", pa.float64())]))

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = shared.value
        for batch in pieces(batches):
            texts = batch.column(1).to_pylist()
            hits = [[dict(zip(("start", "end", "term", "weight"), h)) for h in lex.matches(t)] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([lex.score(t) if h else lex.score("") for t, h in zip(texts, hits)], pa.float64()),
                 pa.array(hits, kind)], names=[id_col, "score", "matches"])

    return q.mapInArrow(one, schema)


def drop_toxic(docs: DataFrame, lexicon: Lexicon, *, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows that score below ``threshold``, all columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield batch.filter(pa.array([shared.value.score(t) < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
