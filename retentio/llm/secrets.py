"""Secret scans: rules, and Markov models of random strings and identifiers.

Three rules give the base spans, leftmost and non-overlapping per kind.  The
method adds spans of kind ``random``.  A run of characters that secrets are
written in, less the base spans in it, leaves pieces of ``SHORTEST`` characters or
more.  A piece of ``MIN_CHARS`` is reported whole where a character Markov model of
random strings explains it better than one of ordinary identifiers by at least
``threshold`` nats a character.  Of any other piece the stretches are reported by
whose characters random wins by ``total`` nats or more in sum, however long the
ordinary rest is, widened to the next ``/``, ``=``, ``_`` or ``-`` and less the
ordinary words between such characters at either end.

Both models are first-order tables over the same fixed alphabet, counted in
Spark from labelled samples (text, label): 1 random, 0 ordinary.  Their size
is the alphabet squared whatever the corpus.

Null counts as the empty text; a text without candidates has no spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
_KEYS = ("passw", "secret", "token", "api_key", "apikey")

#: Characters of a candidate; also the Markov models' alphabet.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
MIN_CHARS = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_CHARS)
#: Nats a character by which random must beat ordinary.
THRESHOLD = 0.3
#: Characters of a piece at least, and nats in sum by which random must win in a stretch of it.
SHORTEST = 8
TOTAL = 10.0
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
#: Documents sampled for the ordinary strings, at most, and random strings drawn.
SAMPLE_DOCS = 5_000
SAMPLE_RANDOM = 4_000

_CODE = np.full(256, len(ALPHABET), np.uint8)
_CODE[list(ALPHABET.encode())] = np.arange(len(ALPHABET), dtype=np.uint8)
_SIZE = len(ALPHABET) + 1  # one more: border or any other character


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the rules' matches, by start, then kind."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYS):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    out += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def labelled_samples(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(text, label) samples for ``fit``.

    Ordinary: every candidate-like run of four or more characters of a
    bounded sample of documents that the rules leave alone.  Random: the values the rules find there,
    and strings drawn from base64, base62, capital and hexadecimal digits by
    a keyed digest (the same on every run).
    """
    spark: SparkSession = docs.sparkSession
    n = max(1, docs.count())
    h = F.pmod(F.xxhash64(F.lit("secrets"), F.col(id_col)), F.lit(1_000_000))
    part = docs.where(h < int(1_000_000 * min(1.0, SAMPLE_DOCS / n)) + 1).select(F.col(text_col).cast("string").alias("text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(r"[A-Za-z0-9+/_=-]{4,}")
        for batch in batches:
            text, label = [], []
            for t in batch.column(0).to_pylist():
                spans = base_spans(t or "")
                covered = [(a, b) for a, b, _ in spans]
                for a, b, kind in spans:
                    m = ASSIGN.match(t, a) if kind == "assign" else None
                    text.append(m[2] if m else t[a:b])
                    label.append(1)
                for m in runs.finditer(t or ""):
                    if not any(a < m.end() and m.start() < b for a, b in covered):
                        text.append(m[0])
                        label.append(0)
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()), pa.array(label, pa.int32())], names=["text", "label"])

    found = part.mapInArrow(split, "text string, label int")
    digest = F.sha2(F.concat(F.lit("random"), F.col("id").cast("string")), 512)
    b64 = F.substring(F.base64(F.unhex(digest)), 1, 40)
    drawn = spark.range(SAMPLE_RANDOM).select(
        F.when(F.col("id") % 4 == 0, b64)
        .when(F.col("id") % 4 == 1, F.regexp_replace(b64, "[+/=]", ""))
        .when(F.col("id") % 4 == 2, F.upper(F.regexp_replace(b64, "[+/=]", "")))
        .otherwise(F.substring(digest, 1, 40)).alias("text"), F.lit(1).alias("label"))
    return found.unionByName(drawn)


def fit(samples: DataFrame) -> np.ndarray:
    """Log-likelihood ratios of the transitions, random over ordinary.

    Transition counts are summed per partition before anything is shuffled;
    each partition sends two tables of fixed size.  Add-half smoothing.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, _SIZE * _SIZE), np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text and label in (0, 1):
                    total[label] += np.bincount(transitions(text), minlength=_SIZE * _SIZE)
        label, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(label.astype(np.int32)), pa.array(at.astype(np.int32)),
                                          pa.array(total[label, at])], names=["label", "at", "n"])

    rows = (samples.select("text", F.col("label").cast("int").alias("label")).mapInArrow(count, "label int, at int, n long")
            .groupBy("label", "at").agg(F.sum("n").alias("n")).collect())
    counts = np.full((2, _SIZE * _SIZE), 0.5)
    for r in rows:
        counts[r.label, r.at] += r.n
    counts = counts.reshape(2, _SIZE, _SIZE)
    log = np.log(counts / counts.sum(axis=2, keepdims=True))
    return (log[1] - log[0]).ravel()


def transitions(text: str) -> np.ndarray:
    """Indices into the table of transitions, the border before the first included."""
    code = _CODE[np.frombuffer(text.encode("ascii", "replace"), np.uint8)].astype(np.int64)
    return np.concatenate(([_SIZE - 1], code[:-1])) * _SIZE + code


def stretches(score: np.ndarray, total: float) -> list[tuple[int, int]]:
    """Disjoint stretches whose scores sum to ``total`` or more, each up to its highest sum."""
    out, start, end, upto, best = [], 0, 0, 0.0, 0.0
    for k, x in enumerate([*score.tolist(), -np.inf]):
        upto += x
        if upto > best:
            best, end = upto, k + 1
        if upto <= 0 or upto <= best - total:
            if best >= total:
                out.append((start, end))
            start, end, upto, best = k + 1, k + 1, 0.0, 0.0
    return out


def _likely(text: str, ratios: np.ndarray, total: float) -> np.ndarray:
    """Offsets at which some stretch of a run has reached ``total``."""
    at = transitions(text)
    score = np.where(at % _SIZE == _SIZE - 1, -1e4, ratios[at])
    upto = np.concatenate(([0.0], np.cumsum(score)))
    return np.flatnonzero(upto[1:] - np.minimum.accumulate(upto)[:-1] >= total - 1e-3)


def _random_in(text: str, a: int, b: int, ratios: np.ndarray, threshold: float, total: float) -> list[tuple[int, int, str]]:
    """The random spans of a piece."""
    score = ratios[transitions(text[a:b])]
    if b - a >= MIN_CHARS and score.sum() >= threshold * (b - a):
        return [(a, b, "random")]
    out: list[tuple[int, int, str]] = []
    for x, y in stretches(score, total):
        x, y = a + x, a + y
        while x > a and text[x - 1] not in "/=_-":
            x -= 1
        while y < b and text[y] not in "/=_-":
            y += 1
        words = [m.span() for m in re.finditer(r"[^/=_-]+", text[x:y])]
        plain = [score[x - a + i:x - a + j].sum() <= 0 for i, j in words]
        if not all(plain):
            x, y = x + words[plain.index(False)][0], x + words[len(plain) - 1 - plain[::-1].index(False)][1]
        if out and x < out[-1][1]:
            x = out.pop()[0]
        if y - x >= SHORTEST:
            out.append((x, y, "random"))
    return out


def added_spans(text: str, base: list[tuple[int, int, str]], ratios: np.ndarray, threshold: float, total: float = TOTAL
                ) -> list[tuple[int, int, str]]:
    """What the models call random in the runs, beside the base spans."""
    out: list[tuple[int, int, str]] = []
    if not text:
        return out
    likely = _likely(text, ratios, total)
    for m in (RUN if len(likely) or base else CANDIDATE).finditer(text):
        a, b = m.span()
        covered = [s for s in base if s[0] < b and a < s[1]]
        if not covered and b - a < MIN_CHARS:
            k = np.searchsorted(likely, a)
            if k == len(likely) or likely[k] >= b:
                continue
        for x, y, _ in sorted(covered):
            if x - a >= SHORTEST:
                out += _random_in(text, a, x, ratios, threshold, total)
            a = max(a, y)
        if b - a >= SHORTEST:
            out += _random_in(text, a, b, ratios, threshold, total)
    return out


def scan(docs: DataFrame, ratios: np.ndarray, *, threshold: float = THRESHOLD, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``id_col`` and spans: array of (start, end, kind) by start, then kind.

    Offsets are code points, ends exclusive.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ratios)
    out = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    schema = out.select(id_col, F.array().cast("array<struct<start:int,end:int,kind:string>>").alias("spans")).schema
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                spans = base + added_spans(text or "", base, shared.value, threshold)
                spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
                found.append([{"start": a, "end": b, "kind": k} for a, b, k in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=[id_col, "spans"])

    return out.mapInArrow(one, schema)
