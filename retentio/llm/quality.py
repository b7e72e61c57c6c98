"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

A document's statistics (lengths, character shares, repetition of words,
shingles and lines) are standardised and mapped by random Fourier features,
which approximate a Gaussian kernel.  Every partition of the training rows
sums its part of the normal equations; the sums of fixed size are added up in
Spark and solved once.  The ridge scores are calibrated by isotonic regression
over bins of the training scores, so the result is a probability.

Training reads a bounded sample (``MAX_TRAIN`` labelled documents); scoring
covers every whole text.  Null counts as the empty text, whose statistics are
all 0.  Without labels of both kinds the score is the labels' mean (0.5
without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut
from .text import Words, batches_of, mix, segments, words

THRESHOLD = 0.7
MAX_TRAIN = 20_000
FEATURES = 256
RIDGE = 1e-2
BINS = 200
SEED = 11
#: Partitions in which the bounded training rows are summed.
PARTS = 12

NAMES = ("log_bytes", "log_words", "word_len", "word_len_spread", "upper", "digits", "signs", "stops", "foreign",
         "lines_per_word", "signed_words", "distinct_words", "top_word", "repeated_triples", "repeated_lines",
         "short_words", "exclaims", "pipes", "mean_line")

_KIND = np.zeros(256, np.uint8)  # 1 upper, 2 digit, 3 sign, 4 stop, 5 non-ASCII
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[list(b"#$%&*+/<=>@[\\]^_`{|}~!")] = 3
_KIND[list(b".,;:?'\"()-")] = 4
_KIND[128:] = 5


def _share(flag: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flag, dtype=np.int64)))
    return (total[off[1:]] - total[off[:-1]]) / np.maximum(1, np.diff(off))


def _repeats(values: np.ndarray) -> tuple[float, float]:
    """Share of repeated values, and of the most frequent one."""
    if not len(values):
        return 0.0, 0.0
    _, n = np.unique(values, return_counts=True)
    return 1 - len(n) / len(values), n.max() / len(values)


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of ``NAMES`` per text."""
    n = len(off) - 1
    w: Words = words(data, off)
    out = np.zeros((n, len(NAMES)))
    size, count = np.diff(off), np.diff(w.off)
    kind = _KIND[data]
    length = (w.end - w.start).astype(float)
    sums = np.concatenate(([0.0], np.cumsum(length)))
    squares = np.concatenate(([0.0], np.cumsum(length * length)))
    mean = (sums[w.off[1:]] - sums[w.off[:-1]]) / np.maximum(1, count)
    spread = np.sqrt(np.maximum(0, (squares[w.off[1:]] - squares[w.off[:-1]]) / np.maximum(1, count) - mean * mean))
    newline = data == 10
    ls, le = segments(~newline, off)
    lines = np.searchsorted(ls, off, "left")
    out[:, 0], out[:, 1], out[:, 2], out[:, 3] = np.log1p(size), np.log1p(count), mean, spread
    for k, col in ((1, 4), (2, 5), (3, 6), (4, 7), (5, 8)):
        out[:, col] = _share(kind == k, off)
    out[:, 9] = np.diff(lines) / np.maximum(1, count)
    if len(w.end):
        out[:, 10] = _share(kind[w.end - 1] == 3, w.off)
        out[:, 15] = _share(length <= 3, w.off)
    out[:, 16], out[:, 17] = _share(data == 33, off), _share(data == 124, off)
    out[:, 18] = np.log1p(count / np.maximum(1, np.diff(lines)))
    # A line's hash: the sum of its words' hashes at their places.
    place = mix(np.arange(len(w.hash), dtype=np.uint64) + np.uint64(1))
    for k in range(n):
        h = w.hash[w.off[k]:w.off[k + 1]]
        if not len(h):
            continue
        rep, top = _repeats(h)
        out[k, 11], out[k, 12] = 1 - rep, top
        if len(h) >= 3:
            out[k, 13] = _repeats(h[:-2] * np.uint64(3) + h[1:-1] * np.uint64(5) + h[2:] * np.uint64(7))[0]
        a = ls[lines[k]:lines[k + 1]]
        first = np.searchsorted(w.start[w.off[k]:w.off[k + 1]], a, "left")
        first = np.unique(first[first < len(h)])
        if len(first) > 1:
            at = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
            out[k, 14] = _repeats(np.add.reduceat(h * place[at], first))[0]
    return out


@dataclass
class Model:
    """Standardisation, random features, ridge weights and calibration steps."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    knots: tuple[np.ndarray, np.ndarray] | None = None
    default: float = 0.5

    def features(self, x: np.ndarray) -> np.ndarray:
        """Cosine features of the standardised statistics, and a constant."""
        rng = np.random.Generator(np.random.PCG64(SEED))
        d = x.shape[1]
        proj = rng.normal(0, 1 / np.sqrt(d), (d, FEATURES))
        phase = rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ proj + phase), np.ones((len(x), 1))])

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None or self.knots is None:
            return np.full(len(x), self.default)
        return np.round(np.clip(np.interp(self.ridge(x), *self.knots), 0, 1), 6)


def _stats_frame(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and the statistics as an array."""
    q = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))
    schema = q.select(*keep, F.array().cast("array<double>").alias("x")).schema

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in batches_of(batch, "_text"):
                x = statistics(data, off)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(list(x), pa.list_(pa.float64()))],
                                                 names=[*keep, "x"])

    return q.mapInArrow(one, schema)


def training_rows(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> DataFrame:
    """(x, label) of at most about MAX_TRAIN labelled documents.

    ``labels`` must hold only rows that may be learnt from.  Rows are chosen
    by a hash of the id; the chosen ids are bounded and broadcast.
    """
    lab = (labels.where(F.col(label_col).isin(0, 1))
           .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")))
    share = min(1.0, MAX_TRAIN / max(1, lab.count()))
    u = F.pmod(F.xxhash64(F.lit("quality"), "_id"), F.lit(1_000_000)) / 1_000_000
    chosen = F.broadcast(lab.where(u < share))
    q = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("string").alias("_t")).join(chosen, F.col("_doc") == F.col("_id"))
    return cut(_stats_frame(q, "_t", ["label"]))


def fit(rows: DataFrame) -> Model:
    """Ridge regression on (x, label) rows, and its calibration."""
    n = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(n.values())
    d = len(NAMES)
    if not n.get(0) or not n.get(1):
        return Model(np.zeros(d), np.ones(d), default=n.get(1, 0) / total if total else 0.5)
    m = rows.select(*[F.avg(F.col("x")[k]).alias(f"m{k}") for k in range(d)],
                    *[F.stddev_pop(F.col("x")[k]).alias(f"s{k}") for k in range(d)]).first()
    model = Model(np.array([m[k] for k in range(d)]), np.array([m[d + k] or 1.0 for k in range(d)]))
    model.weights = _solve(rows, model)
    model.knots = _isotonic(rows, model)
    return model


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), len(NAMES))


def _solve(rows: DataFrame, model: Model) -> np.ndarray:
    """Partition-summed normal equations: one triangle of fixed size per partition."""
    size = FEATURES + 1
    upper = np.triu_indices(size)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            if len(batch):
                z = model.features(_matrix(batch.column(0)))
                a += z.T @ z
                b += z.T @ batch.column(1).to_numpy().astype(float)
        flat = np.concatenate([a[upper], b])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["at", "v"])

    parts = rows.select("x", "label").repartition(PARTS).mapInArrow(sums, "at int, v double")
    got = {r["at"]: r.v for r in parts.groupBy("at").agg(F.sum("v").alias("v")).collect()}
    flat = np.array([got[k] for k in range(len(got))])
    a = np.zeros((size, size))
    a[upper] = flat[:-size]
    a = a + np.triu(a, 1).T
    return np.linalg.solve(a + RIDGE * np.eye(size), flat[-size:])


def _isotonic(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over about BINS bins of the training scores."""
    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([pa.array(model.ridge(_matrix(batch.column(0)))), batch.column(1).cast(pa.int32())],
                                                 names=["r", "label"])

    scored = rows.select("x", "label").mapInArrow(scores, "r double, label int")
    bins = (scored.groupBy(F.round(F.col("r") * BINS).alias("bin"))
            .agg(F.avg("r").alias("r"), F.avg("label").alias("y"), F.count("*").alias("n")).orderBy("bin").collect())
    blocks: list[list[float]] = []  # [sum of y, n, first r, last r]
    for b in bins:
        blocks.append([b.y * b.n, b.n, b.r, b.r])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            y, n, _, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + y, blocks[-1][1] + n, blocks[-1][2], last]
    at, value = [], []
    for y, n, first, last in blocks:
        for r in {first, last}:
            at.append(r)
            value.append(y / n)
    order = np.argsort(at, kind="stable")
    return np.array(at)[order], np.maximum.accumulate(np.array(value)[order])


def scan(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and score (0 to 1, higher: better) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    q = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    schema = q.select(id_col, F.lit(0.0).alias("score")).schema

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in batches_of(batch, "_text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(shared.value.score(statistics(data, off)))],
                                                 names=[id_col, "score"])

    return q.mapInArrow(one, schema)
