"""Periodic runs of words: seed-and-extend along the diagonals of a text.

A run is a maximal stretch of consecutive words with smallest period q (words q
apart are equal) of at least ``max(MIN_LENGTH, MIN_EXPONENT * q)`` words.  Words
are those between ASCII whitespace, compared byte for byte by 64-bit hashes.

On diagonal (lag) q such a run matches itself over at least
``max(MIN_LENGTH - q, (MIN_EXPONENT - 1) * q)`` words, 16 or more with the defaults.
So every run holds a pair of equal k-grams at lag q for any k up to that
overlap.  Lags are taken by scales: lags up to 16 are seeded by 16-grams, lags
in (k/2, k] by k-grams, k = 32, 64, and so on; the grams' hashes double from one scale
to the next.  A gram no shorter than the smallest period recurs first exactly one
period later, hence the pairs of *next* occurrences hold every run, and a gram
that occurs m times gives m - 1 pairs, never m * m.  Pairs are walked by lag and
place; a table of the furthest word covered on each lag skips seeds inside a
stretch that is already extended, and what is left is verified word for word and
extended both ways.  The work is O(n log n) for each of at most log2(n) scales.

Everything is inside one text, so the job is one pass over the table without a
shuffle; a task holds a slice of about 1 MB (or one longer text) at a time.

Null and empty texts have no words and no runs.  Repeated rows and null ids are
rows of their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import WHITESPACE, Words, batches_of, mix, words

#: A run has at least so many words and so many periods.
MIN_LENGTH, MIN_EXPONENT = 24, 3
#: Words of the shortest grams: the overlap that lags up to 8 guarantee.
SEED = 16

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_SPACES = np.zeros(256, bool)
_SPACES[list(WHITESPACE)] = True


def _grams(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of twice as long grams, from those of ``size`` words."""
    return mix(h[:-size] * _A + h[size:] * _B + _C) if len(h) > size else h[:0]


def _matching(x: np.ndarray, y: np.ndarray) -> int:
    """How many leading elements of the two are equal, compared in growing chunks."""
    n, at, step = min(len(x), len(y)), 0, 64
    while at < n:
        end = min(n, at + step)
        apart = np.flatnonzero(x[at:end] != y[at:end])
        if len(apart):
            return at + int(apart[0])
        at, step = end, 2 * step
    return n


def _seeds(gram: np.ndarray, size: int, least: int, text: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lag, place) of the pairs of next occurrences with a lag in (least, size], ascending."""
    n = np.diff(off)
    at = np.flatnonzero((n >= MIN_EXPONENT * (least + 1))[text[:len(gram)]])
    at = at[at + size <= off[text[at] + 1]]
    key = mix(gram[at] + _C * text[at].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    lag = at[1:] - at[:-1]
    use = (key[1:] == key[:-1]) & (lag > least) & (lag <= size) & (text[at[1:]] == text[at[:-1]])
    lag, at = lag[use], at[:-1][use]
    order = np.lexsort((at, lag))
    return lag[order], at[order]


def find_runs(h: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of every run of a slice, by text, start and period.

    ``h`` holds the words' hashes, ``off`` the first word of each text and the end.
    """
    found: list[tuple[int, int, int, int]] = []
    n = np.diff(off)
    if not len(n) or n.max() < MIN_LENGTH:
        return found
    text = np.repeat(np.arange(len(n)), n)
    gram, size = h, 1
    while size < SEED:
        gram, size = _grams(gram, size), 2 * size
    least = 0
    while n.max() >= MIN_EXPONENT * (least + 1):
        covered: dict[int, int] = {}
        lags, places = _seeds(gram, size, least, text, off)
        # Seeds in a row on one lag are one stretch; the table is asked once for each.
        first = np.flatnonzero(np.append(True, (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1))) if len(lags) else []
        last = np.append(first[1:], len(lags)) - 1 if len(lags) else []
        for a, b in zip(first, last):
            lag, start, end = int(lags[a]), int(places[a]), int(places[b]) + size
            if end <= covered.get(lag, -1):
                continue
            lo, hi = int(off[text[start]]), int(off[text[start] + 1])
            if not np.array_equal(h[start:end], h[start + lag:end + lag]):
                continue
            start -= _matching(h[lo:start][::-1], h[lo + lag:start + lag][::-1])
            end += _matching(h[end:hi - lag], h[end + lag:hi])
            covered[lag] = end
            length = end - start + lag
            if length >= max(MIN_LENGTH, MIN_EXPONENT * lag):
                found.append((int(text[start]), start - lo, length, lag))
        least = size
        gram, size = _grams(gram, size), 2 * size
    return sorted(found)


def collapsed(w: Words, runs: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts with one period of each run, words joined by one space."""
    n = len(w.start)
    gone = np.zeros(n + 1, np.int64)
    for text, start, length, period in runs:
        gone[w.off[text] + start + period] += 1
        gone[w.off[text] + start + length] -= 1
    kept = np.flatnonzero(np.cumsum(gone[:n]) == 0)
    text = np.searchsorted(w.off, kept, "right") - 1
    # A word brings the whitespace after it along, but for the last of a text.
    apart = np.append(text[1:] == text[:-1], False) if len(kept) else np.empty(0, bool)
    edge = np.zeros(len(w.data) + 1, np.int64)
    np.add.at(edge, w.start[kept], 1)
    np.add.at(edge, w.end[kept] + apart, -1)
    use = np.cumsum(edge[:-1]) > 0
    out = np.where(_SPACES[w.data], np.uint8(32), w.data)[use]
    return out, np.concatenate(([0], np.cumsum(use)))[w.text_off]


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_words, runs (start, length, period; by start, then period) and
    collapsed, the text in which every run keeps its first period only."""
    q = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    runs = "array<struct<start: bigint, length: bigint, period: bigint>>"
    schema = q.select(q[id_col], F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(runs).alias("runs"),
                      F.lit("").alias("collapsed")).schema

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in batches_of(batch, "_text"):
                w = words(data, off, fold=False)
                found = find_runs(w.hash, w.off)
                per = np.searchsorted([x[0] for x in found], np.arange(len(off))).astype(np.int32)
                fields = [pa.array([x[k] for x in found], pa.int64()) for k in (1, 2, 3)]
                lists = pa.ListArray.from_arrays(pa.array(per), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
                text, at = collapsed(w, found)
                texts = pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(text.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(w.off), pa.int64()), lists, texts.cast(pa.string())],
                    names=[id_col, "n_words", "runs", "collapsed"])

    return q.mapInArrow(one, schema)


def strongest(runs: Column) -> Column:
    """The run of greatest exact length / period; ties: least start, then period; null if none."""
    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)
    return F.aggregate(runs, F.get(runs, F.lit(-1)), better)


def repeated_tail(text: Column, key: Column) -> Column:
    """A test text with a planted run: of one key in ten, words from place ``a`` on
    repeat with a period, both taken from the key's crc32."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / F.lit(10))
    w = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    x = F.struct(w.alias("w"), F.size(w).cast("long").alias("n"), g.alias("g"))

    def planted(x: Column) -> Column:
        a = F.pmod(x["g"], x["n"])
        p = F.lit(1) + F.floor((x["n"] - a) / (F.lit(3) + F.pmod(x["g"], F.lit(8))))
        place = F.transform(F.sequence(F.lit(0).cast("long"), x["n"] - 1),
                            lambda i: F.get(x["w"], F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")))
        return F.when(x["n"] > 0, F.array_join(place, " ")).otherwise(text)

    return F.when(F.pmod(h, F.lit(10)) == 0, F.get(F.transform(F.array(x), planted), F.lit(0))).otherwise(text)
