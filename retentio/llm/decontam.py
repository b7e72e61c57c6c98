"""Benchmark decontamination: one Aho-Corasick automaton over test items.

Questions and answers are normalised to word sequences (A-Z lower-cased;
a word is a run of digits, a-z and non-ASCII characters) and cut into windows
of ``window`` consecutive words; an item with fewer words, but not none, is
one window.  The automaton's alphabet is the items' vocabulary, so every
document is scanned once, word by word, and unknown words reset it.  Hits are
mapped back to code point offsets of the original text.

The items are the stated query set.  They go to the executors in blocks of at
most ``BLOCK_WORDS`` words (a single longer item makes a block of its own);
one block is the usual case, and each further block is one more narrow pass
over the documents, so nothing is shuffled and no document is cut.

Null or empty texts have no words and no hits; items without words match
nothing; repeated documents are scanned each; repeated items count by their
distinct ids.  An empty item table leaves every document clean.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut
from .text import NOT_ALNUM, pieces

WINDOW = 10
BLOCK_WORDS = 200_000
#: Passes between two checkpoints when the items need many blocks.
PASSES = 4

HIT = "struct<item_id:string,start:int,end:int>"
_FOLD = bytes(0x20 if b in NOT_ALNUM else b + 32 if 65 <= b <= 90 else b for b in range(256))


def normal_words(text: str | None) -> list[bytes]:
    """The normalised words of a text, as UTF-8."""
    return text.encode().translate(_FOLD).split() if text else []


class Matcher:
    """Automaton over the windows of (item id, text) pairs."""

    def __init__(self, items: list[tuple[str, str | None]], window: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in normal_words(text))
            for k in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(ids[k:k + window], set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, who in owners.items():
            self.automaton.add_word(key, (len(key), sorted(who)))
        self.empty = not owners
        if owners:
            self.automaton.make_automaton()

    def find(self, words: list[bytes]) -> list[tuple[int, int, list[str]]]:
        """Occurring windows: first word, word after the last, item ids."""
        if self.empty or not words:
            return []
        get = self.vocabulary.get
        ids = tuple([get(w, 0) for w in words])
        return [(e + 1 - n, e + 1, who) for e, (n, who) in self.automaton.iter(ids)]


def word_spans(text: str) -> np.ndarray:
    """Code point span of every normalised word."""
    raw = text.encode()
    b = np.frombuffer(raw.translate(_FOLD), np.uint8)
    inside = np.concatenate(([False], b != 0x20, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    points = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    points = np.concatenate(([0], points))
    return points[edges].reshape(-1, 2)


def passages(text: str, found: list[tuple[int, int, list[str]]]) -> list[dict]:
    """Overlapping or touching windows of an item joined, in the original's offsets."""
    if not found:
        return []
    spans = word_spans(text)
    runs: dict[str, list[list[int]]] = {}
    for a, b, who in sorted(found, key=lambda x: x[:2]):
        for item in who:
            own = runs.setdefault(item, [])
            if own and a <= own[-1][1]:
                own[-1][1] = max(own[-1][1], b)
            else:
                own.append([a, b])
    return [{"item_id": item, "start": int(spans[a, 0]), "end": int(spans[b - 1, 1])}
            for item in sorted(runs) for a, b in runs[item]]


def covered(n: int, found: list[tuple[int, int, list[str]]]) -> np.ndarray:
    """Which of ``n`` words lie inside an occurring window."""
    step = np.zeros(n + 1, np.int64)
    for a, b, _ in found:
        step[a] += 1
        step[b] -= 1
    return np.cumsum(step[:-1]) > 0


_MATCHERS: dict[int, Matcher] = {}


def _matcher(items: list[tuple[str, str | None]], window: int) -> Matcher:
    """One automaton per Python worker and block."""
    key = zlib.crc32(repr((items, window)).encode())
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(items, window)
    return _MATCHERS[key]


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str, str | None]]]:
    """The items in blocks of bounded size, each small enough to broadcast; one at a time is read."""
    q = items.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))
    total = q.agg(F.sum(F.length("t") / 2)).first()[0] or 0
    n = max(1, math.ceil(total / BLOCK_WORDS))
    if n > 1:  # written by block, so that reading one does not read the others' texts again and again
        q = cut(q.repartition(n, F.pmod(F.xxhash64("i"), F.lit(n))))
    for k in range(n):
        block = sorted(((r.i, r.t) for r in q.where(F.pmod(F.xxhash64("i"), F.lit(n)) == k).collect()), key=repr)
        if block:
            yield block


def _each_block(df: DataFrame, items: DataFrame, item_id: str, item_text: str, step) -> DataFrame:
    """``step(df, shared block)`` for one block of items after the other.

    After ``PASSES`` blocks the frame is written and their broadcasts are given back, so the driver and the
    executors hold a bounded part of the items at any time.
    """
    held, some = [], False
    for block in item_blocks(items, item_id, item_text):
        if len(held) == PASSES:
            df = cut(df)
            for old in held:
                old.unpersist()
            held = []
        held.append(df.sparkSession.sparkContext.broadcast(block))
        df, some = step(df, held[-1]), True
    return df if some else step(df, df.sparkSession.sparkContext.broadcast([]))


def scan(docs: DataFrame, items: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id",
         text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Hits of every document: ``id_col``, n_words, n_hit, hits.

    ``hits`` lists (item_id, start, end) passages in code points of the
    original, by item (as string) and start.  n_hit counts the words inside
    any passage of any item.
    """
    out = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"),
                      F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                      F.lit(None).cast("binary").alias("mask"),
                      F.array().cast(f"array<{HIT}>").alias("hits"))
    schema = out.schema

    def step(df: DataFrame, shared) -> DataFrame:
        def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = _matcher(shared.value, window)
            for batch in pieces(batches):
                n, n_hit, masks, hits = [], [], [], []
                for text, old, has in zip(*(batch.column(c).to_pylist() for c in (1, 4, 5))):
                    words = normal_words(text)
                    found = m.find(words)
                    if found:
                        bits = np.packbits(covered(len(words), found))
                        old = (bits | np.frombuffer(old, np.uint8) if old else bits).tobytes()
                        has = has + passages(text, found)
                    n.append(len(words))
                    n_hit.append(int(np.unpackbits(np.frombuffer(old, np.uint8)).sum()) if old else 0)
                    masks.append(old)
                    hits.append(has)
                s = batch.schema
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(n_hit, pa.int64()),
                     pa.array(masks, s.field(4).type), pa.array(hits, s.field(5).type)], schema=s)

        return df.mapInArrow(one, schema)

    out = _each_block(out, items, item_id, item_text, step)
    return out.select(id_col, "n_words", "n_hit", F.array_sort("hits").alias("hits"))


def drop_contaminated(docs: DataFrame, items: DataFrame, *, window: int = WINDOW,
                      text_col: str = "text", item_id: str = "item_id",
                      item_text: str = "text") -> DataFrame:
    """The documents without any occurring window, all columns and rows as they were."""
    at = docs.columns.index(text_col)

    def step(df: DataFrame, shared) -> DataFrame:
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = _matcher(shared.value, window)
            for batch in pieces(batches):
                yield batch.filter(pa.array([not m.find(normal_words(t))
                                             for t in batch.column(at).to_pylist()], pa.bool_()))

        return df.mapInArrow(keep, docs.schema)

    return _each_block(docs, items, item_id, item_text, step)
