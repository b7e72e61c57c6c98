"""Vectorised text helpers for Arrow batches.

The functions work on the UTF-8 bytes of a whole batch at once, so a task
holds one slice of at most ``SLICE_BYTES`` (or one longer text) beside its
Arrow batch and never a Python string per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
#: Rows of a batch that are Python objects at a time.
PIECE_ROWS = 256

#: ASCII space, tab, newline, vertical tab, form feed, carriage return.
WHITESPACE = bytes([0x20, *range(0x09, 0x0E)])
#: Every ASCII byte but digits and small letters (after lower-casing).
NOT_ALNUM = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (two multiply-xorshift rounds)."""
    h = h ^ (h >> _S33)
    h = h * _M1
    h ^= h >> _S33
    h *= _M2
    h ^= h >> _S33
    return h


def _byte_codes(seed: int, separators: bytes, fold: bool = True) -> np.ndarray:
    """A random odd 64-bit code per byte, separators 0; with ``fold`` A-Z count as a-z."""
    t = np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, 256, dtype=np.uint64)
    t = t * np.uint64(2) + np.uint64(1)
    if fold:
        t[65:91] = t[97:123]
    t[list(separators)] = 0
    return t


_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POW = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for k, base in enumerate((_BASE, _BASE_INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POW[k] = np.multiply.accumulate(p)
    return _POW[0][:n], _POW[1][:n]


@dataclass
class Words:
    """Words of a slice: byte spans, their hashes, and word offsets per text."""

    data: np.ndarray     # bytes of all texts of the slice
    text_off: np.ndarray  # byte offset of each text, one more than texts
    start: np.ndarray    # first byte of each word
    end: np.ndarray      # byte after each word
    hash: np.ndarray     # 64-bit hash of the lower-cased word
    off: np.ndarray      # first word of each text, one more than texts


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null counts as empty."""
    arr = arr.fill_null("").cast(pa.large_string())
    if not len(arr):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    buf = arr.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(data: np.ndarray, off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts holding about ``limit`` bytes (one text at least)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def segments(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of true bytes that do not cross a text border: starts and ends."""
    n = len(mask)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = mask[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = mask[1:]
    starts = np.flatnonzero(mask & (~before | edge[:-1]))
    ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
    return starts, ends


_CODES: dict[tuple[int, bytes, bool], np.ndarray] = {}


def words(data: np.ndarray, off: np.ndarray, separators: bytes = WHITESPACE, seed: int = 1, fold: bool = True) -> Words:
    """Split texts at ``separators`` and hash each word, A-Z lower-cased unless ``fold`` is off."""
    codes = _CODES.setdefault((seed, separators, fold), _byte_codes(seed, separators, fold))
    off = off - off[0]
    value = codes[data]
    start, end = segments(value != 0, off)
    if len(start):
        pw, inv = _powers(len(data))
        h = np.add.reduceat(value * pw, start) * inv[start]
        h = mix(h + (end - start).astype(np.uint64))
    else:
        h = np.empty(0, np.uint64)
    return Words(data, off, start, end, h, np.searchsorted(start, off, "left"))


def batches_of(table: pa.RecordBatch, column: str, limit: int = SLICE_BYTES
               ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Sub-batches with the bytes and offsets of ``column``."""
    data, off = utf8(table.column(table.schema.get_field_index(column)))
    for i, j in slices(data, off, limit):
        yield table.slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i]


def pieces(batches: Iterator[pa.RecordBatch], rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in parts of ``rows`` rows, for code that makes Python objects of all texts of a batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def char_starts(raw: bytes) -> np.ndarray:
    """Byte offset of each code point, and the length."""
    b = np.frombuffer(raw, np.uint8)
    return np.append(np.flatnonzero((b & 0xC0) != 0x80), len(b))
