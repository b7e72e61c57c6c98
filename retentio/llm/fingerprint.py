"""Document fingerprints: a quartile bucket digest of byte triplets.

Every triplet of consecutive UTF-8 bytes is hashed to one of ``BUCKETS``
buckets and counted.  A bucket's code (0 to 3) tells in which quartile of the
document's own bucket counts it lies; the digest is the hexadecimal text of a
checksum byte, a logarithmic length byte, the two quartile ratios and the
codes, two bits each.  Two digests are compared by a difference score that is
bounded; likeness is 1 minus the score's share of the bound.

Null and empty texts (and texts under three bytes) have all counts 0; their
digests differ in length and checksum alone.  Equal texts have equal digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored
from .text import slices, utf8

BUCKETS = 256
#: A digest has this many hexadecimal characters.
DIGEST_CHARS = 8 + BUCKETS // 2
#: The difference score is capped here: unrelated texts reach it.
BOUND = 160.0

_rng = np.random.Generator(np.random.PCG64(7))
_T = [_rng.permutation(256).astype(np.uint8) for _ in range(4)]


def bucket_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Triplet counts per text (rows) and bucket (columns)."""
    n = len(off) - 1
    counts = np.zeros((n, BUCKETS), np.int64)
    if len(data) < 3:
        return counts
    h = _T[3][_T[0][data[:-2]] ^ _T[1][data[1:-1]]] ^ _T[2][data[2:]]
    for k in range(n):
        a, b = off[k], off[k + 1] - 2
        if b > a:
            counts[k] = np.bincount(h[a:b], minlength=BUCKETS)
    return counts


def _length_code(n: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.round(np.log1p(n) / np.log(1.1))).astype(np.uint8)


def digests(data: np.ndarray, off: np.ndarray) -> list[str]:
    """Digest of every text."""
    n = len(off) - 1
    if not n:
        return []
    c = bucket_counts(data, off)
    ordered = np.sort(c, axis=1)
    q1, q2, q3 = (ordered[:, BUCKETS * k // 4 - 1] for k in (1, 2, 3))
    codes = ((c > q1[:, None]).astype(np.uint8) + (c > q2[:, None]) + (c > q3[:, None])).astype(np.uint8)
    packed = codes[:, 0::4] << 6 | codes[:, 1::4] << 4 | codes[:, 2::4] << 2 | codes[:, 3::4]
    out = np.empty((n, 4 + BUCKETS // 4), np.uint8)
    total = np.concatenate(([0], np.cumsum(data, dtype=np.int64)))
    out[:, 0] = (total[off[1:]] - total[off[:-1]]) % 251
    out[:, 1] = _length_code(np.diff(off))
    top = np.maximum(q3, 1)
    out[:, 2] = np.minimum(255, q1 * 255 // top)
    out[:, 3] = np.minimum(255, q2 * 255 // top)
    out[:, 4:] = packed
    return [row.tobytes().hex() for row in out]


def _codes(digest: np.ndarray) -> np.ndarray:
    return np.stack([digest[:, 4:] >> s & 3 for s in (6, 4, 2, 0)], axis=2).reshape(len(digest), -1).astype(np.int16)


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """1 for equal digests down to 0 where the difference reaches ``BOUND``.

    Difference: steps between bucket codes (a step of three counts six, as
    the buckets swapped ends), the steps of the length byte beyond one (at
    most 12), the quartile ratios' steps in sixteenths, and one for the
    checksum.
    """
    if not left:
        return np.empty(0)
    a, b = (np.frombuffer(bytes.fromhex("".join(x)), np.uint8).reshape(len(x), -1) for x in (left, right))
    step = np.abs(_codes(a) - _codes(b))
    diff = (step + 3 * (step == 3)).sum(axis=1).astype(float)
    head = np.abs(a[:, 1:4].astype(np.int16) - b[:, 1:4])
    diff += np.minimum(12, np.maximum(0, head[:, 0] - 1)) + head[:, 1] / 16 + head[:, 2] / 16
    diff += a[:, 0] != b[:, 0]
    return np.maximum(0.0, 1.0 - diff / BOUND)


def fingerprints(arr: pa.Array) -> list[str]:
    """Digests of a string array; null counts as empty."""
    data, off = utf8(arr)
    out: list[str] = []
    for i, j in slices(data, off):
        out += digests(data[off[i]:off[j]], off[i:j + 1] - off[i])
    return out


def add_fingerprint(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``docs`` with the digest of ``text_col``; a column of that name is replaced."""
    docs = docs.drop(out_col)
    at = docs.columns.index(text_col)
    schema = docs.withColumn(out_col, F.lit("").cast("string")).schema

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fingerprints(batch.column(at)), pa.string())],
                                             names=[*batch.schema.names, out_col])

    return docs.mapInArrow(one, schema)


_CHUNK = 256
_RESULT = {"n_chars": "long", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string",
           "near_edited": "double", "near_next": "double"}


def _ordered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) in partitions by descending id, sorted; equal ids go by a hash of the text, so
    neither many null ids nor repeated ones fall into one partition."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("tie", F.xxhash64("text"))
    n = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("id").desc_nulls_last(), F.col("tie")]
    return d.repartitionByRange(n, *order).sortWithinPartitions(*order, "text").select("id", "text")


def edit(text: str, following: str) -> str:
    """The last third of the code points replaced by the start of ``following``."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def edit_likeness(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and two likenesses.

    The next document is the next lower id, whatever the ids' type (after the last,
    the first); null ids come last, ties go by a hash of the text.  Null counts as the empty
    text.  Returns ``id_col``, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The rows are range-partitioned by id.  A task answers for all rows but its last, and hands
    on its first and last text; these, two a partition, are joined with those of the next
    partition in a second, small step.
    """
    extra = {"part": "int", "first": "string", "last": "string"}
    schema = docs.select(F.col(id_col).alias("id"), *[F.lit(None).cast(t).alias(c) for c, t in {**_RESULT, **extra}.items()]).schema
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}

    def answers(own: list[str], following: list[str], mine: list[str], others: list[str]) -> list[pa.Array]:
        edited = [edit(a, b) for a, b in zip(own, following)]
        changed = fingerprints(pa.array(edited, pa.string()))
        values = [[len(t) for t in own], [hashlib.sha256(e.encode()).hexdigest() for e in edited], mine, changed,
                  likeness(mine, changed), likeness(mine, others)]
        return [pa.array(v, kinds[t]) for v, t in zip(values, _RESULT.values())]

    def emit(ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        prints = fingerprints(pa.array(texts, pa.string()))
        cols = [ids, *answers(texts[:-1], texts[1:], prints[:-1], prints[1:]), *[pa.nulls(len(ids), kinds[t]) for t in extra.values()]]
        return pa.RecordBatch.from_arrays(cols, names=schema.names)

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, last_id = None, None, None
        for batch in batches:
            for k in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(k, _CHUNK)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = part.column(0)
                if last_id is not None:
                    texts, ids = [last, *texts], pa.concat_arrays([last_id, ids])
                else:
                    first = texts[0]
                if len(texts) > 1:
                    yield emit(ids[:-1], texts)
                last, last_id = texts[-1], ids[-1:]
        if last_id is not None:
            edge = [pa.array([v], kinds[t]) for v, t in zip((TaskContext.get().partitionId(), first, last), extra.values())]
            yield pa.RecordBatch.from_arrays([last_id, *[pa.nulls(1, kinds[t]) for t in _RESULT.values()], *edge], names=schema.names)

    done = stored(_ordered(docs, id_col, text_col).mapInArrow(one, schema))
    edges = done.where("part is not null")
    w = Window.orderBy("part")  # a number for each partition
    follow = edges.select("part", F.coalesce(F.lead("part").over(w), F.min("part").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("to"))
    pairs = (edges.select("id", "part", "last").join(follow, "part").join(edges.select(F.col("part").alias("to"), F.col("first").alias("following")), "to")
             .select("id", "last", "following"))
    rest = docs.select(F.col(id_col).alias("id"), *[F.lit(None).cast(t).alias(c) for c, t in _RESULT.items()]).schema

    def border(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, following = ([t or "" for t in batch.column(k).to_pylist()] for k in (1, 2))
            prints = [fingerprints(pa.array(x, pa.string())) for x in (own, following)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *answers(own, following, *prints)], names=rest.names)

    out = done.where("part is null").select("id", *_RESULT).unionByName(pairs.mapInArrow(border, rest))
    return out.withColumnRenamed("id", id_col)
