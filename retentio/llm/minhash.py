"""MinHash near-dedup with tensored banding.

A document's set is its distinct shingles of ``shingle`` consecutive words (A-Z
lower-cased, split at ASCII whitespace); a shorter text is one shingle, a text
without words has an empty set and is linked with nothing.  Two sets link where
100 * intersection >= ``percent`` * union; links are confirmed on full sets.

1. Equal sets are one class (64-bit ids).
2. Two collections of ``HALVES`` half keys are formed, each half key of ``WIDTH``
   minhashes.  A table's key is one half of the first collection with one of the
   second, so 2 * HALVES * WIDTH minhashes serve HALVES ** 2 tables instead of one
   each: with 8 and 2, 32 minhashes for 64 tables, where plain banding takes 256.
   Two sets of similarity J share a key unless all halves of one collection
   differ; at J = 0.85 that is 2 * (1 - 0.85 ** 2) ** 8, 7 in 100,000, at 0.9 it
   is 3 in a million (:func:`recall` gives the figure).
3. Classes that share a key with another are the members of its list.  Each list has
   a leader, chosen by one of HALVES orders of the classes, which is compared with
   the members first; a class of a large group so meets several leaders.  Then only
   members outside the component of their list's leader are compared with the
   others of the list, in the first list that a pair shares, and only where sizes,
   bucket counts and the overlaps with the common leader leave the link possible.
4. Bucket counts bound the overlap: shingles are dealt to ``BUCKETS`` buckets, and
   what two sets share is at most the sum of the lesser counts.  The counts are
   held up to ``LEVELS`` as bits, so the sum is that of set bits in both; what is
   above counts in full.  The bound is exact (it prunes little of very large sets).
   What it leaves is confirmed on full sets.

A list is never put into one task whole: leaders are least values (summed
map-side), joins on a list's key may be split, and members of one component are not
paired.  Rows that repeat an id are documents of their own; null ids count
where a component has no other.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .jaccard import set_id, shingle_hashes
from .shared import cut, passing, text_key
from .text import batches_of, mix, words

SHINGLE = 3
PERCENT = 85
#: Half keys of a collection (a power of two), and minhashes of a half key.
HALVES, WIDTH = 8, 2
#: Buckets of the counts that prune pairs, and counts that are told apart.
BUCKETS, LEVELS = 256, 4

_random = np.random.Generator(np.random.PCG64(13))
#: The orders by which leaders are chosen: ids with some bits turned.
_ORDERS = [int(x) for x in _random.integers(-1 << 63, (1 << 63) - 1, HALVES, dtype=np.int64)]
_FLIP, _TURN = (_random.integers(1, 1 << 63, 2 * HALVES * WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))


def recall(similarity: float, halves: int = HALVES, width: int = WIDTH) -> float:
    """Chance that two sets of this similarity share a key."""
    return (1 - (1 - similarity ** width) ** halves) ** 2


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """A row of minhashes for each set, none of them empty."""
    off = np.cumsum([0] + [len(s) for s in sets[:-1]])
    every = np.concatenate(sets)
    return np.stack([np.minimum.reduceat((every ^ f) * t, off) for f, t in zip(_FLIP, _TURN)], 1)


def half_keys(m: np.ndarray) -> np.ndarray:
    """The 2 * HALVES half keys of each row of minhashes, 32 bits each; the first collection first."""
    parts = m.reshape(len(m), 2 * HALVES, WIDTH)
    key = np.full(parts.shape[:2], 7, np.uint64)
    for k in range(WIDTH):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) ^ parts[:, :, k])
    return (key >> np.uint64(32)).astype(np.uint32).view(np.int32)


def bucket_counts(sets: list[np.ndarray]) -> np.ndarray:
    """A row for each set: bits telling which buckets hold 1, 2, ... LEVELS shingles or more."""
    out = np.zeros((len(sets), LEVELS * BUCKETS // 64), np.int64)
    for k in range(0, len(sets), 2048):
        part = sets[k:k + 2048]
        which = np.repeat(np.arange(len(part)), [len(s) for s in part])
        bucket = (np.concatenate(part) >> np.uint64(20)).astype(np.int64) % BUCKETS
        n = np.bincount(which * BUCKETS + bucket, minlength=len(part) * BUCKETS).reshape(len(part), BUCKETS)
        out[k:k + 2048] = np.concatenate([np.packbits(n > t, axis=1, bitorder="little").view(np.int64) for t in range(LEVELS)], 1)
    return out


def _signatures(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(doc_id, key, n, sid, left, right, counts) of every document."""
    q = docs.select(F.col(id_col).alias("doc_id"), text_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    kinds = {"n": "long", "sid": "long", "left": "array<int>", "right": "array<int>", "counts": "array<long>"}
    schema = q.select("doc_id", "key", *[F.lit(None).cast(t).alias(c) for c, t in kinds.items()]).schema

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in batches_of(batch, "text"):
                w = words(data, off)
                sets = list(shingle_hashes(w.hash, w.off, size))
                n = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(n)
                halves = np.zeros((len(sets), 2 * HALVES), np.int32)
                if len(full):
                    halves[full] = half_keys(minhashes([sets[k] for k in full]))
                lists = lambda x: pa.ListArray.from_arrays(
                    pa.array(np.arange(len(sets) + 1, dtype=np.int32) * x.shape[1]), pa.array(np.ascontiguousarray(x).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n), pa.array([set_id(s) for s in sets], pa.int64()), lists(halves[:, :HALVES]),
                     lists(halves[:, HALVES:]), lists(bucket_counts(sets))],
                    names=["doc_id", "key", *kinds])

    return cut(q.mapInArrow(one, schema))


def _suffixed(df: DataFrame, suffix: str) -> DataFrame:
    return df.toDF(*[c + suffix for c in df.columns])


def _need(na: Column, nb: Column, percent: int) -> Column:
    """100 + percent times the least overlap of two sets that link."""
    return F.lit(percent) * (na + nb)


def _sizes(percent: int) -> Column:
    """Sizes of _a and _b leave the link possible."""
    return 100 * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b")


def _most_shared(counts_a: str, counts_b: str, na: str, nb: str) -> Column:
    """The greatest overlap that two sets' bucket counts allow."""
    words = range(LEVELS * BUCKETS // 64)
    both = sum((F.bit_count(F.col(counts_a)[k].bitwiseAND(F.col(counts_b)[k])) for k in words), F.lit(0))
    above = [F.col(n) - sum((F.bit_count(F.col(c)[k]) for k in words), F.lit(0)) for n, c in ((na, counts_a), (nb, counts_b))]
    return both + F.least(*above)


def _first_shared() -> Column:
    """This list is that of the first equal halves of _a and _b."""
    def first(side: str) -> Column:
        at = F.lit(HALVES)
        for k in reversed(range(HALVES)):
            at = F.when(F.col(f"{side}_a")[k] == F.col(f"{side}_b")[k], F.lit(k)).otherwise(at)
        return at

    digits = F.col("list_a").bitwiseAND(F.lit(HALVES * HALVES - 1))
    return digits == first("left") + HALVES * first("right")


def _pairs(q: DataFrame) -> DataFrame:
    """Distinct (a, b, na, nb), a < b, of rows with sid and n of both."""
    first = F.col("sid_a") < F.col("sid_b")
    return q.select(F.least("sid_a", "sid_b").alias("a"), F.greatest("sid_a", "sid_b").alias("b"),
                    F.when(first, F.col("n_a")).otherwise(F.col("n_b")).alias("na"),
                    F.when(first, F.col("n_b")).otherwise(F.col("n_a")).alias("nb")).distinct()


class _Compare:
    """Overlaps of pairs of classes, on full sets read from one text of each."""

    def __init__(self, docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> None:
        self.docs = docs.select(text_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
        self.classes, self.size, self.percent = classes, size, percent

    def _bounded(self, pairs: DataFrame) -> DataFrame:
        """The pairs with the greatest overlap that their bucket counts allow."""
        counts = self.classes.select("sid", "counts")
        q = (pairs.join(_suffixed(counts, "_1"), F.col("a") == F.col("sid_1"))
             .join(_suffixed(counts, "_2"), F.col("b") == F.col("sid_2")))
        return cut(q.select(*pairs.columns, _most_shared("counts_1", "counts_2", "na", "nb").cast("long").alias("upper")))

    def _sets(self, pairs: DataFrame) -> DataFrame:
        both = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()
        nodes = cut(self.classes.select("sid", "key").join(both, "sid"))
        texts = passing(self.docs, nodes, "key", once=True).join(nodes, "key").select("sid", "text")
        size = self.size

        def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, data, off in batches_of(batch, "text"):
                    w = words(data, off)
                    sets = [s.view(np.int64) for s in shingle_hashes(w.hash, w.off, size)]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["sid", "set"])

        # Tasks that hold copies of a text give its set once each.
        return cut(texts.mapInArrow(one, "sid long, set array<long>").dropDuplicates(["sid"]))

    def _enough(self, overlap: str) -> Column:
        return F.lit(100 + self.percent) * F.col(overlap) >= _need(F.col("na"), F.col("nb"), self.percent)

    def overlaps(self, pairs: DataFrame) -> DataFrame:
        """The pairs with bounds of their overlap, ``lower`` and ``upper``: both the
        overlap itself where bucket counts leave the link possible."""
        pairs = self._bounded(pairs)
        left = pairs.where(self._enough("upper")).drop("upper")
        sets = self._sets(left)
        i = F.size(F.array_intersect("set_1", "set_2")).cast("long")
        exact = (left.join(_suffixed(sets, "_1"), F.col("a") == F.col("sid_1")).join(_suffixed(sets, "_2"), F.col("b") == F.col("sid_2"))
                 .select(*left.columns, i.alias("lower")).withColumn("upper", F.col("lower")))
        return cut(exact.unionByName(pairs.where(~self._enough("upper")).withColumn("lower", F.lit(0).cast("long"))))

    def links(self, overlaps: DataFrame) -> DataFrame:
        return overlaps.where(self._enough("lower")).select("a", "b")


def groups(docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_shingles, component_id (least id reachable by links) and kept of every row."""
    rows = _rows(docs, shingle, percent, id_col, text_col)
    return rows.select(F.col("doc_id").alias(id_col), "n_shingles", "component_id", "kept")


def _rows(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, kept) of every row."""
    table = _signatures(docs, id_col, text_col, shingle)
    held = ["doc_id", "key", "left", "right", "counts"]
    classes = table.where("n > 0").groupBy("sid", "n").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), *held)).alias("x"))
    classes = cut(classes.select("sid", F.col("n"), *[F.col(f"x.{c}").alias(c) for c in held]))
    compare = _Compare(docs, classes, id_col, text_col, shingle, percent)

    # A key for each pair of halves, its last digits telling their numbers; of the
    # ids, turned by the order of the first one's number, the least leads the list.
    digits = F.lit(HALVES - 1)
    order = F.get(F.array(*[F.lit(x).cast("long") for x in _ORDERS]), F.col("list").bitwiseAND(digits).cast("int"))
    entries = (classes.select("sid", F.posexplode("left").alias("i", "l"), "right").select("sid", "i", "l", F.posexplode("right").alias("j", "r"))
               .select(F.xxhash64("i", "l", "j", "r").bitwiseAND(F.lit(-HALVES * HALVES)).bitwiseOR(F.col("i") + HALVES * F.col("j")).alias("list"), "sid")
               .select("list", F.col("sid").bitwiseXOR(order).alias("turned")))
    lead = entries.groupBy("list").agg(F.min("turned").alias("first"), F.max("turned").alias("last")).where("first < last").select("list", "first")
    members = cut(entries.join(lead, "list").select("list", F.col("turned").bitwiseXOR(order).alias("sid"), F.col("first").bitwiseXOR(order).alias("leader")))
    shape = classes.select("sid", "n", "left", "right", "counts")
    star = members.where("sid <> leader").select(F.col("leader").alias("sid_a"), F.col("sid").alias("sid_b")).distinct()
    size = classes.select("sid", "n")
    star = (star.join(size.toDF("sid_a", "n_a"), "sid_a").join(size.toDF("sid_b", "n_b"), "sid_b").where(_sizes(percent)))
    answers = compare.overlaps(cut(_pairs(star)))
    roots = cut(components(compare.links(answers)))

    # Members outside their leader's component, against the others of their list.
    known = answers.select(F.col("a").alias("p"), F.col("b").alias("s"), "lower", "upper").unionByName(
        answers.select(F.col("b").alias("p"), F.col("a").alias("s"), "lower", "upper"))
    root = lambda c: F.coalesce("root", c)
    marked = (members.join(shape, "sid").join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", root("sid"))
              .join(roots.toDF("leader", "top"), "leader", "left").withColumn("outside", F.col("root") != F.coalesce("top", "leader")))
    lists = marked.groupBy("list").agg(F.max("outside").alias("mixed")).where("mixed").select("list")
    marked = cut(marked.join(lists, "list").join(known.toDF("leader", "sid", "lower", "upper"), ["leader", "sid"], "left")
                 .select("list", "sid", "leader", "n", "left", "right", "counts", "root", "outside", "lower", "upper"))
    a, b = _suffixed(marked.where("outside"), "_a"), _suffixed(marked.where("sid <> leader"), "_b")
    # What two sets share lies in the leader's set or outside it.
    most = F.least("upper_a", "upper_b") + F.least(F.col("n_a") - F.col("lower_a"), F.col("n_b") - F.col("lower_b"))
    enough = lambda x: F.lit(100 + percent) * x >= _need(F.col("n_a"), F.col("n_b"), percent)
    rest = a.join(b, (F.col("list_a") == F.col("list_b")) & (F.col("root_a") != F.col("root_b"))
                  & (~F.col("outside_b") | (F.col("sid_a") < F.col("sid_b"))) & _sizes(percent)
                  & _first_shared() & F.coalesce(enough(most), F.lit(True)) & enough(_most_shared("counts_a", "counts_b", "n_a", "n_b")))
    rest = _pairs(rest).join(answers.select("a", "b"), ["a", "b"], "left_anti")
    more = compare.links(compare.overlaps(cut(rest)))
    r = lambda s: _suffixed(roots, s)
    more = (more.join(r("_1"), F.col("a") == F.col("node_1"), "left").join(r("_2"), F.col("b") == F.col("node_2"), "left")
            .select(F.coalesce("root_1", "a").alias("a"), F.coalesce("root_2", "b").alias("b")))
    top = components(more)

    named = (classes.select("sid", "n", "doc_id").join(roots, F.col("sid") == F.col("node"), "left").withColumn("r", root("sid")).drop("node", "root")
             .join(top, F.col("r") == F.col("node"), "left").withColumn("r", root("r")).select("sid", "n", "doc_id", "r"))
    least = named.groupBy("r").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "r").select(F.col("sid").alias("_sid"), F.col("n").alias("_n"), "component_id")
    out = table.select("doc_id", "key", "n", "sid").join(named, (F.col("sid") == F.col("_sid")) & (F.col("n") == F.col("_n")), "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "key", F.col("n").alias("n_shingles"), own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def dedup(docs: DataFrame, *, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that are near copies of a document of lesser id.

    All columns stay.  Rows are told apart by id and text: repeats of a kept row stay,
    as do documents without words; of a component without ids all rows stay.
    """
    gone = _rows(docs, shingle, percent, id_col, text_col).where("not kept").select(F.col("key").alias("_near_copy")).distinct()
    return docs.join(gone, text_key(id_col, text_col) == gone["_near_copy"], "left_anti")
