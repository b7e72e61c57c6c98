"""N-gram Jaccard join with set-relation skipping.

A document's set is its distinct shingles of ``shingle`` consecutive words
(A-Z lower-cased, split at ASCII whitespace); a shorter text is one shingle,
a text without words has an empty set and is linked with nothing.  Two sets
link where 100 * intersection >= ``percent`` * union.

1. Equal sets are one node (the texts' classes).
2. A set's shingles are ordered rare first.  Frequencies are counted over all
   documents, from shingles that repeat within a chunk of a task; the order
   only decides how much is skipped, never what is found.  The first
   ``n - ceil(t n) + 1`` shingles are posted to index lists with their
   position; lists of one set are dropped.
3. Lists are read in blocks of similar set size; a pair of entries is skipped
   where the sizes, or the positions at which they hold the shingle, leave too
   little room for the overlap.
4. Each list block's entry of least position is its leader: the set that holds
   least beside what the list shares.  A set is compared with the leader of most of its
   lists first, then with those of other components.  A member
   that links to a leader takes over the leader's answers: members of one
   component are not compared again, and the overlaps with a common leader
   bound the overlap of two members from both sides, which settles many pairs
   without comparing them.
5. What is left is pruned by bucket counts of the sets and then compared in
   full.

No list is ever put into one task whole: sizes and leaders are counts and least values
(summed map-side), and joins on a list's key may be split.  A shingle that no chunk
holds twice is not known to be frequent, however many chunks hold it once; of N
documents dealt at random, M to a chunk, that leaves lists of up to about
sqrt(8 N / M) in the rare part.  They cost comparisons, not results.

Rows are told apart by id and text, so rows that repeat an id are documents of their
own and null ids are compared as others are.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import cut, passing, shuffles_deleted, stored, text_key
from .text import batches_of, mix, words

SHINGLE = 4
PERCENT = 85
#: Shingles kept in the table of frequent ones: at most so many, 16 bytes each,
#: seen at least so often.  Others count as rare.
FREQUENT, FREQUENT_MIN = 1_000_000, 8
#: Block of the lists of two sets: their one pair is a leader's.
PAIR = -1
#: Shingles counted together in a task.
CHUNK = 2_000_000
#: Buckets of the counts that prune pairs.
SKETCH = 64

_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                             0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def shingle_hashes(h: np.ndarray, off: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Distinct shingle hashes of each text, ascending, from its word hashes."""
    k = [mix(x * _K[i % len(_K)] + np.uint64(i)) if len(x) else x
         for i, x in enumerate(h[i:len(h) - size + 1 + i] for i in range(size))] if len(h) >= size else []
    full = mix(sum(k[1:], k[0].copy())) if k else np.empty(0, np.uint64)
    for a, b in zip(off[:-1], off[1:]):
        if b - a >= size:
            yield np.unique(full[a:b - size + 1])
        elif b > a:
            place = mix(np.arange(b - a, dtype=np.uint64) + np.uint64(int(b - a) << 8))
            yield mix(np.array([(h[a:b] * (place | np.uint64(1))).sum()], np.uint64))
        else:
            yield np.empty(0, np.uint64)


def set_id(s: np.ndarray) -> np.int64:
    """64-bit id of a set; used together with its size."""
    if not len(s):
        return np.int64(0)
    x = np.array([mix(s ^ _K[4]).sum(), np.bitwise_xor.reduce(mix(s + _K[5]))], np.uint64)
    return mix(x[:1] + mix(x[1:] ^ _K[6])).view(np.int64)[0]


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def _frequent(docs: DataFrame, text_col: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles (ascending) and their counts."""
    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def counted() -> pa.RecordBatch:
            s = np.sort(np.concatenate(held)) if held else np.empty(0, np.uint64)
            at = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.empty(0, np.int64)
            c = np.diff(np.append(at, len(s)))
            more = c > 1
            return pa.RecordBatch.from_arrays([pa.array(s[at[more]].view(np.int64)), pa.array(c[more])], names=["token", "n"])

        for batch in batches:
            for _, data, off in batches_of(batch, "text"):
                w = words(data, off)
                for s in shingle_hashes(w.hash, w.off, size):
                    held.append(s)
                    n += len(s)
                if n >= CHUNK:
                    yield counted()
                    held, n = [], 0
        yield counted()

    with shuffles_deleted(docs.sparkSession):
        table = (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(repeated, "token long, n long")
                 .groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_MIN)
                 .orderBy(F.col("n").desc(), "token").limit(FREQUENT).toArrow())
    token, n = (table.column(k).to_numpy() for k in (0, 1))
    order = np.argsort(token.view(np.uint64))
    return token[order].view(np.uint64), n[order]


class _Frequency:
    """Counts of frequent shingles; a bitmap answers for most of the others."""

    def __init__(self, token: np.ndarray, n: np.ndarray) -> None:
        self.token, self.n = token, n
        self.maybe = np.zeros(1 << 24, bool)
        self.maybe[(token >> np.uint64(40)).astype(np.int64)] = True

    def of(self, s: np.ndarray) -> np.ndarray:
        out = np.zeros(len(s), np.int64)
        at = np.flatnonzero(self.maybe[(s >> np.uint64(40)).astype(np.int64)])
        if len(at):
            k = np.minimum(np.searchsorted(self.token, s[at]), len(self.token) - 1)
            hit = self.token[k] == s[at]
            out[at[hit]] = self.n[k[hit]]
        return out


def _sets(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """(doc_id, key, n, sid, sketch, rare, common) of every document: its set's size,
    id and bucket counts, and the prefix in two parts, the shingles known to
    be frequent last."""
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(docs, text_col, size))
    q = docs.select(F.col(id_col).alias("doc_id"), text_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    schema = q.select("doc_id", "key", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("sid"),
                      F.array().cast("array<int>").alias("sketch"),
                      *[F.array().cast("array<long>").alias(c) for c in ("rare", "common")]).schema

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = _Frequency(*shared.value)
        for batch in batches:
            for part, data, off in batches_of(batch, "text"):
                w = words(data, off)
                n, sid, sketch, rare, common = [], [], [], [], []
                for s in shingle_hashes(w.hash, w.off, size):
                    n.append(len(s))
                    sid.append(set_id(s))
                    sketch.append(np.bincount((s >> np.uint64(20)).astype(np.int64) % SKETCH, minlength=SKETCH).astype(np.int32))
                    df = f.of(s)
                    order = np.argsort(df, kind="stable")[:prefix_length(len(s), percent)]
                    r = int(np.searchsorted(df[order], 1))
                    s = s.view(np.int64)
                    rare.append(s[order[:r]])
                    common.append(s[order[r:]])
                kind = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(sid, pa.int64()), pa.array(sketch, pa.list_(pa.int32())),
                     pa.array(rare, kind), pa.array(common, kind)], names=["doc_id", "key", "n", "sid", "sketch", "rare", "common"])

    return cut(q.mapInArrow(one, schema))


def _classes(sets: DataFrame) -> DataFrame:
    """(sid, n, doc_id, key) of each different set, from its document of least id (null last)."""
    q = sets.where("n > 0").groupBy("sid", "n").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("x"))
    return cut(q.select("sid", "n", "x.doc_id", "x.key"))


def _postings(sets: DataFrame, first: DataFrame, percent: int) -> DataFrame:
    """Entries (token, blk, n, pos, sid) of the lists that hold two sets or more."""
    blk = F.floor(F.log(F.col("n").cast("double")) / float(-np.log(percent / 100))).cast("int")
    # One document of each set posts (the filter lets few others through).
    sets = stored(passing(sets.select("key", "sid", "n", "rare", "common"), first, "key").drop("key"))
    rare = sets.select("sid", "n", F.posexplode("rare").alias("pos", "token")).withColumn("t", F.shiftright("token", 32).cast("int"))
    common = sets.select("sid", "n", F.size("rare").alias("r"), F.posexplode("common").alias("p", "token"))
    # Shingles counted as frequent are in several sets; of the others, lists of one set
    # (nearly all) are dropped by a filter before the entries are shuffled.
    lists = cut(rare.groupBy("t").agg(F.count("*").alias("m")).where("m > 1"))
    shared = passing(rare, lists, "t").join(lists, "t").select(
        "token", "sid", "n", "pos", F.when(F.col("m") > 2, blk).otherwise(F.lit(PAIR)).alias("blk"))
    common = common.select("token", "sid", "n", (F.col("r") + F.col("p")).alias("pos"), blk.alias("blk"))
    return stored(shared.unionByName(common).distinct())


def _needed(na: Column, nb: Column, percent: int) -> Column:
    """100 + percent times the least overlap of two sets that link."""
    return F.lit(percent) * (na + nb)


def _candidates(a: DataFrame, b: DataFrame, extra: Column | None, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb, lists) of sets whose sizes and positions allow a link in ``lists`` list blocks.

    ``a`` and ``b`` have token, blk, sid, n, pos with suffixes _a and _b.
    """
    room = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    ok = ((F.col("token_a") == F.col("token_b")) & (F.col("blk_a") == F.col("blk_b")) & (F.col("sid_a") != F.col("sid_b"))
          & (F.lit(100 + percent) * room >= _needed(F.col("n_a"), F.col("n_b"), percent))
          & (100 * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b")))
    if extra is not None:
        ok = ok & extra
    return (a.join(b, ok).select(
        F.least("sid_a", "sid_b").alias("a"), F.greatest("sid_a", "sid_b").alias("b"),
        F.when(F.col("sid_a") < F.col("sid_b"), F.col("n_a")).otherwise(F.col("n_b")).alias("na"),
        F.when(F.col("sid_a") < F.col("sid_b"), F.col("n_b")).otherwise(F.col("n_a")).alias("nb"))
        .groupBy("a", "b", "na", "nb").agg(F.count("*").alias("lists")))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs that are not of one component."""
    q = (pairs.join(roots.toDF("_x", "_rx"), F.col("a") == F.col("_x"), "left").join(roots.toDF("_y", "_ry"), F.col("b") == F.col("_y"), "left"))
    return q.where(F.coalesce(F.col("_rx") != F.col("_ry"), F.lit(True))).select(*pairs.columns)


def _suffixed(df: DataFrame, suffix: str) -> DataFrame:
    return df.toDF(*[c + suffix for c in df.columns])


def _pruned(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bucket counts leave room for the overlap they need."""
    both = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct()
    counts = passing(sets.select("sid", "sketch"), both.withColumnRenamed("a", "sid"), "sid", once=True).dropDuplicates(["sid"])
    p = (pairs.join(_suffixed(counts, "_1"), F.col("a") == F.col("sid_1"))
         .join(_suffixed(counts, "_2"), F.col("b") == F.col("sid_2")))
    most = F.aggregate(F.zip_with("sketch_1", "sketch_2", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    return cut(p.where(F.lit(100 + percent) * most >= _needed(F.col("na"), F.col("nb"), percent)).select(*pairs.columns))


#: Sets that are compared with one set in a task; more go to further tasks.
TOGETHER = 500


def _overlaps(pairs: DataFrame, docs: DataFrame, first: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``pairs`` with their overlap ``i``, on full sets.

    A set is computed from its text and sent once to each partner ``a``, whose own set goes to as many
    tasks as its partners fill.  Only texts whose keys pass a filter are shuffled before that.
    """
    tasks = pairs.groupBy("a").agg(F.ceil(F.count("*") / TOGETHER).alias("tasks"))
    sends = pairs.join(tasks, "a").select(F.col("b").alias("sid"), F.col("a").alias("to"), F.pmod(F.xxhash64("b"), F.col("tasks")).alias("task"), "na", "nb")
    none = F.lit(None).cast("long")
    sends = cut(sends.unionByName(tasks.select(F.col("a").alias("sid"), F.col("a").alias("to"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"),
                                               none.alias("na"), none.alias("nb"))))
    keys = cut(passing(first.select("sid", "key"), sends, "sid"))
    sends = sends.join(keys, "sid")
    q = docs.select(text_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    rows = passing(q, keys, "key", once=True).join(sends, "key").select("sid", "to", "task", "na", "nb", "text")
    schema = rows.select("sid", "to", "task", "na", "nb", F.lit(None).cast("array<long>").alias("set")).schema

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int | None, np.ndarray | None] = (None, None)
        for batch in batches:
            for part, data, off in batches_of(batch, "text"):
                sid, sets, at = part.column(0).to_pylist(), [], 0
                while at < len(sid):
                    # A text's rows follow one another: its set is computed once.
                    end = at + 1
                    while end < len(sid) and sid[end] == sid[at]:
                        end += 1
                    if held[0] != sid[at]:
                        w = words(data[off[at]:off[at + 1]], off[at:at + 2])
                        s = next(shingle_hashes(w.hash, w.off, size))
                        held = (sid[at], s.view(np.int64) if set_id(s) == sid[at] else None)
                    sets += [held[1]] * (end - at)
                    at = end
                out = pa.RecordBatch.from_arrays([*part.columns[:5], pa.array(sets, pa.list_(pa.int64()))], names=schema.names)
                yield out.filter(out.column(5).is_valid())

    w = Window.partitionBy("to", "task").orderBy(F.col("na").isNotNull())
    met = rows.mapInArrow(one, schema).withColumn("head", F.first("set").over(w)).where("na is not null")
    i = F.size(F.array_intersect("head", "set")).cast("long")
    return met.select(F.col("to").alias("a"), F.col("sid").alias("b"), "na", "nb", i.alias("i")).distinct()


def _links(overlaps: DataFrame, percent: int) -> DataFrame:
    return overlaps.where(F.lit(100 + percent) * F.col("i") >= _needed(F.col("na"), F.col("nb"), percent)).select("a", "b")


def groups(docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``id_col``, n_shingles, component_id of every row.

    ``component_id`` is the least id reachable by links, the row's own id for
    empty sets.  A null id counts only where its component has no other.
    """
    rows = _rows(docs, shingle, percent, id_col, text_col)
    return rows.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _rows(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, key, n, component_id) of every row."""
    sets = _sets(docs, id_col, text_col, shingle, percent)
    first = _classes(sets)
    entries = _postings(sets, first, percent)

    def overlaps(pairs: DataFrame) -> DataFrame:
        pairs = _pruned(pairs, sets, percent)
        return _overlaps(pairs, docs, first, id_col, text_col, shingle)

    # Leaders: the entry of least position in each block of each list.
    lead = (entries.groupBy("token", "blk").agg(F.min(F.struct("pos", "n", "sid")).alias("x"))
            .select("token", "blk", "x.sid", "x.n", "x.pos"))
    shape = ["token", "blk", "sid", "n", "pos"]
    to_leader = _candidates(_suffixed(lead.select(shape), "_a"), _suffixed(entries.select(shape), "_b"), None, percent)
    to_leader = cut(to_leader)
    # A set meets the leader of most of its lists first; the others only where that leaves it
    # in another component.
    ends = to_leader.select(F.col("a").alias("s"), F.col("b").alias("p"), "lists").unionByName(
        to_leader.select(F.col("b").alias("s"), F.col("a").alias("p"), "lists"))
    best = ends.groupBy("s").agg(F.max(F.struct("lists", "p")).alias("x")).select(F.least("s", "x.p").alias("a"), F.greatest("s", "x.p").alias("b")).distinct()
    best = cut(to_leader.join(best, ["a", "b"], "left_semi").drop("lists"))
    answers = cut(overlaps(best))
    roots = cut(components(_links(answers, percent)))
    answers = cut(answers.unionByName(overlaps(cut(_apart(to_leader.drop("lists"), roots).join(best, ["a", "b"], "left_anti")))))
    star = _links(answers, percent)
    roots = cut(components(star))

    # The other pairs of a list block: not of one component, not yet compared.
    marked = entries.where(F.col("blk") != PAIR).join(roots, F.col("sid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "sid"))
    marked = marked.select(*shape, "root")
    upper = marked.withColumn("blk", F.explode(F.array("blk", F.col("blk") - 1)))
    order = F.struct("n_a", "sid_a") < F.struct("n_b", "sid_b")
    rest = _candidates(_suffixed(marked, "_a"), _suffixed(upper, "_b"), order & (F.col("root_a") != F.col("root_b")), percent)
    rest = rest.drop("lists").join(answers.select("a", "b"), ["a", "b"], "left_anti")
    derived = cut(_derive(rest, answers, percent))
    more = _links(overlaps(derived.where("settled is null").drop("settled")), percent)
    second = derived.where("settled").select("a", "b").unionByName(more)
    # Links between components, as links between their roots.
    r = lambda s: _suffixed(roots, s)
    second = (second.join(r("_1"), F.col("a") == F.col("node_1"), "left").join(r("_2"), F.col("b") == F.col("node_2"), "left")
              .select(F.coalesce("root_1", "a").alias("a"), F.coalesce("root_2", "b").alias("b")))
    top = components(second)

    top = cut(top)
    # Sets without links are components of their own; few others meet the roots.
    linked = (roots.withColumn("r", F.col("root")).drop("root").unionByName(top.join(roots.select("node"), "node", "left_anti").select("node", F.col("node").alias("r")))
              .join(top.withColumnsRenamed({"node": "_t"}), F.col("r") == F.col("_t"), "left").select("node", F.coalesce("root", "r").alias("r")))
    linked = cut(linked)
    classes = (passing(first.select("sid", "n", "doc_id"), linked.select(F.col("node").alias("sid")), "sid")
               .join(linked, F.col("sid") == F.col("node")).select("sid", "n", "doc_id", "r"))
    least = classes.groupBy("r").agg(F.min("doc_id").alias("component_id"))
    classes = classes.join(least, "r").select("sid", "n", "component_id")
    alone = first.select("sid", "n", "doc_id").join(linked, F.col("sid") == F.col("node"), "left_anti").select("sid", "n", F.col("doc_id").alias("component_id"))
    named = classes.unionByName(alone).select(F.col("sid").alias("_sid"), F.col("n").alias("_n"), "component_id")
    out = sets.select("doc_id", "key", "n", "sid").join(named, (F.col("sid") == F.col("_sid")) & (F.col("n") == F.col("_n")), "left")
    return out.select("doc_id", "key", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _derive(pairs: DataFrame, answers: DataFrame, percent: int) -> DataFrame:
    """``pairs`` with ``settled`` true where a common leader's answers prove
    the link; pairs they disprove are left out; null where they leave it open.

    With x and y the overlaps of two sets with set p, the two share at least
    x + y - |p| and at most min(x, y) + min(|a| - x, |b| - y).
    """
    seen = answers.select(F.col("a").alias("sid"), F.col("b").alias("p"), F.col("nb").alias("np"), "i").unionByName(
        answers.select(F.col("b").alias("sid"), F.col("a").alias("p"), F.col("na").alias("np"), "i"))
    best = seen.groupBy("sid").agg(F.max(F.struct("i", "p", "np")).alias("x")).select("sid", "x.p", "x.np", "x.i")
    q = (pairs.join(_suffixed(best, "_1"), F.col("a") == F.col("sid_1"), "left")
         .join(_suffixed(best, "_2"), F.col("b") == F.col("sid_2"), "left"))
    same = F.col("p_1").isNotNull() & (F.col("p_1") == F.col("p_2"))
    least = F.col("i_1") + F.col("i_2") - F.col("np_1")
    most = F.least("i_1", "i_2") + F.least(F.col("na") - F.col("i_1"), F.col("nb") - F.col("i_2"))
    need = _needed(F.col("na"), F.col("nb"), percent)
    settled = (F.when(same & (F.lit(100 + percent) * least >= need), F.lit(True))
               .when(same & (F.lit(100 + percent) * most < need), F.lit(False)))
    return q.withColumn("settled", settled).where("settled is null or settled").select(*pairs.columns, "settled")


def keep_one(docs: DataFrame, *, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One document of each group of linked documents: the least id.

    Rows are told apart by id and text: repeats of a kept row stay, as do rows
    with an empty set; of a component without ids all rows stay.
    """
    rows = _rows(docs, shingle, percent, id_col, text_col)
    gone = rows.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("key").alias("_near_copy")).distinct()
    return docs.join(gone, text_key(id_col, text_col) == gone["_near_copy"], "left_anti")
