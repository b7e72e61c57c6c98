"""Line dedup: SimHash blocks, edit similarity, and exact lists for what they miss.

A line is normalised to its words (A-Z lower-cased; digits, a-z and non-ASCII
characters); lines without words stay where they are.  Equal normalised lines
are one class.  Two classes are near where the word-level edit similarity,
1 - distance / words of the longer, is at least ``similarity``; edits count whole
words, so lines of under five words have no near ones but a line of five that has one
word more.  Of every connected group of lines one occurrence stays, the one of the
least (id, line number), rows without id last.

1. Every class has a SimHash of its words, longer words weighing more, cut into
   ``BLOCKS`` blocks; classes of one length class that agree in a block (by the
   pigeonhole all within ``BLOCKS`` - 1 bits, and many that are farther apart)
   meet in its list and are compared with the list's leader: by lengths and word
   parities first, then by edit distance.
2. Where one edit is allowed, near lines are equal but for one word: each class posts
   itself with each word left out, and a shorter one itself.  All members of such
   a list are near each other, so each is linked with the least one.
3. Where more are allowed, of a line of n words at most k = (1 - similarity) n are
   edited, so two near lines share a word among the k + 1 that come first in any
   order of all words (the i-th occurrence of a word in a line counts as a word of
   its own), here rare words first by counts in a table of fixed size.  Lines of
   ``LONG`` words and more, of which chance would bring too many together, meet
   by 2 k + 2 pairs of adjacent words in the same way.  Lists of one class are
   dropped.  First all classes of a list are compared with two members of each large
   component (``LARGE``) in it, which joins most of what belongs to it; classes that
   are still not joined are compared with each other.

Steps 2 and 3 find every near pair that step 1 misses; with them the groups are
exact, which the tests hold against brute force.  No list is put into one task
whole: leaders and least members are summed map-side, and joins on a list's key may
be split.  Members of one component are not paired: the classes of large ones
are kept apart from the others, and meet those only.

Null and empty texts have no lines.  Documents are told apart by id and text, so rows
that repeat both are one document and keep the same lines; null ids are allowed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import least_of, settled
from .shared import cut, in_lists, passing, shared_lists, shuffles_deleted, stored, text_key
from .text import NOT_ALNUM, batches_of, mix, pieces, segments, words

SIMILARITY = 0.8
#: SimHash blocks, and bits of each.
BLOCKS, BLOCK_BITS = 4, 20
#: Address bits of the table of word frequencies, a byte each whatever the data, and
#: what it holds for words that occur once.
LEVEL_BITS, ONCE = 21, 6
#: Lines of so many words meet by pairs of adjacent words, if the similarity is at least this.
LONG, LEAST_FOR_PAIRS = 50, 0.6
#: Classes of a component that is kept apart.
LARGE = 64
#: Lists that a member of a large component leads; those it leads besides are left to the full comparison.
LED = 8
#: Parts of the lists of rare words that are joined one after the other: only one lies on disk.
ROUNDS = 2
#: The same for the lists of lines less one word, of which a class has as many as words.
REST_ROUNDS = 4
#: Word parities of a line: bits of so many longs.
PARITIES = ("par", "par2", "par3", "par4")
#: Rounds of the components that only tell which classes need not be compared any more.
EARLY_ROUNDS = 2
#: What tells classes apart.
CLASS = ("h", "n", "par")

#: The orders by which leaders of SimHash lists are chosen: ids with some bits turned.
_ORDERS = [int(x) for x in np.random.Generator(np.random.PCG64(7)).integers(-1 << 63, (1 << 63) - 1, BLOCKS, dtype=np.int64)]
#: Weight of a word by its bytes: 1 up to three, 2 up to six, else 3.
_WEIGHT = np.array([1, 1, 1, 1, 2, 2, 2, 3], np.uint64)
#: Words whose weights surely fit one byte.
_CHUNK = 85
#: Bit i of a byte in lane i of eight.
_LANES = np.array([sum((b >> i & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)
_PLACE, _LENGTH = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def edits(n: int, similarity: float) -> int:
    """Words of a line of n that may be edited."""
    return int(n * (1 - similarity) + 1e-9)


def _one_edit(similarity: float) -> tuple[int, int]:
    """Least number of words that allows one edit, and least that allows two (0 if none does)."""
    at = [next((n for n in range(1, 10 ** 6) if edits(n, similarity) >= k), 0) for k in (1, 2)]
    return at[0], at[1]


def _numbered(h: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Hashes by which the i-th occurrence in a line is a word of its own."""
    order = np.argsort(_packed(of, h >> np.uint64(24)), kind="stable")
    same = np.append(False, (h[order][1:] == h[order][:-1]) & (of[order][1:] == of[order][:-1])) if len(h) else np.empty(0, bool)
    place = np.arange(len(h))
    occurrence = np.empty(len(h), np.uint64)
    occurrence[order] = place - np.maximum.accumulate(np.where(same, 0, place)) if len(h) else 0
    return mix(h + occurrence * np.uint64(0x9E3779B97F4A7C15))


def _packed(of: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Sort keys by line, then by 40 bits; a slice has fewer than 2 ** 24 lines."""
    return of.astype(np.uint64) << np.uint64(40) | low


def _rarest(token: np.ndarray, level: np.ndarray, of: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first ``most[line]`` tokens of each line by level and hash, and their lines; those surely alone are left out."""
    short = (token >> np.uint64(32)).astype(np.uint32)
    order = np.argsort(_packed(of, level.astype(np.uint64) << np.uint64(32) | short), kind="stable")
    line = of[order]
    first = np.searchsorted(line, np.arange(len(most)))
    use = (np.arange(len(order)) - first[line] < most[line]) & (level[order] != ONCE)
    return short[order][use].view(np.int32), line[use]


def _length_class(n: np.ndarray) -> np.ndarray:
    """Doublings of the length, 0 from ``LONG`` words on."""
    return np.floor(np.log2(np.maximum(n, 1) / LONG)).astype(np.int64)


def _in_class(token: np.ndarray, size: np.ndarray) -> np.ndarray:
    """List numbers of tokens among lines of a length class."""
    return (mix(token.view(np.uint32).astype(np.uint64) << np.uint64(8) ^ (size + 64).astype(np.uint64)) >> np.uint64(32)).astype(np.uint32).view(np.int32)


class Lines:
    """Lines with words of a slice of texts."""

    def __init__(self, data: np.ndarray, off: np.ndarray) -> None:
        self.start, self.end = segments(data != 10, off)
        w = words(data, off, NOT_ALNUM)
        self.hash, self.word_len = w.hash, w.end - w.start
        first = np.searchsorted(w.start, self.start, "left")
        last = np.searchsorted(w.start, self.end, "left")
        self.text = np.searchsorted(off, self.start, "right") - 1
        # Line numbers count all lines, empty ones too.
        newline = np.concatenate(([0], np.cumsum(data == 10)))
        self.number = newline[self.start] - newline[off[self.text]] if len(self.start) else np.empty(0, np.int64)
        keep = last > first
        self.start, self.end, self.text, self.number = (x[keep] for x in (self.start, self.end, self.text, self.number))
        self.first, self.last = first[keep], last[keep]

    def __len__(self) -> int:
        return len(self.first)

    def _words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash of each word of the lines, its place in its line, first word and words of each line.

        Words of the lines follow one another without gaps.
        """
        n = self.last - self.first
        if not len(n):
            return np.empty(0, np.uint64), np.empty(0, np.int64), n, n
        at = np.arange(self.first[0], self.last[-1]) - np.repeat(self.first, n)
        return self.hash[self.first[0]:self.last[-1]], at, self.first - self.first[0], n

    def hashes(self) -> np.ndarray:
        """64-bit hash of each line."""
        h, at, line, n = self._words()
        if not len(n):
            return np.empty(0, np.int64)
        return mix(np.add.reduceat(h * (mix(at.astype(np.uint64) + np.uint64(1)) | np.uint64(1)), line) + n.astype(np.uint64)).view(np.int64)

    def parities(self) -> list[np.ndarray]:
        """Whether the words of each of 256 kinds are odd in number, 64 kinds a long."""
        h, _, line, n = self._words()
        if not len(n):
            return [np.empty(0, np.int64)] * len(PARITIES)
        voters = mix(h ^ np.uint64(0x5851F42D4C957F2D))
        bit, side = np.uint64(1) << (voters >> np.uint64(7) & np.uint64(63)), voters >> np.uint64(13) & np.uint64(3)
        return [np.bitwise_xor.reduceat(np.where(side == np.uint64(k), bit, np.uint64(0)), line).view(np.int64) for k in range(len(PARITIES))]

    def prefixes(self, levels: np.ndarray, similarity: float) -> pa.ListArray:
        """The words of which a near line must have one: the rarest, 32 bits each.

        Lines of ``LONG`` words and their possible partners post pairs of adjacent words instead.
        Words that occur once in all texts are left out, for nobody else has them.  Lines
        whose longest near ones allow one edit or none post nothing.
        """
        h, at, line, n = self._words()
        if not len(n) or similarity <= 0:
            return pa.array([[]] * len(n), pa.list_(pa.int32()))
        of = np.repeat(np.arange(len(n)), n)
        level = levels[h >> np.uint64(64 - LEVEL_BITS)]
        allowed = np.floor(n * (1 - similarity) + 1e-9).astype(np.int64)
        two, pairs = _one_edit(similarity)[1], similarity >= LEAST_FOR_PAIRS
        few = (n >= two - edits(two, similarity)) & (n < LONG if pairs else True) if two else np.zeros(len(n), bool)
        single = few[of]
        out = [_rarest(_numbered(h[single], of[single]), level[single], of[single], np.where(few, allowed + 1, 0))]
        if pairs and two:
            both = np.append((n >= LONG - edits(LONG, similarity))[of[1:]] & (of[1:] == of[:-1]), False)
            k = np.flatnonzero(both)
            # An edit spoils two pairs; one more is posted for partners of other lengths.
            pair = mix(h[k] * _PLACE ^ h[k + 1] + _LENGTH)
            out.append(_rarest(_numbered(pair, of[k]), np.minimum(level[k], level[k + 1]), of[k], 2 * allowed + 2))
        # Lists are split by length class: a line posts to its own and to those of longer partners.
        longest = np.floor(n / similarity + 1e-9).astype(np.int64)
        first = _length_class(n)
        spans = [(first, _length_class(np.minimum(longest, LONG - 1) if pairs else longest)), (np.maximum(first, 0), _length_class(longest))]
        token, where = [], []
        for (t, of_line), (low, high) in zip(out, spans):
            for k in range(int((high - low).max(initial=-1)) + 1):
                use = low[of_line] + k <= high[of_line]
                where.append(of_line[use])
                token.append(_in_class(t[use], low[of_line[use]] + k))
        token, where = np.concatenate(token), np.concatenate(where)
        # Ascending and once each, as ``_entries`` needs them.
        both = np.unique(where.astype(np.int64) << 32 | token.astype(np.int64) + (1 << 31))
        off = np.searchsorted(both, np.arange(len(n) + 1) << 32)
        return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(((both & 0xFFFFFFFF) - (1 << 31)).astype(np.int32)))

    def simhashes(self) -> list[np.ndarray]:
        """The SimHash blocks of each line: bit by bit the weighted majority of its words' hashes."""
        h, at, line, n = self._words()
        blocks = [np.zeros(len(n), np.int32) for _ in range(BLOCKS)]
        if not len(n):
            return blocks
        weight = _WEIGHT[np.minimum(self.word_len[self.first[0]:self.last[-1]], 7)]
        chunk = np.flatnonzero(at % _CHUNK == 0)
        per_line = np.searchsorted(chunk, line)
        total = np.add.reduceat(weight.astype(np.int64), line)
        voters, more = mix(h ^ np.uint64(0x5851F42D4C957F2D)), mix(h ^ np.uint64(0x14057B7EF767814F))
        for k in range(-(-BLOCKS * BLOCK_BITS // 8)):
            side = voters >> np.uint64(8 * k) if k < 8 else more >> np.uint64(8 * (k - 8))
            lanes = _LANES[(side & np.uint64(255)).astype(np.int64)] * weight
            votes = np.add.reduceat(lanes, chunk).view(np.uint8).reshape(-1, 8).astype(np.int64)
            votes = np.add.reduceat(votes, per_line, axis=0)
            for i in range(8):
                bit = 8 * k + i
                if bit < BLOCKS * BLOCK_BITS:
                    blocks[bit // BLOCK_BITS] |= (2 * votes[:, i] > total).astype(np.int32) << (bit % BLOCK_BITS)
        return blocks

    def block_lists(self, similarity: float) -> pa.ListArray:
        """The SimHash lists of each line, 32 bits each: block, its number (the last digits) and the
        line's length class; none for lines too short for an edit."""
        n = self.last - self.first
        size = np.floor(np.log(np.maximum(n, 1)) / np.log(1.25)).astype(np.uint64)
        keys = [mix(b.astype(np.uint64) << np.uint64(32) | size << np.uint64(8) | np.uint64(k)) >> np.uint64(32) & np.uint64(~(BLOCKS - 1) & 0xFFFFFFFF) | np.uint64(k)
                for k, b in enumerate(self.simhashes())]
        use = n >= max(1, _one_edit(similarity)[0] - 1)
        flat = np.stack(keys, 1).astype(np.uint32).view(np.int32)[use].ravel()
        off = np.concatenate(([0], np.cumsum(use * BLOCKS))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(off), pa.array(flat))

    def left_out(self, similarity: float) -> pa.ListArray:
        """Hashes of each line with each word left out, and of the whole line as such
        a rest, where one edit is allowed; none for other lines."""
        _, _, _, n = self._words()
        least, end = _one_edit(similarity)
        end = end if end or not least else 10 ** 6
        held = [np.empty((0, 0), np.uint64)] * len(n)
        for size in np.unique(n[(n >= least - 1) & (n < end)]).tolist():
            which = np.flatnonzero(n == size)
            if not len(which):
                continue
            w = self.hash[self.first[which][:, None] + np.arange(size)]
            m = mix(np.arange(size, dtype=np.uint64) + np.uint64(1)) | np.uint64(1)
            before = np.cumsum(w * m, axis=1)
            keys = np.empty((len(which), 0), np.uint64)
            rest = lambda total, k, words: mix(total + mix(k + np.uint64(1)) * _PLACE + np.uint64(words) * _LENGTH)
            if size >= least:
                moved = np.cumsum(w[:, 1:] * m[:-1], axis=1)
                moved = np.concatenate([np.zeros((len(which), 1), np.uint64), moved], axis=1)
                total = before - w * m + (moved[:, -1:] - moved)
                keys = rest(total, np.arange(size, dtype=np.uint64), size)
            if size + 1 < end:
                keys = np.concatenate([keys, rest(before[:, -1:], np.arange(size + 1, dtype=np.uint64), size + 1)], axis=1)
            for k, row in zip(which, keys):
                held[k] = row
        off = np.concatenate(([0], np.cumsum([len(x) if x.ndim == 1 else 0 for x in held]))).astype(np.int32)
        flat = [x for x in held if x.ndim == 1]
        return pa.ListArray.from_arrays(pa.array(off), pa.array((np.concatenate(flat) if flat else np.empty(0, np.uint64)).view(np.int64)))

    def codes(self) -> list[str]:
        """Each line as a string with one code point per word."""
        points = (self.hash % np.uint64(1 << 20)).astype(np.uint32) + np.uint32(0x10000)
        return [points[a:b].astype("<u4").tobytes().decode("utf-32-le") for a, b in zip(self.first, self.last)]


def word_levels(docs: DataFrame, text_col: str) -> np.ndarray:
    """Frequency of words by the first bits of their hashes, as a logarithm in a byte."""
    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << LEVEL_BITS, np.int64)
        for batch in batches:
            for _, data, off in batches_of(batch, "text"):
                np.add.at(total, (words(data, off, NOT_ALNUM).hash >> np.uint64(64 - LEVEL_BITS)).astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["at", "n"])

    with shuffles_deleted(docs.sparkSession):
        rows = (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(one, "at int, n long")
                .groupBy("at").agg(F.least(F.floor(F.log2(F.sum("n") + 1) * 6), F.lit(255)).cast("short").alias("level")).toArrow())
    levels = np.zeros(1 << LEVEL_BITS, np.uint8)
    levels[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return levels


def line_table(docs: DataFrame, id_col: str, text_col: str, *, more: bool = False, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, key, line, h, n, par) of every line with words, ``key`` telling documents apart;
    with ``more`` also the other parities, ``sim``, its SimHash lists, ``pre``, those of its rarest
    words, and ``rest``, what is left of it without a word."""
    q = docs.select(F.col(id_col).alias("doc_id"), text_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    extra = [(c, "long") for c in PARITIES[1:]] + [("sim", "array<int>"), ("pre", "array<int>"), ("rest", "array<long>")]
    kinds = [("line", "int"), ("h", "long"), ("n", "int"), ("par", "long")] + extra * more
    schema = q.select("doc_id", "key", *[F.lit(None).cast(t).alias(c) for c, t in kinds]).schema
    shared = docs.sparkSession.sparkContext.broadcast(word_levels(docs, text_col)) if more else None

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in batches_of(batch, "text"):
                lines = Lines(data, off)
                par = [pa.array(x) for x in lines.parities()]
                at = pa.array(lines.text, pa.int64())
                out = [part.column(0).take(at), part.column(1).take(at), pa.array(lines.number.astype(np.int32)), pa.array(lines.hashes()),
                       pa.array((lines.last - lines.first).astype(np.int32)), par[0]]
                if more:
                    out += [*par[1:], lines.block_lists(similarity), lines.prefixes(shared.value, similarity), lines.left_out(similarity)]
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "key", *[c for c, _ in kinds]])

    return q.mapInArrow(one, schema)


def _suffixed(df: DataFrame, suffix: str) -> DataFrame:
    return df.toDF(*[c + suffix for c in df.columns])


def _allowed(similarity: float) -> Column:
    """Words of the longer of _a and _b that may be edited."""
    return F.floor(F.greatest("n_a", "n_b") * F.lit(1 - similarity) + 1e-9)


def _possible(similarity: float) -> Column:
    """Lengths and parities allow it: an edit changes the parity of two words at most, one that changes the length, of one."""
    odd = [F.bit_count(F.col(c + "_a").bitwiseXOR(F.col(c + "_b"))) for c in PARITIES]
    longer = F.abs(F.col("n_a") - F.col("n_b"))
    return (longer <= _allowed(similarity)) & (sum(odd[1:], odd[0]) <= 2 * _allowed(similarity) - longer)


def _pairs(q: DataFrame) -> DataFrame:
    return q.select(F.least("h_a", "h_b").alias("a"), F.greatest("h_a", "h_b").alias("b")).distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("h")).unionByName(pairs.select(F.col("b").alias("h"))).distinct()


def _likely(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """The pairs that lengths and word parities allow."""
    shape = cut(passing(classes.select("h", "n", *PARITIES), _ends(pairs), "h"))
    return (pairs.join(_suffixed(shape, "_a"), F.col("a") == F.col("h_a")).join(_suffixed(shape, "_b"), F.col("b") == F.col("h_b"))
            .where(_possible(similarity)).select("a", "b"))


def _near(q: DataFrame, docs: DataFrame, classes: DataFrame, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """The pairs whose word-level edit similarity is high enough."""
    ends = _ends(q)
    nodes = cut(passing(classes.select("h", "key", "line"), ends, "h").join(ends, "h"))
    codes = cut(_codes(docs, nodes, id_col, text_col))
    q = q.join(_suffixed(codes, "_1"), F.col("a") == F.col("h_1")).join(_suffixed(codes, "_2"), F.col("b") == F.col("h_2"))
    q = q.withColumn("most", F.floor(F.greatest(F.length("code_1"), F.length("code_2")) * F.lit(1 - similarity) + 1e-9).cast("int"))
    return q.where(F.expr("levenshtein(code_1, code_2, most) >= 0")).select("a", "b")


def _codes(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(h, code) of the classes (h, key, line), read from their first texts."""
    wanted = nodes.groupBy("key").agg(F.collect_set("line").alias("lines"))
    q = docs.select(text_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    q = passing(q, nodes, "key", once=True).join(wanted, "key").select("lines", "text")

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in batches_of(batch, "text"):
                lines = Lines(data, off)
                h = lines.hashes()
                want = [set(x) for x in part.column(0).to_pylist()]
                at = [k for k, (t, n) in enumerate(zip(lines.text.tolist(), lines.number.tolist())) if n in want[t]]
                code = lines.codes() if at else []
                yield pa.RecordBatch.from_arrays([pa.array(h[at], pa.int64()), pa.array([code[k] for k in at], pa.string())], names=["h", "code"])

    return q.mapInArrow(one, "h long, code string").dropDuplicates(["h"])


def simhash_pairs(classes: DataFrame) -> DataFrame:
    """Candidates (a, b): classes of a length class that share a SimHash block, with its list's leader.

    The leader is the least id in an order of the block's own, so a group meets several leaders.
    """
    digits = F.lit(BLOCKS - 1)
    order = F.get(F.array(*[F.lit(x).cast("long") for x in _ORDERS]), F.col("list").bitwiseAND(digits))
    entries = cut(shared_lists(classes.select("h", "sim"), "sim").select(F.explode("sim").alias("list"), "h")
                  .select("list", F.col("h").bitwiseXOR(order).alias("turned")))
    lead = entries.groupBy("list").agg(F.min("turned").alias("first"), F.max("turned").alias("last")).where("first < last").select("list", "first")
    return _pairs(entries.join(lead, "list").where("turned <> first")
                  .select(F.col("first").bitwiseXOR(order).alias("h_a"), F.col("turned").bitwiseXOR(order).alias("h_b")))


def one_word_apart(classes: DataFrame) -> DataFrame:
    """Links (a, b) that join all classes which are equal but for one word, where that is allowed."""
    found = []
    for k in range(REST_ROUNDS):
        entries = classes.select(F.explode("rest").alias("list"), "h").where(F.pmod("list", F.lit(REST_ROUNDS)) == k)
        least = entries.groupBy("list").agg(F.min("h").alias("a"), F.max("h").alias("z")).where("a < z").select("list", "a")
        found.append(cut(entries.join(least, "list").where("a < h").select("a", F.col("h").alias("b")).distinct()))
    links = found[0]
    for q in found[1:]:
        links = links.unionByName(q)
    return links.distinct()


def _large(roots: DataFrame) -> DataFrame:
    """(large): the roots of large components."""
    return cut(roots.groupBy("root").agg(F.count("*").alias("size")).where(F.col("size") >= LARGE).select(F.col("root").alias("large")))


def _entries(q: DataFrame, *cols: str) -> DataFrame:
    """Entries (list, below, cols) of the lists ``pre``, ascending; ``below`` has the row's lists before this one."""
    return q.select(F.posexplode("pre").alias("_at", "list"), *cols, "pre").select("list", F.slice("pre", F.lit(1), F.col("_at")).alias("below"), *cols)


def _met(a: DataFrame, b: DataFrame, similarity: float, *more: Column) -> DataFrame:
    """Pairs (a, b) of entries of one list that are of different roots, as lengths and word parities allow.

    Where the entries have ``below``, two classes meet in the first list that both have, so the join
    makes one row of a pair, not one a list.
    """
    ok = (F.col("list_a") == F.col("list_b")) & (F.col("h_a") != F.col("h_b")) & (F.greatest("n_a", "n_b") >= _one_edit(similarity)[1])
    once = [~F.arrays_overlap("below_a", "below_b")] if "below" in a.columns else []
    for x in (*more, F.coalesce(F.col("root_a") != F.col("root_b"), F.lit(True)), _possible(similarity), *once):
        ok = ok & x
    return _pairs(_suffixed(a, "_a").join(_suffixed(b, "_b"), ok))


def large_component_pairs(classes: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Candidates (a, b) of different roots: the classes of a list of rare words that holds a large
    component, with the two of its members there that have the least and the greatest id, in ``LED`` lists
    of each; what they leave apart is compared in full by ``rare_word_pairs``."""
    shape = ["h", "n", *PARITIES]
    large = _large(roots)
    if large.isEmpty():
        return roots.where("false").select(F.col("node").alias("a"), F.col("node").alias("b"))
    members = cut(roots.join(large, F.col("root") == F.col("large")).select(F.col("node").alias("h"), "root"))
    many = cut(passing(classes.select(*shape, "pre"), members, "h").join(members, "h").select(F.explode("pre").alias("list"), *shape, "root"))
    ends = many.groupBy("list", "root").agg(F.min(F.struct(*shape)).alias("x"), F.max(F.struct(*shape)).alias("y"))
    lead = ends.select("list", F.explode(F.array_distinct(F.array("x", "y"))).alias("x"), "root").select("list", "x.*", "root")
    # A leader leads a few of its lists: near classes share more, and fewer entries meet the leaders.
    lead = cut(lead.groupBy(*shape, "root").agg(F.array_sort(F.collect_set("list")).alias("pre"))
               .select(F.explode(F.slice("pre", 1, LED)).alias("list"), *shape, "root"))
    beside = cut(in_lists(classes.select(*shape, "pre"), "pre", lead, roots.select(F.col("node").alias("h"))))
    # A class gets its root once, not in every list.
    known = beside.where("maybe").join(roots, F.col("h") == F.col("node"), "left").select(*shape, "pre", "root")
    beside = known.unionByName(beside.where("not maybe").select(*shape, "pre", F.lit(None).cast("long").alias("root")))
    return _met(lead, beside.select(F.explode("pre").alias("list"), *shape, "root"), similarity)


def rare_word_pairs(classes: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Candidates (a, b) of different roots that share one of their rarest words."""
    shape = ["h", "n", *PARITIES]
    large = _large(roots)
    # Written once, so the joins below share what they read.
    held = stored(shared_lists(classes.select(*shape, "pre"), "pre", roots.select(F.col("node").alias("h"))))
    known = cut(held.where("maybe").join(roots, F.col("h") == F.col("node"), "left").join(large, F.col("root") == F.col("large"), "left")
                .select(*shape, "pre", "root", F.col("large").isNotNull().alias("large")))
    # Classes that are linked with none have no root.
    few = held.where("not maybe").select(*shape, "pre", F.lit(None).cast("long").alias("root")).unionByName(known.where("not large").drop("large"))
    entries = lambda q: _entries(q, *shape, "root")
    order = F.col("h_a") < F.col("h_b")
    found = []
    for k in range(ROUNDS):
        # Here most pairs share few lists, and the lists before would double what is shuffled.
        part = few.select(F.explode("pre").alias("list"), *shape, "root").where(F.pmod("list", F.lit(ROUNDS)) == k)
        found.append(cut(_met(part, part, similarity, order)))
    if not large.isEmpty():
        many = cut(entries(known.where("large")))
        beside = cut(entries(in_lists(few, "pre", many)))
        found.append(cut(_met(many, beside, similarity)))
        # Large components meet each other only in lists that hold two of them.
        shared = many.groupBy("list").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("list")
        both = many.join(shared, "list").select(many.columns)
        found.append(_met(both, both, similarity, order))
    pairs = found[0]
    for q in found[1:]:
        pairs = pairs.unionByName(q)
    return pairs.distinct()


def line_groups(docs: DataFrame, *, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The lines (doc_id, key, line, h, n, par), and of each class that occurs more
    than once or is near another: (h, n, par, root, keep), ``keep`` being the
    (key, line) that stays of its group."""
    lines = line_table(docs, id_col, text_col)
    table = line_table(docs, id_col, text_col, more=True, similarity=similarity)
    place, held = ["none", "doc_id", "key", "line"], [*PARITIES[1:], "sim", "pre", "rest"]
    table = table.withColumn("none", F.col("doc_id").isNull())
    classes = table.groupBy(*CLASS).agg(F.min(F.struct(*place, *held)).alias("x"), F.count("*").alias("c"))
    classes = stored(classes.select(*CLASS, *[F.col(f"x.{c}").alias(c) for c in place + held], "c"))
    if similarity < 1:
        links = _near(cut(_likely(cut(simhash_pairs(classes)), classes, similarity)), docs, classes, similarity, id_col, text_col)
        links = settled(links.unionByName(one_word_apart(classes)), EARLY_ROUNDS)
        for candidates, rounds in ((large_component_pairs, EARLY_ROUNDS), (rare_word_pairs, None)):
            more = _near(cut(candidates(classes, cut(least_of(links)), similarity)), docs, classes, similarity, id_col, text_col)
            links = settled(links.unionByName(more), rounds)
        roots = cut(least_of(links))
    else:
        roots = classes.where("false").select(F.col("h").alias("node"), F.col("h").alias("root"))
    slim = classes.select(*CLASS, F.struct(*place).alias("first"), "c")
    near = cut(passing(slim, roots.select(F.col("node").alias("h")), "h").join(roots, F.col("h") == F.col("node")).drop("node", "c"))
    keep = near.groupBy("root").agg(F.min("first").alias("keep"))
    near = near.join(keep, "root").select(*CLASS, "root", "keep")
    alone = slim.where("c > 1").join(roots, F.col("h") == F.col("node"), "left_anti").select(*CLASS, F.col("h").alias("root"), F.col("first").alias("keep"))
    return lines, near.unionByName(alone).withColumn("keep", F.struct("keep.key", "keep.line"))


def dropped_lines(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, key, lines): numbers of the lines to drop, of documents with any."""
    lines, groups = line_groups(docs, **options)
    groups = cut(groups)
    gone = passing(lines, groups, "h").join(groups, list(CLASS)).where(F.struct("key", "line") != F.col("keep"))
    return gone.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_set("line")).alias("lines")).select("doc_id", "key", "lines")


def without_lines(text: str | None, gone: set[int]) -> str | None:
    """The text without the lines of those numbers."""
    if not gone or text is None:
        return text
    return "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)


def _with_gone(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, lines): every row of ``docs`` with the lines that it loses."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_key(id_col, text_col).alias("key"))
    return rows.join(gone.select("key", "lines"), "key", "left").select("row", "lines")


def dedup(docs: DataFrame, *, similarity: float = SIMILARITY, id_col: str = "doc_id",
          text_col: str = "text", n_chars_col: str | None = "n_chars", drop_emptied: bool = True) -> DataFrame:
    """``docs`` with repeated lines dropped from the texts.

    All columns stay; a column ``n_chars_col``, if there, follows the text.
    A document all of whose lines were repeats of lines elsewhere is itself a
    repeat: it goes, unless ``drop_emptied`` is off.  Documents that had no
    words before stay as they were.
    """
    gone = dropped_lines(docs, similarity=similarity, id_col=id_col, text_col=text_col)
    cols, at = docs.columns, docs.columns.index(text_col)
    count = cols.index(n_chars_col) if n_chars_col in cols else None

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = list(batch.column(0).flatten())
            kinds = [f.type for f in batch.schema.field(0).type]
            old, lines = out[at].to_pylist(), batch.column(1).to_pylist()
            new = [without_lines(t, set(g)) if g else t for t, g in zip(old, lines)]
            out[at] = pa.array(new, kinds[at])
            if count is not None:
                out[count] = pa.array([len(n) if g and n is not None else c for n, g, c in zip(new, lines, out[count].to_pylist())], kinds[count])
            rows = pa.RecordBatch.from_arrays(out, names=cols)
            if drop_emptied:
                rows = rows.filter(pa.array([not g or bool(n and n.strip()) for n, g in zip(new, lines)], pa.bool_()))
            yield rows

    return _with_gone(docs, gone, id_col, text_col).mapInArrow(one, docs.schema)


def report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``id_col``, n_lines, n_dropped, dropped (line numbers), n_chars, text_sha256
    (of the text that stays) of every row."""
    gone = dropped_lines(docs, id_col=id_col, text_col=text_col, **options)
    q = _with_gone(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), gone, "doc_id", "text")
    q = q.select("row.doc_id", "row.text", "lines")
    schema = q.select(F.col("doc_id").alias(id_col), *[F.lit(None).cast(t).alias(c) for c, t in (
        ("n_lines", "long"), ("n_dropped", "long"), ("dropped", "string"), ("n_chars", "long"), ("text_sha256", "string"))]).schema

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            old, lines = batch.column(1).to_pylist(), [x or [] for x in batch.column(2).to_pylist()]
            new = [without_lines(t, set(g)) or "" for t, g in zip(old, lines)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([sum(bool(x) for x in (t or "").split("\n")) for t in old], pa.int64()),
                pa.array([len(g) for g in lines], pa.int64()), pa.array([",".join(map(str, g)) for g in lines], pa.string()),
                pa.array([len(t) for t in new], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string())],
                names=[id_col, "n_lines", "n_dropped", "dropped", "n_chars", "text_sha256"])

    return q.mapInArrow(one, schema)
