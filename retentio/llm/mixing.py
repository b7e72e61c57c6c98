"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a shuffled order (by a keyed
digest of the document id), repeated for up to ``max_epochs`` passes.  A
document's virtual finish time is the cumulative number of its source's
tokens, itself included, divided by the source's target.  All queues are
merged by finish time (a global range sort) and the mix is cut where the
budget of tokens is reached, so every source's share is near its target.

Targets: the sources' weights share the budget, but a target stops at
``max_epochs`` times its source's size and the excess is shared again by
weight until no target is above that.

Everything is DataFrame code.  Running totals never put a source or the whole
table into one task: rows are dealt to buckets (by digest within a source, of about
``BUCKET_ROWS`` rows; by Spark's range partitioner for the global order), the
buckets' totals are summed up in a small table, and windows run within a bucket.

Null or empty texts have size 0: they take none of the budget.  A null source
is a source of its own, ordered last.  Repeated rows are separate documents.
An empty table gives an empty mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BUCKET_ROWS = 20_000

#: ASCII whitespace separates words; every other run of characters is one.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources in code point order, null last, weigh ``weights``, repeating.
    Every round of the loop is one aggregate over the table of sources; it
    ends when no further target is above its limit.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]),
                     (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    t = cut(sizes.withColumn("rank", rank).withColumn("w", w.cast("long"))
            .withColumn("cap", F.col("source_size") * max_epochs))
    budget = t.agg(F.sum("source_size")).first()[0] or 0
    capped, seen = F.lit(False), None
    while True:
        now = t.agg(F.sum(F.when(~capped, F.col("w"))), F.sum(F.when(capped, F.col("cap")))).first()
        if now == seen or not now[0]:
            break
        seen = now
        rest, weight = budget - (now[1] or 0), now[0]
        capped = F.col("w") * F.lit(rest) > F.col("cap") * F.lit(weight)
    share = F.col("w") * F.lit(float(rest)) / F.lit(float(weight)) if seen else F.lit(0.0)
    return t.select("source", "source_size",
                    F.when(capped, F.col("cap").cast("double")).otherwise(share).alias("target"))


def _running(rows: DataFrame, keys: list[str], bucket: str, order: list[str]) -> DataFrame:
    """Adds ``upto``, the running sum of size per ``keys`` by (bucket, order),
    and ``pos``, the row's number in its bucket.

    Only the table of bucket totals is held by one task per key; the rows
    stay in their buckets.
    """
    totals = (rows.groupBy(*[F.col(k).alias("_" + k) for k in keys], F.col(bucket).alias("_b"))
              .agg(F.sum("size").alias("_t")))
    before = (Window.partitionBy(*["_" + k for k in keys]).orderBy("_b")
              .rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.withColumn("_before", F.coalesce(F.sum("_t").over(before), F.lit(0))).drop("_t")
    same = [rows[k].eqNullSafe(totals["_" + k]) for k in keys] + [rows[bucket] == totals["_b"]]
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    return (rows.join(totals, same)
            .withColumn("upto", F.col("_before") + F.sum("size").over(
                inside.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("pos", F.row_number().over(inside))
            .drop("_before", "_b", *["_" + k for k in keys]))


def _fair_queue(sized: DataFrame, weights: tuple[int, ...], max_epochs: int, seed: str) -> DataFrame:
    """(id, source, size) rows to (id, source, size, source_size, target, copies, taken)."""
    # The shuffled position is a pure function of the id: reruns agree.
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    sized = cut(sized.withColumn("h", digest))
    sums = cut(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")))
    n_rows, budget = sums.agg(F.sum("n"), F.sum("source_size")).first()
    n_rows, budget = n_rows or 0, budget or 0
    targets = source_targets(sums.select("source", "source_size"), weights, max_epochs).withColumnRenamed("source", "_s")
    digits = max(1, math.ceil(math.log(max(1.0, n_rows / BUCKET_ROWS), 16)))
    queued = _running(sized.withColumn("b", F.conv(F.substring("h", 1, digits), 16, 10).cast("long")),
                      ["source"], "b", ["h", "size"])
    finish = (F.col("epoch") * F.col("source_size") + F.col("end")).cast("double") / F.col("target")
    copies = cut(queued.withColumnsRenamed({"upto": "end", "pos": "twin"})
                 .join(targets, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
                 .withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(max_epochs)])))
                 .withColumn("finish", F.when(F.col("target") > 0, finish).otherwise(F.lit(0.0))))
    # Global order by finish time: a range shuffle, written once with every row's place, so
    # the buckets' borders stay the same for totals and rows.
    order = ["finish", "source", "h", "epoch", "twin"]
    n_buckets = max(2, int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = cut(copies.repartitionByRange(n_buckets, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()))
    merged = _running(ranged.withColumn("g", F.shiftright("place", 33)), [], "g", ["place"])
    kept = F.col("upto") <= F.lit(budget)
    return (merged.groupBy("id", "source", "size", "source_size", "target", "b", "twin")
            .agg(F.sum(kept.cast("long")).alias("copies"))
            .select("id", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def take(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
         seed: str = "mix", id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source") -> DataFrame:
    """What the mix takes of every row of ``docs``.

    Returns ``id_col``, source, size, source_size, target, copies, taken: the
    whole copies of the document in the mix and their words.
    """
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                        n_words(F.col(text_col).cast("string")).alias("size"))
    return _fair_queue(sized, weights, max_epochs, seed).withColumnRenamed("id", id_col)


def mix(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: str = "mix", id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """The documents of the mix with a column ``copies``: how often each is used.

    Rows that repeat an id within a source are one document of their summed
    size and share its copies.  An existing column ``copies`` is replaced.
    """
    i, s = F.col(id_col), F.col(source_col).cast("string")
    sized = (docs.select(i.alias("id"), s.alias("source"), n_words(F.col(text_col).cast("string")).alias("size"))
             .groupBy("id", "source").agg(F.sum("size").alias("size")))
    taken = (_fair_queue(sized, weights, max_epochs, seed).where("copies > 0")
             .select(F.col("id").alias("_id"), F.col("source").alias("_source"), F.col("copies").alias("_copies")))
    docs = docs.drop("copies")
    same = docs[id_col].eqNullSafe(taken["_id"]) & docs[source_col].cast("string").eqNullSafe(taken["_source"])
    return docs.join(taken, same).select(*[docs[c] for c in docs.columns], taken["_copies"].alias("copies"))
