"""Exact global ranks, running sums, neighbours and fills without a hot task.

A window over a whole table, or over a key that holds a third of all rows, is
one task.  The functions here shuffle the rows by range first: Spark's range
partitioner deals (group, order) out to buckets of about equal size, so a hot group
is split, and each bucket is sorted.  The result is written once to the checkpoint
folder together with every row's place (bucket and position in one long); ordinary
Spark windows then run within (group, bucket), and what crosses a bucket's border
comes from a small table of bucket totals or edges.  The cost of a row does not
depend on the number of buckets, rows stay in the JVM, and where the borders fall
has no bearing on the result.

``order`` lists ascending Columns or names (negate numbers for descending
order); it must end with a unique key where ties matter.  Nulls come first.  A
null group is a group of its own.  The range shuffle runs when a function is called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Bits of a row's position within its bucket in ``monotonically_increasing_id``.
POSITION_BITS = 33


def _columns(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in (cols or [])]


def _ranged(df: DataFrame, order: list, partition_by: list | None, buckets: int | None) -> DataFrame:
    """Adds ``_g`` (group), ``_m`` (place in the whole order, with gaps) and ``_b`` (bucket).

    The rows are range-partitioned and sorted by (group, order) and written once:
    bounds that Spark draws again for another read would be others.
    """
    spark = df.sparkSession
    n = buckets or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    g = F.struct(*_columns(partition_by)) if partition_by else F.struct(F.lit(0).alias("all"))
    ensure_checkpoint_dir(spark)
    keyed = df.withColumns({"_g": g, "_o": F.struct(*_columns(order))})
    ranged = keyed.repartitionByRange(n, "_g", "_o").sortWithinPartitions("_g", "_o").drop("_o")
    placed = ranged.withColumn("_m", F.monotonically_increasing_id()).checkpoint()
    return placed.withColumn("_b", F.shiftright("_m", POSITION_BITS))


_INNER = ["_g", "_b"]


def _inside():
    return Window.partitionBy(*_INNER).orderBy("_m")


def _before():
    return Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)


def prefix_sums(df: DataFrame, order: list, weights: dict | None = None,
                partition_by: list | None = None, num_partitions: int | None = None,
                prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums of integer ``weights`` in ``order``.

    ``weights`` maps output suffix to an integer Column; the default counts
    rows (``{prefix}rows``, the row number).  ``partition_by`` restarts the
    sums per group; ``_group_total_<name>`` is the group's sum.
    """
    weights = weights or {"rows": F.lit(1)}
    base = df.withColumns({f"_w_{n}": w.cast("long") for n, w in weights.items()})
    base = _ranged(base, order, partition_by, num_partitions)
    totals = base.groupBy(*_INNER).agg(*[F.sum(f"_w_{n}").alias(f"_t_{n}") for n in weights])
    offsets = totals.select(*_INNER, *[F.coalesce(F.sum(f"_t_{n}").over(_before()), F.lit(0)).alias(f"_off_{n}") for n in weights],
                            *[F.sum(f"_t_{n}").over(Window.partitionBy("_g")).alias(f"_group_total_{n}") for n in weights])
    # Without groups the offsets are one row per bucket, a bound that is known.
    offsets = offsets if partition_by else F.broadcast(offsets)
    run = _inside().rowsBetween(Window.unboundedPreceding, 0)
    local = base.withColumns({f"_loc_{n}": F.sum(f"_w_{n}").over(run) for n in weights})
    out = local.join(offsets, _INNER).withColumns({f"{prefix}{n}": F.col(f"_off_{n}") + F.col(f"_loc_{n}") for n in weights})
    return out.select(*df.columns, *[f"{prefix}{n}" for n in weights], *[f"_group_total_{n}" for n in weights])


def row_number_global(df: DataFrame, order: list, partition_by: list | None = None,
                      name: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """Exact ``row_number()`` plus the group size ``n_in_group``.

    A row's number follows from its place and its bucket's offset, without a window
    over the rows.
    """
    base = _ranged(df, order, partition_by, num_partitions)
    starts = base.groupBy(*_INNER).agg(F.min("_m").alias("_start"), F.count("*").alias("_n"))
    offsets = starts.select(*_INNER, (F.coalesce(F.sum("_n").over(_before()), F.lit(0)) - F.col("_start") + 1).alias("_shift"),
                            F.sum("_n").over(Window.partitionBy("_g")).alias("n_in_group"))
    offsets = offsets if partition_by else F.broadcast(offsets)
    out = base.join(offsets, _INNER).withColumn(name, F.col("_m") + F.col("_shift"))
    return out.select(*df.columns, name, "n_in_group")


def ntile_from_rank(rank: Column, n: Column, tiles: int) -> Column:
    """``ntile(tiles)`` from an exact 1-based rank and the group size.

    Same assignment as SQL ntile: the first ``n % tiles`` tiles get one extra row.
    """
    q = F.floor(n / tiles).cast("long")
    rem = (n % tiles).cast("long")
    big = rem * (q + 1)
    return F.when(rank <= big, F.floor((rank - 1) / (q + 1)) + 1).otherwise(
        rem + F.floor((rank - big - 1) / F.greatest(q, F.lit(1))) + 1).cast("int")


def _edges(base: DataFrame, *aggs: Column) -> DataFrame:
    """Aggregates per bucket of the groups that may lie in several: each bucket's first and last.

    There are at most two rows per bucket: the tables may be broadcast.
    """
    ends = base.groupBy("_b").agg(F.min("_m").alias("lo"), F.max("_m").alias("hi"))
    ends = ends.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias("_m"))
    groups = base.join(F.broadcast(ends), "_m").select(*_INNER).distinct()
    return base.join(F.broadcast(groups), _INNER, "left_semi").groupBy(*_INNER).agg(*aggs)


def neighbours(df: DataFrame, order: list, cols, partition_by: list | None = None,
               num_partitions: int | None = None, prev: bool = True, nxt: bool = True,
               number: str | None = None) -> DataFrame:
    """Exact ``lag(c)`` / ``lead(c)`` over ``PARTITION BY partition_by ORDER BY order``.

    Adds ``prev_<c>`` / ``next_<c>`` and, with ``number`` set, that column:
    the 1-based ``row_number()`` within the group.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    base = _ranged(df, order, partition_by, num_partitions)
    payload = F.struct(*[F.col(c) for c in cols])
    w = Window.partitionBy("_g").orderBy("_b")
    edges = _edges(base, F.min_by(payload, F.col("_m")).alias("first"), F.max_by(payload, F.col("_m")).alias("last"),
                   F.count("*").alias("n"))
    edges = edges.select(*_INNER, F.lag("last").over(w).alias("_before"), F.lead("first").over(w).alias("_after"),
                         F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_rows"))
    inner = _inside()
    out = base.withColumns({"_rn": F.row_number().over(inner), "_end": F.lead(F.lit(1)).over(inner).isNull(),
                            **({f"prev_{c}": F.lag(c).over(inner) for c in cols} if prev else {}),
                            **({f"next_{c}": F.lead(c).over(inner) for c in cols} if nxt else {})})
    out = out.join(F.broadcast(edges), _INNER, "left")
    if prev:
        out = out.withColumns({f"prev_{c}": F.when(F.col("_rn") == 1, F.col("_before")[c]).otherwise(F.col(f"prev_{c}")) for c in cols})
    if nxt:
        out = out.withColumns({f"next_{c}": F.when(F.col("_end"), F.col("_after")[c]).otherwise(F.col(f"next_{c}")) for c in cols})
    if number:
        out = out.withColumn(number, (F.col("_rn") + F.coalesce("_rows", F.lit(0))).cast("long"))
    return out.drop("_g", "_m", "_b", "_rn", "_end", "_before", "_after", "_rows")


def forward_fill(df: DataFrame, order: list, cols, partition_by: list | None = None,
                 num_partitions: int | None = None) -> DataFrame:
    """``last(c, ignorenulls) OVER (PARTITION BY p ORDER BY o ROWS UNBOUNDED
    PRECEDING)`` for each of ``cols``, exactly."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    base = _ranged(df, order, partition_by, num_partitions)
    edges = _edges(base, *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_m"))).alias(f"_last_{c}") for c in cols])
    edges = edges.select(*_INNER, *[F.last(f"_last_{c}", ignorenulls=True).over(_before()).alias(f"_carry_{c}") for c in cols])
    run = _inside().rowsBetween(Window.unboundedPreceding, 0)
    out = base.withColumns({c: F.last(c, ignorenulls=True).over(run) for c in cols}).join(F.broadcast(edges), _INNER, "left")
    return out.withColumns({c: F.coalesce(c, f"_carry_{c}") for c in cols}).select(*df.columns)
