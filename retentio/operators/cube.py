"""Daily cube (A1–A4, G1): partial aggregates per day that answer any range.

A cell holds the rows, the sum and the customers of one day and one block of 32,768
customer numbers; customers are a bitmap, so ranges are answered by OR and sums
over cells and no order is read again.  Cells of the same day add up
(:func:`merge`), which takes late rows and makes the cube incremental.  The cube grows with days and
customers, not with orders: 4 KB a cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

CELL = ["day", "block"]


def daily_cube(facts: DataFrame, key: str, ts: str, amount: str) -> DataFrame:
    """(day, block, n, amount, members) of ``facts``: one aggregate, cells summed map-side.

    ``key`` is a number from 0; rows of a null key count but are nobody's.
    """
    k = F.col(key).cast("long")
    return facts.select(F.to_date(ts).alias("day"), F.bitmap_bucket_number(k).alias("block"), F.bitmap_bit_position(k).alias("_bit"),
                        F.col(amount).cast("decimal(18,2)").alias("_amount")).groupBy(*CELL).agg(
        F.count("*").alias("n"), F.sum("_amount").cast("decimal(38,2)").alias("amount"), F.bitmap_construct_agg("_bit").alias("members"))


def merge(*cubes: DataFrame) -> DataFrame:
    """Cells of several cubes over different rows, added up."""
    every = cubes[0]
    for c in cubes[1:]:
        every = every.unionByName(c)
    return every.groupBy(*CELL).agg(F.sum("n").alias("n"), F.sum("amount").cast("decimal(38,2)").alias("amount"),
                                    F.bitmap_or_agg("members").alias("members"))


def save_cube(cube: DataFrame, path: str) -> None:
    """Write the cube by day; days that it holds replace the stored ones."""
    (cube.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


def load_cube(spark: SparkSession, path: str) -> DataFrame:
    schema = "block bigint, n bigint, amount decimal(38,2), members binary, day date"
    return spark.read.schema(schema).parquet(path).select(*CELL, "n", "amount", "members")


def add_rows(spark: SparkSession, path: str, facts: DataFrame, key: str, ts: str, amount: str) -> None:
    """Add new (or late) rows to a stored cube: only the days they touch are read and written again."""
    ensure_checkpoint_dir(spark)
    new = daily_cube(facts, key, ts, amount).checkpoint()
    days = new.select("day").distinct()
    old = load_cube(spark, path).join(days, "day", "left_semi")
    save_cube(merge(old, new).checkpoint(), path)


def range_totals(cube: DataFrame, ranges: list[tuple[str, object, object]]) -> DataFrame:
    """(date_range, n, n_keys, amount) of each (name, first day, last day), both inclusive.

    Days are dates or Columns of one row (scalar subqueries); null means open.  A
    range without cells gives zeros.
    """
    day = F.col("day")
    as_col = lambda x: x if not hasattr(x, "isoformat") else F.lit(x)
    within = []
    for name, first, last in ranges:
        ok = day.isNotNull()
        ok = ok & (day >= as_col(first)) if first is not None else ok
        ok = ok & (day <= as_col(last)) if last is not None else ok
        within.append(F.when(ok, F.lit(name)))
    hit = cube.select(F.explode(F.array_compact(F.array(*within))).alias("date_range"), "block", "n", "amount", "members")
    blocks = hit.groupBy("date_range", "block").agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"),
                                                   F.bitmap_count(F.bitmap_or_agg("members")).alias("keys"))
    found = blocks.groupBy("date_range").agg(F.sum("n").alias("n"), F.sum("keys").alias("n_keys"), F.sum("amount").cast("double").alias("amount"))
    names = cube.sparkSession.createDataFrame([(name,) for name, _, _ in ranges], "date_range string")
    zero = F.lit(0).cast("long")
    return names.join(F.broadcast(found), "date_range", "left").select(
        "date_range", F.coalesce("n", zero).alias("n"), F.coalesce("n_keys", zero).alias("n_keys"), F.coalesce("amount", F.lit(0.0)).alias("amount"))
