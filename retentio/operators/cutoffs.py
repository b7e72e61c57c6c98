"""Point-in-time features at many cutoffs (P10–P12, M1): prefix sums per key and day, read as of each cutoff.

Facts are first summed per key and day (a key with a third of all rows becomes one row a
day), then accumulated per key.  A cutoff's features are the sums before it, found as
the last day before it; trailing windows and the label are differences of such sums, so
no fact is read once per cutoff and no feature sees a fact on or after its cutoff.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cutoff_features(facts: DataFrame, key: str, ts: str, amount: str, cutoffs: list[Column],
                    trailing_months: int = 12, horizon_months: int = 12) -> DataFrame:
    """(key, cutoff, n_before, spend_before, n_trailing, spend_trailing, recency_days, label).

    ``cutoffs`` are date Columns of one row (literals or scalar subqueries).  A key has a row for each cutoff
    before which it has facts; ``label`` is 1 where it has none in the ``horizon_months`` from
    the cutoff on.  Facts without a key or a time are left out.
    """
    day = F.to_date(ts)
    daily = facts.where(F.col(key).isNotNull() & day.isNotNull()).groupBy(F.col(key).alias("_k"), day.alias("_day")).agg(
        F.count("*").alias("_n"), F.sum(F.col(amount).cast("decimal(18,2)")).alias("_s"))
    w = Window.partitionBy("_k").orderBy("_day")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    cum = daily.select("_k", "_day", F.lead("_day").over(w).alias("_next"), F.sum("_n").over(upto).alias("n"),
                       F.sum("_s").over(upto).cast("decimal(38,2)").alias("s"))
    point = lambda c, kind, at: F.struct(c.cast("date").alias("cutoff"), F.lit(kind).alias("kind"), at.cast("date").alias("at"))
    points = F.array(*[p for c in cutoffs for p in (point(c, "now", c), point(c, "old", F.add_months(c, -trailing_months)),
                                                     point(c, "end", F.add_months(c, horizon_months)))])
    # A day's sums hold for the moments after it, up to the next day with facts.
    hit = cum.withColumn("_points", points)
    hit = hit.select("_k", "_day", "n", "s", F.explode(F.filter("_points", lambda p: (p["at"] > F.col("_day")) & (
        F.col("_next").isNull() | (p["at"] <= F.col("_next"))))).alias("p"))
    of = lambda kind, c: F.max(F.when(F.col("p.kind") == kind, F.col(c)))
    per = hit.groupBy("_k", F.col("p.cutoff").alias("cutoff")).agg(
        of("now", "n").alias("n"), of("now", "s").alias("s"), of("old", "n").alias("n0"), of("old", "s").alias("s0"),
        of("end", "n").alias("n1"), of("now", "_day").alias("last")).where("n is not null")
    zero = F.lit(0).cast("long")
    return per.select(
        F.col("_k").alias(key), "cutoff", F.col("n").alias("n_before"), F.col("s").cast("double").alias("spend_before"),
        (F.col("n") - F.coalesce("n0", zero)).alias("n_trailing"),
        (F.col("s") - F.coalesce("s0", F.lit(0).cast("decimal(38,2)"))).cast("double").alias("spend_trailing"),
        F.datediff("cutoff", "last").alias("recency_days"), F.when(F.col("n1") > F.col("n"), 0).otherwise(1).alias("label"))
