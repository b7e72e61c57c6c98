"""Stored baseline profiles (A14, Q3–Q5): a mergeable quantile sketch per day and feature.

A profile row holds a day's rows, missing values and KLL sketch of one feature.  Days add up
without the data, so a baseline of many days is a merge of small rows, and the drift
of a new day reads that day only.  With ``K`` items a sketch's ranks are within
0.04 % (99 % confidence, one-sided; :func:`rank_error` for other sizes) whatever the rows;
up to ``K`` rows it is exact.  The exact measures stay in :mod:`.drift`.

Buckets are right-closed here (a value equal to an edge belongs below it), as
ranks of sketches are.  Null and NaN values count as missing.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import drift_status
from .drift import BUCKETS, PSI_FLOOR

#: Items of a sketch.
K = 16_384
#: Points at which the distributions of two profiles are compared.
GRID = 200


def rank_error(k: int = K) -> float:
    """Normalised rank error of a sketch of size ``k`` (99 % confidence)."""
    return 2.296 / k ** 0.9021


def daily_profile(df: DataFrame, day: Column, features, k: int = K) -> DataFrame:
    """(day, feature, n, missing, sketch): one aggregate pass, sketches built map-side."""
    held = df.select(day.alias("day"), *[F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias(f) for f in features])
    per = held.groupBy("day").agg(*[x for f in features for x in (
        F.count(f).alias(f"n_{f}"), F.count_if(F.col(f).isNull()).alias(f"m_{f}"),
        F.kll_sketch_agg_double(F.col(f), F.lit(k)).alias(f"s_{f}"))])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"n_{f}").alias("n"), F.col(f"m_{f}").alias("missing"),
                              F.col(f"s_{f}").alias("sketch")) for f in features])
    return per.select("day", F.explode(rows).alias("r")).select("day", "r.*")


def merged(profile: DataFrame) -> DataFrame:
    """(feature, n, missing, sketch) of all days of a profile; days without values are left out of the sketch."""
    return profile.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("missing").alias("missing"),
                                          F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("sketch"))).alias("sketch"))


def _quantiles(sketch: str, probs: list[float]) -> Column:
    return F.kll_sketch_get_quantile_double(F.col(sketch), F.array(*map(F.lit, probs)))


def drift(baseline: DataFrame, current: DataFrame, buckets: int = BUCKETS, grid: int = GRID) -> DataFrame:
    """(feature, psi, ks, missing_base, missing_cur, status) from two merged profiles.

    The KS statistic is the greatest difference at the ``grid`` quantiles of either side, so it may miss
    1 / grid of the true one beside the sketches' rank error.  A side without values gives null and NO DATA.
    """
    b, c = baseline.toDF("feature", "nb", "mb", "sb"), current.toDF("feature", "nc", "mc", "sc")
    some = (F.coalesce("nb", F.lit(0)) > 0) & (F.coalesce("nc", F.lit(0)) > 0)
    j = b.join(c, "feature", "full")
    probs, points = [i / buckets for i in range(1, buckets)], [i / grid for i in range(1, grid + 1)]
    # Ranks are asked at constants: a few hundred values a feature pass through the driver.
    values = j.where(some).select("feature", _quantiles("sb", probs).alias("edges"),
                                  F.array_union(_quantiles("sb", points), _quantiles("sc", points)).alias("at")).collect()

    def rank(sketch: str, of: str) -> Column:
        out = F.lit(None).cast("array<double>")
        for r in values:
            at = F.kll_sketch_get_rank_double(F.col(sketch), F.array(*[F.lit(v) for v in r[of]]))
            out = F.when(F.col("feature") == r.feature, at).otherwise(out)
        return out

    q = j.where(some).select("feature", rank("sb", "edges").alias("eb"), rank("sc", "edges").alias("ec"),
                             F.array_max(F.zip_with(rank("sb", "at"), rank("sc", "at"), lambda x, y: F.abs(x - y))).alias("ks"))
    below = lambda s, i: F.lit(0.0) if i == 0 else F.lit(1.0) if i == buckets else F.col(s)[i - 1]
    floor = lambda x: F.when(x <= 0, F.lit(PSI_FLOOR)).otherwise(x)
    share = lambda s, i: floor(below(s, i + 1) - below(s, i))
    psi = reduce(add, [(share("ec", i) - share("eb", i)) * F.log(share("ec", i) / share("eb", i)) for i in range(buckets)])
    out = j.select("feature", F.try_divide("mb", F.col("nb") + F.col("mb")).alias("missing_base"),
                   F.try_divide("mc", F.col("nc") + F.col("mc")).alias("missing_cur")).join(q.select("feature", psi.alias("psi"), "ks"), "feature", "left")
    return out.withColumn("status", F.when(F.col("psi").isNull(), F.lit("NO DATA")).otherwise(drift_status(F.col("psi")))).select(
        "feature", "psi", "ks", "missing_base", "missing_cur", "status")
