"""Drift monitoring: PSI (Q3), prediction mean shift (Q4), KS (Q5), report (Q6).

Inputs are two DataFrames (baseline and current) with the same feature
columns — never driver arrays.  Decile edges of the baseline come from an
exact distributed quantile (or a bounded sketch); rows are binned by
counting the edges at or below the value, which keeps binning a JVM
expression.  Bin counts are a ``groupBy`` over (feature, bin): at most 10
rows per feature.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import DRIFT_ALARM, PRED_DRIFT_ALARM_PCT, drift_status
from .ranking import prefix_sums

PSI_FLOOR = 0.0001
BUCKETS = 10


def _known(c: str):
    return F.col(c).isNotNull() & ~F.isnan(c)


def _long(df: DataFrame, features, tag: str) -> DataFrame:
    """Unpivot the feature columns to (feature, x) rows tagged with ``tag``."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x"))
        for f in features])).alias("kv"), F.lit(tag).alias("side")).select(
        "kv.feature", "kv.x", "side")


def exact_quantiles(long: DataFrame, probs, group: str = "feature", value: str = "x") -> DataFrame:
    """Exact linear-interpolation quantiles per group: (group, edges array).

    Distributed and memory-bounded: values collapse to distinct
    (group, value, count) rows, ``prefix_sums`` gives each distinct value the
    0-based positions it covers, and only the rows covering one of the
    2·len(probs) needed positions survive — no task ever holds a whole group.
    edge = v[lo] + (v[hi] − v[lo]) · (h − lo), h = (n − 1)·p.
    """
    counts = long.groupBy(group, value).agg(F.count(F.lit(1)).alias("_cnt"))
    cum = prefix_sums(counts, [value], {"c": F.col("_cnt")}, partition_by=[group])
    n = F.col("_group_total_c")
    start, end = F.col("cum_c") - F.col("_cnt"), F.col("cum_c") - 1
    need = []
    for i, p in enumerate(probs):
        h = (n - 1).cast("double") * F.lit(float(p))
        lo = F.floor(h)
        hi = F.least(lo + 1, n - 1)
        need += [F.struct(F.lit(i).alias("i"), F.lit("lo").alias("side"), lo.alias("pos"), h.alias("h")),
                 F.struct(F.lit(i).alias("i"), F.lit("hi").alias("side"), hi.alias("pos"), h.alias("h"))]
    hit = cum.select(group, value, F.filter(F.array(*need),
                                            lambda t: (t["pos"] >= start) & (t["pos"] <= end)).alias("t"))
    hit = hit.filter(F.size("t") > 0).select(group, value, F.explode("t").alias("t"))
    per = hit.groupBy(group, F.col("t.i").alias("i")).agg(
        F.max(F.when(F.col("t.side") == "lo", F.col(value))).alias("v_lo"),
        F.max(F.when(F.col("t.side") == "hi", F.col(value))).alias("v_hi"),
        F.max("t.h").alias("h"))
    edge = F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * (F.col("h") - F.floor("h"))
    arr = F.array_sort(F.collect_list(F.struct(F.col("i"), edge.alias("e"))))
    return per.groupBy(group).agg(F.transform(arr, lambda s: s["e"]).alias("edges"))


def quantile_edges(df: DataFrame, features, buckets: int = BUCKETS,
                   exact: bool = True, accuracy: int = 100000) -> DataFrame:
    """Inner decile edges of each feature: (feature, edges array<double>).

    ``exact`` uses ``exact_quantiles`` (distributed, numpy's linear rule);
    ``exact=False`` uses ``percentile_approx`` (one pass, bounded sketch).
    """
    probs = [i / buckets for i in range(1, buckets)]
    long = _long(df, features, "base").filter(_known("x"))
    if exact:
        return exact_quantiles(long, probs)
    pct = F.percentile_approx(F.col("x"), F.array(*map(F.lit, probs)), accuracy)
    return long.groupBy("feature").agg(pct.alias("edges"))


def psi(baseline: DataFrame, current: DataFrame, features, buckets: int = BUCKETS,
        exact: bool = True) -> DataFrame:
    """Q3: PSI per feature on bucket *shares* (first/last bucket open).

    bucket(x) = number of inner edges <= x, so buckets are left-closed like
    ``numpy.histogram``; empty shares are floored at 0.0001.  The edges (a
    few per feature) enter as one map-valued scalar, both sides are binned in
    one scan and the grid of bins is made of constants.  Null and NaN values
    are in no bin; their shares are ``missing_base`` and ``missing_cur``.  A
    side without values gives a null PSI and the status ``NO DATA``.
    """
    edges = quantile_edges(baseline, features, buckets, exact).select(
        F.map_from_entries(F.collect_list(F.struct("feature", "edges")))).scalar()
    both = _long(baseline, features, "base").unionByName(_long(current, features, "cur"))
    both = both.withColumn("e", edges).withColumn("e", F.col("e")[F.col("feature")])
    binned = both.select("feature", "side", F.when(_known("x"), F.size(F.filter("e", lambda e: e <= F.col("x")))).alias("bin"))
    in_side = lambda s, k: F.count_if((F.col("side") == s) & k)
    per = binned.groupBy("feature").agg(
        *[in_side(s, F.col("bin") == b).alias(f"{s}_{b}") for s in ("base", "cur") for b in range(buckets)],
        *[F.try_divide(in_side(s, F.col("bin").isNull()), in_side(s, F.lit(True))).alias(f"missing_{s}") for s in ("base", "cur")])
    total = {s: reduce(add, [F.col(f"{s}_{b}") for b in range(buckets)]) for s in ("base", "cur")}
    share = lambda s, b: F.try_divide(F.col(f"{s}_{b}"), total[s])
    floor = lambda c: F.when(c == 0, F.lit(PSI_FLOOR)).otherwise(c)
    terms = [(floor(share("cur", b)) - floor(share("base", b))) * F.log(floor(share("cur", b)) / floor(share("base", b)))
             for b in range(buckets)]
    out = per.select("feature", reduce(add, terms).alias("psi"), "missing_base", "missing_cur")
    return out.withColumn("status", F.when(F.col("psi").isNull(), F.lit("NO DATA")).otherwise(drift_status(F.col("psi"))))


def mean_shift(baseline: DataFrame, current: DataFrame, col: str,
               alarm_pct: float = PRED_DRIFT_ALARM_PCT, mean=None) -> DataFrame:
    """Q4: |mean_cur − mean_base| / mean_base · 100 and the alarm flag.

    Both means are one-row aggregates; the current one enters as a
    struct-valued scalar subquery, so no join is planned.  ``mean`` takes a
    column name and gives the aggregate (default: the average as a double).
    """
    mean = mean or (lambda c: F.avg(F.col(c).cast("double")))
    b = baseline.agg(mean(col).alias("baseline_mean"), F.count(F.lit(1)).alias("n_baseline"))
    c = current.select(F.struct(mean(col).alias("m"), F.count(F.lit(1)).alias("n"))).scalar()
    j = b.select("*", c.getField("m").alias("current_mean"), c.getField("n").alias("n_current"))
    d = F.try_divide(F.abs(F.col("current_mean") - F.col("baseline_mean")) * 100.0,
                     F.col("baseline_mean"))
    return j.withColumn("drift_pct", d).withColumn("alarm", d > F.lit(alarm_pct))


def ks_statistic(baseline: DataFrame, current: DataFrame, col: str) -> DataFrame:
    """Q5: two-sample KS statistic max |F_base(v) − F_cur(v)|.

    Values are first collapsed to distinct (value, n_base, n_cur) — a hot
    value becomes one row — then exact running counts come from
    ``prefix_sums`` (range buckets, no single-task window).  Null and NaN
    values don't count; a side without values gives null.
    """
    u = (baseline.select(F.col(col).cast("double").alias("v"), F.lit(1).alias("b"), F.lit(0).alias("c"))
         .unionByName(current.select(F.col(col).cast("double").alias("v"), F.lit(0).alias("b"),
                                     F.lit(1).alias("c")))
         .filter(_known("v")))
    g = u.groupBy("v").agg(F.sum("b").alias("nb"), F.sum("c").alias("nc"))
    cum = prefix_sums(g, ["v"], {"b": F.col("nb"), "c": F.col("nc")})
    d = F.abs(F.try_divide(F.col("cum_b"), F.col("_group_total_b")) - F.try_divide(F.col("cum_c"), F.col("_group_total_c")))
    none = F.lit(0).cast("long")
    return cum.agg(F.max(d).alias("ks_statistic"),
                   F.coalesce(F.max("_group_total_b"), none).alias("n_baseline"),
                   F.coalesce(F.max("_group_total_c"), none).alias("n_current"))


def monitoring_report(psi_df: DataFrame, shift_df: DataFrame, quality_df: DataFrame,
                      ks_df: DataFrame | None = None) -> DataFrame:
    """Q6: one row with the statuses, the KS statistic and ``retrain_required``."""
    q = quality_df.agg(F.bool_and("ok").alias("quality_ok"))
    p = psi_df.select(F.max("psi")).scalar()
    s = shift_df.select(F.first("alarm")).scalar()
    k = ks_df.select(F.max("ks_statistic")).scalar() if ks_df is not None else F.lit(None).cast("double")
    r = q.select("quality_ok", p.alias("max_psi"), s.alias("prediction_drift"), k.alias("ks_statistic"))
    return r.withColumns({
        "feature_drift": F.col("max_psi") > F.lit(DRIFT_ALARM),
        "retrain_required": (F.col("max_psi") > F.lit(DRIFT_ALARM)) | F.col("prediction_drift")
        | ~F.col("quality_ok"),
    })
