"""KPI and segment aggregates (A1–A12), filters (P26), top-k and samples.

All aggregates are single ``groupBy().agg()`` passes: Spark plans a partial
(map-side) aggregate, one exchange on the group key and a final aggregate,
so a hot group never lands whole in one task.  Money totals are summed as
decimals so the result does not depend on partition order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import np_round
from ..functions.rules import tenure_band, tenure_band_order


def rate(cond: Column) -> Column:
    """A2/A3: share of rows where ``cond`` holds (double, exact)."""
    return F.sum(F.when(cond, 1).otherwise(0)).cast("double") / F.count(F.lit(1))


def money_avg(c) -> Column:
    """Exact mean of a 2-decimal money column (decimal sum / count)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast("decimal(18,2)")).cast("double") / F.count(col)


def churn_rate_by(df: DataFrame, by, label: str = "label") -> DataFrame:
    """A5: per group customers, churned and churn % (numpy-rounded to 1 dp)."""
    by = [by] if isinstance(by, str) else list(by)
    agg = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_customers"),
                              F.sum(F.col(label).cast("long")).alias("churned"))
    return agg.withColumn(
        "churn_rate", np_round(F.col("churned") / F.col("n_customers") * 100.0, 1))


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Count per value, most frequent first (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), col)


def mean_by_tenure_band(df: DataFrame, tenure: str, value: str) -> DataFrame:
    """Mean of ``value`` per right-closed tenure band; empty bands omitted."""
    b = df.select(tenure_band(F.col(tenure)).alias("tenure_band"), F.col(value).alias("v"))
    return (b.filter(F.col("tenure_band").isNotNull())
            .groupBy("tenure_band")
            .agg(F.count(F.lit(1)).alias("n_customers"),
                 (F.sum(F.col("v").cast("long")).cast("double") / F.count(F.lit(1))).alias("churn_rate"))
            .withColumn("band_order", tenure_band_order(F.col("tenure_band")).cast("int"))
            .orderBy("band_order"))


def segment_metrics(df: DataFrame, segment: str, charge: str, tenure: str,
                    label: str, tickets: str | None = None) -> DataFrame:
    """A8 + A9 in one groupBy: counts, churn rate, mean charge/tenure/tickets."""
    aggs = [
        F.count(F.lit(1)).alias("n_customers"),
        F.sum(F.col(label).cast("long")).alias("churned"),
        (F.sum(F.col(tenure).cast("long")).cast("double") / F.count(F.lit(1))).alias("avg_tenure"),
        F.avg(F.col(charge)).alias("avg_monthly_charges"),
    ]
    if tickets:
        aggs.append((F.sum(F.col(tickets).cast("long")).cast("double")
                     / F.count(F.lit(1))).alias("avg_tickets"))
    g = df.groupBy(segment).agg(*aggs)
    return g.withColumn("churn_rate", F.col("churned").cast("double") / F.col("n_customers"))


def group_means(df: DataFrame, by: str, cols, digits: int | None = 1) -> DataFrame:
    """A10: wide mean of a feature list per group, optionally numpy-rounded."""
    aggs = []
    for c in cols:
        m = F.avg(F.col(c).cast("double"))
        aggs.append((np_round(m, digits) if digits is not None else m).alias(f"avg_{c}"))
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *aggs)


def histogram(df: DataFrame, value: str, bins: int = 40, lo: float = 0.0,
              hi: float = 1.0, by: str | None = None) -> DataFrame:
    """Fixed-width histogram over [lo, hi]; the top edge falls in the last bin.

    Values below or above the range count in the first or last bin, null and
    NaN in a bin of their own (null).
    """
    width = (hi - lo) / bins
    v = F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), F.col(value).cast("double")))
    b = F.least(F.floor((v - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    b = F.when(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")), b)
    keys = ([by] if by else []) + ["bin"]
    return (df.select(*([F.col(by)] if by else []), b.alias("bin"))
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("bin_lo", F.lit(lo) + F.col("bin") * F.lit(width)))


def filter_customers(df: DataFrame, contracts=None, tenure_range=None, tiers=None,
                     contract_col: str = "contract_type", tenure_col: str = "tenure_months",
                     tier_col: str = "risk_tier") -> DataFrame:
    """Contract IN list AND tenure BETWEEN (inclusive) AND tier IN list.

    Each filter applies only when given and when its column exists, as the
    reference's sidebar does.  The predicate is one Filter Catalyst can push
    into the scan when the columns come from parquet.
    """
    cond = F.lit(True)
    if contracts is not None and contract_col in df.columns:
        cond = cond & F.col(contract_col).isin(list(contracts))
    if tenure_range is not None and tenure_col in df.columns:
        cond = cond & F.col(tenure_col).between(*tenure_range)
    if tiers is not None and tier_col in df.columns:
        cond = cond & F.col(tier_col).isin(list(tiers))
    return df.filter(cond)


def top_k(df: DataFrame, k: int, order, columns=None) -> DataFrame:
    """``orderBy(...).limit(k)`` — Spark plans TakeOrderedAndProject,
    a per-partition heap of k rows merged on the driver (bounded by k)."""
    out = df.orderBy(*order).limit(k)
    return out.select(*columns) if columns else out


def last_n_by_time(df: DataFrame, ts: str, n: int, partition_by=None) -> DataFrame:
    """T5: last ``n`` rows per series by time.  Run on aggregated series only."""
    w = Window.partitionBy(*(partition_by or [])).orderBy(F.desc(ts))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
