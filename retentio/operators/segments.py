"""Scaling, RFM and segment helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .ranking import row_number_global

# Segment names of the reference, in id order.
SEGMENT_NAMES = ["Champions", "Loyal Customers", "At Risk", "Hibernating", "Lost"]


def zscore(df: DataFrame, cols, suffix: str = "_z", materialize: bool = True) -> DataFrame:
    """M6: (x − mean) / population std; a zero std scales by 1.

    Statistics are one global aggregate entering as a struct-valued scalar
    subquery (computed once, inlined), so the scaling pass stays narrow.  The input is read
    twice (statistics, then scaling); with ``materialize`` it is checkpointed
    first so an expensive upstream plan runs once.
    """
    if materialize:
        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    st = df.select(F.struct(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols],
                            *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in cols])).scalar()
    return df.withColumns({
        f"{c}{suffix}": (F.col(c) - st.getField(f"m_{c}")) /
        F.when(F.coalesce(st.getField(f"s_{c}"), F.lit(0.0)) == 0, F.lit(1.0)).otherwise(st.getField(f"s_{c}"))
        for c in cols})


def rfm(facts: DataFrame, key: str, ts: str, amount: str) -> DataFrame:
    """M8: recency (days before the latest date), frequency, monetary; then
    quintile scores 1..5 (5 = best) with exact ntile ranks (ties by key).

    One ranking of the three measures gives the rows that bound the
    quintiles (four per measure); scores follow by comparison.
    """
    ref = facts.select(F.max(ts)).scalar()
    base = facts.groupBy(F.col(key).alias("customer_id")).agg(
        F.datediff(ref, F.max(ts)).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum(F.col(amount).cast("decimal(18,2)")).cast("double").alias("monetary"))
    ensure_checkpoint_dir(facts.sparkSession)
    base = base.checkpoint()
    # Recency ascends from the oldest: more days rank first, score 1.
    measures = {"r": -F.col("recency_days").cast("double"), "f": F.col("frequency").cast("double"), "m": F.col("monetary")}
    long = base.select("customer_id", F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), v.alias("v"))
                                                          for k, v in measures.items()])).alias("x"))
    ranks = row_number_global(long.select("x.measure", "x.v", "customer_id"), ["v", "customer_id"], partition_by=["measure"])
    # The last row of each of the first four quintiles bounds the scores.
    n = F.col("n_in_group")
    last = F.array(*[F.floor(n / 5) * t + F.least(F.lit(t), n % 5) for t in range(1, 5)])
    bounds = (ranks.where(F.array_contains(last, F.col("rn"))).groupBy("measure")
              .agg(F.collect_list(F.struct("v", "customer_id")).alias("b"))
              .select(F.map_from_entries(F.collect_list(F.struct("measure", "b")))).scalar())
    base = base.withColumn("_b", bounds)
    for k, v in measures.items():
        base = base.withColumn(f"_{k}", F.struct(v.alias("v"), F.col("customer_id")))
        base = base.withColumn(f"{k}_score", 1 + F.size(F.filter(F.col("_b")[k], _below(F.col(f"_{k}")))))
    return base.drop("_b", *[f"_{k}" for k in measures]).withColumn(
        "rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))


def _below(key):
    return lambda x: x < key


def rfm_segment(score) -> "F.Column":
    """Name an RFM total (3..15) with the reference's five segment names."""
    s = F.col(score) if isinstance(score, str) else score
    return (F.when(s >= 13, SEGMENT_NAMES[0]).when(s >= 10, SEGMENT_NAMES[1])
            .when(s >= 8, SEGMENT_NAMES[2]).when(s >= 6, SEGMENT_NAMES[3])
            .otherwise(SEGMENT_NAMES[4]))


def segment_names(cluster_rank) -> "F.Column":
    """Cluster order → name, ``Segment_{i}`` beyond the five names."""
    c = F.col(cluster_rank) if isinstance(cluster_rank, str) else cluster_rank
    names = F.array(*[F.lit(n) for n in SEGMENT_NAMES])
    return F.coalesce(F.try_element_at(names, (c + 1).cast("int")),
                      F.concat(F.lit("Segment_"), c.cast("string")))
