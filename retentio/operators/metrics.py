"""Classifier metrics as aggregates.

Rank metrics collapse rows to distinct scores first (a score shared by a
third of all rows is one row with a count), then take exact running counts
with ``prefix_sums`` — never a single-task global window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import ntile_from_rank, prefix_sums, row_number_global


def _score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    return df.groupBy(F.col(score).alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"))


def classifier_metrics(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """M4: ROC AUC (ties averaged), average precision, precision/recall/F1 at threshold.

    AUC = Σ_groups pos·(neg_below + neg/2) / (n⁺·n⁻) over scores ascending.
    AP  = Σ_groups (pos/n⁺)·TP/(TP+FP) over scores descending (sklearn).
    Precision, recall and F1 use ``zero_division=0``.
    """
    g = _score_counts(df, score, label)
    asc = prefix_sums(g, ["s"], {"pos": F.col("pos"), "neg": F.col("neg")})
    # descending cumulative counts: totals minus ascending counts below
    d = asc.withColumns({
        "tp_desc": F.col("_group_total_pos") - F.col("cum_pos") + F.col("pos"),
        "fp_desc": F.col("_group_total_neg") - F.col("cum_neg") + F.col("neg"),
    })
    t = d.select(
        (F.col("pos").cast("double") * ((F.col("cum_neg") - F.col("neg")) + F.col("neg") / 2.0)).alias("u"),
        F.col("_group_total_pos").alias("n_pos"), F.col("_group_total_neg").alias("n_neg"),
        F.try_divide(F.col("pos").cast("double") * F.col("tp_desc"),
                     F.col("_group_total_pos").cast("double") * (F.col("tp_desc") + F.col("fp_desc"))).alias("ap_term"),
        F.when(F.col("s") >= threshold, F.col("pos")).otherwise(0).alias("tp"),
        F.when(F.col("s") >= threshold, F.col("neg")).otherwise(0).alias("fp"),
        F.when(F.col("s") < threshold, F.col("pos")).otherwise(0).alias("fn"))
    a = t.agg(F.sum("u").alias("u"), F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg"),
              F.sum("ap_term").alias("average_precision"),
              F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    out = a.withColumns({
        "roc_auc": F.try_divide(F.col("u"), F.col("n_pos").cast("double") * F.col("n_neg")),
        "precision": prec, "recall": rec})
    out = out.withColumn("f1", F.coalesce(F.try_divide(
        2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))
    return out.select("n_pos", "n_neg", "roc_auc", "average_precision", "precision", "recall", "f1",
                      "tp", "fp", "fn")


def confusion_report(df: DataFrame, pred: Column, label: str) -> DataFrame:
    """M5: per class precision, recall, F1 and support (zero_division=0)."""
    c = df.groupBy(F.col(label).cast("int").alias("actual"), pred.cast("int").alias("predicted")) \
        .agg(F.count(F.lit(1)).alias("n"))
    per = c.groupBy().agg(*[
        F.sum(F.when((F.col("actual") == k) & (F.col("predicted") == k), F.col("n")).otherwise(0)).alias(f"tp{k}")
        for k in (0, 1)], *[
        F.sum(F.when(F.col("predicted") == k, F.col("n")).otherwise(0)).alias(f"pp{k}") for k in (0, 1)], *[
        F.sum(F.when(F.col("actual") == k, F.col("n")).otherwise(0)).alias(f"sup{k}") for k in (0, 1)])
    rows = []
    for k in (0, 1):
        p = F.coalesce(F.try_divide(F.col(f"tp{k}"), F.col(f"pp{k}")), F.lit(0.0))
        r = F.coalesce(F.try_divide(F.col(f"tp{k}"), F.col(f"sup{k}")), F.lit(0.0))
        rows.append(F.struct(F.lit(k).alias("class_label"), p.alias("precision"), r.alias("recall"),
                             F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"),
                             F.col(f"sup{k}").cast("long").alias("support")))
    return per.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def gain_curve(df: DataFrame, score: str, label: str, key: str, tiles: int = 10) -> DataFrame:
    """Deciles by score (desc, key asc): positives and cumulative capture."""
    r = row_number_global(df.select(score, label, key), [-F.col(score), key])
    r = r.withColumn("decile", ntile_from_rank(F.col("rn"), F.col("n_in_group"), tiles))
    g = r.groupBy("decile").agg(F.count(F.lit(1)).alias("n"),
                                F.sum(F.col(label).cast("long")).alias("positives"))
    from pyspark.sql import Window
    w = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)  # ≤ tiles rows
    tot = F.sum("positives").over(Window.partitionBy())
    return g.withColumns({
        "cum_positives": F.sum("positives").over(w),
        "capture_rate": F.sum("positives").over(w) / tot,
    })


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """M2: balanced weights n / (2 · n_c) per class."""
    from pyspark.sql import Window
    g = df.groupBy(F.col(label).cast("int").alias("class_label")).agg(F.count(F.lit(1)).alias("n_class"))
    n = F.sum("n_class").over(Window.partitionBy())
    k = F.count(F.lit(1)).over(Window.partitionBy())
    return g.withColumn("weight", n / (k * F.col("n_class")))


def soft_vote(a, b, wa: float = 0.6, wb: float = 0.4) -> Column:
    """M3: weighted average of two member probabilities."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return F.lit(wa) * ca + F.lit(wb) * cb
