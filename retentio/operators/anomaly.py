"""Outliers: per-group z-scores (M10) and an isolation forest (M9).

Isolation forest (Liu, Ting & Zhou, 2008) in two Spark phases:

1. *Sample.*  One narrow pass tags each row with the trees whose seeded
   hash selects it (probability ψ/n per tree), so every tree gets about ψ
   rows wherever the rows live; ``groupBy(tree).applyInPandas`` grows one
   tree per group from those ψ rows.  Group size is bounded by ψ, not by n.
   Features and split points follow from hashes of (tree, node) too, so a
   forest is a function of its rows alone and a SQL engine can grow the same one.
2. *Score.*  The node table (≤ trees × 2ψ rows, a proven bound) is broadcast and
   ``mapInArrow`` walks all trees at once over each batch.  The flag threshold
   is the exact (1 − contamination) quantile of the scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .drift import exact_quantiles

EULER = 0.5772156649015329


def group_zscore(df: DataFrame, group: str, value: str, out: str = "z") -> DataFrame:
    """(x − mean_g) / stddev_samp_g with group stats from one aggregate.

    The statistics hold one row per group; the join is left to Spark's size checks, which
    broadcast them where they are small and may split a hot group's rows otherwise.
    """
    stats = df.groupBy(F.col(group).alias("_g")).agg(
        (F.sum(F.col(value).cast("decimal(18,2)")).cast("double") / F.count(value)).alias("_mean"),
        F.stddev_samp(F.col(value).cast("double")).alias("_std"))
    j = df.join(stats, F.col(group) == F.col("_g"))
    z = F.try_divide(F.col(value) - F.col("_mean"), F.col("_std"))
    return j.withColumn(out, z).drop("_mean", "_std", "_g")


def path_length(n: float) -> float:
    """Average path length of an unsuccessful search in a tree over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (float(np.log(n - 1.0)) + EULER) - 2.0 * (n - 1.0) / n


#: Path lengths are summed as integers of this many parts, so their order has no bearing.
PARTS = 1_000_000_000
MOD32 = 1 << 32
#: Seeds of the hashes that deal rows to trees and choose features and split points.
DEAL, FIRST, FEATURE, POINT = 0, 1, 2, 3


def mix32(x: int) -> int:
    """A 32-bit hash of a non-negative integer that any SQL engine can compute."""
    x %= MOD32
    x ^= x >> 16
    x = x * 2246822507 % MOD32
    x ^= x >> 13
    x = x * 3266489909 % MOD32
    return x ^ x >> 16


def _mix32_column(x: Column) -> Column:
    """:func:`mix32` of a long column, in limbs of 16 bits."""
    def times(v: Column, m: int) -> Column:
        low, high = F.pmod(v, F.lit(65536)), F.shiftright(v, 16)
        return F.pmod(low * F.lit(m) + F.pmod(high * F.lit(m), F.lit(65536)) * F.lit(65536), F.lit(MOD32))

    steps = [lambda v: v.bitwiseXOR(F.shiftright(v, 16)), lambda v: times(v, 2246822507), lambda v: v.bitwiseXOR(F.shiftright(v, 13)),
             lambda v: times(v, 3266489909), lambda v: v.bitwiseXOR(F.shiftright(v, 16))]
    held = F.array(F.pmod(x, F.lit(MOD32)))
    for step in steps:
        held = F.transform(held, step)
    return held[0]


def tree_hash(seed: int, tree: int, node: int, use: int) -> int:
    return mix32(mix32(mix32(seed * 7919 + use) + tree) + node)


NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.LongType()),
    T.StructField("feature", T.IntegerType()), T.StructField("split", T.DoubleType()),
    T.StructField("size", T.IntegerType()), T.StructField("depth", T.IntegerType()),
])


def _grow(pdf: pd.DataFrame, features, seed: int) -> pd.DataFrame:
    """One tree, level by level; node n has the children 2 n and 2 n + 1, a leaf feature -1."""
    tree = int(pdf["tree"].iat[0])
    x = pdf[features].to_numpy(dtype="float64")
    limit = max(1, (max(len(x), 2) - 1).bit_length())
    rows, level = [], {1: np.arange(len(x))}
    for depth in range(limit + 1):
        below = {}
        for node, idx in level.items():
            lo, hi = x[idx].min(axis=0), x[idx].max(axis=0)
            open_ = np.flatnonzero(hi > lo)
            if depth >= limit or len(idx) <= 1 or not len(open_):
                rows.append((tree, node, -1, 0.0, len(idx), depth))
                continue
            f = int(open_[tree_hash(seed, tree, node, FEATURE) % len(open_)])
            s = float(lo[f] + (hi[f] - lo[f]) * ((tree_hash(seed, tree, node, POINT) + 0.5) / MOD32))
            s = s if s > lo[f] else float(hi[f])  # both sides get a row
            rows.append((tree, node, f, s, len(idx), depth))
            left = x[idx, f] < s
            below[2 * node], below[2 * node + 1] = idx[left], idx[~left]
        level = below
    return pd.DataFrame(rows, columns=[f.name for f in NODE_SCHEMA.fields])


def fit_isolation_forest(df: DataFrame, key: str, features, n_trees: int = 100,
                         sample_size: int = 256, seed: int = 42) -> DataFrame:
    """Grow the forest; returns the node table (tree, node, feature, split, size, depth).

    A row is in ``n_trees * min(sample_size, n) / n`` trees on average: its
    hash decides the fraction and the first of its consecutive trees.  Integer
    keys are hashed by :func:`mix32`, so any engine deals out the same rows;
    other keys by Spark's 64-bit hash first.  Null features count as 0.
    """
    feats = list(features)
    n = F.greatest(df.select(F.count(F.lit(1))).scalar(), F.lit(1))
    mean = F.lit(float(n_trees)) * F.least(F.lit(1.0), F.lit(float(sample_size)) / n)
    whole = isinstance(df.schema[key].dataType, T.IntegralType)
    number = F.coalesce(F.col(key).cast("long"), F.lit(0).cast("long")) if whole else F.xxhash64(F.col(key))
    of = lambda use: _mix32_column(F.pmod(number, F.lit(MOD32)) + F.lit(mix32(seed * 7919 + use)).cast("long"))
    pre = df.select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in feats],
                    F.floor(mean + of(DEAL) / F.lit(float(MOD32))).cast("int").alias("_k"),
                    F.pmod(of(FIRST), F.lit(n_trees)).cast("int").alias("_first"))
    tagged = pre.where("_k > 0").select(key, *feats, F.explode(F.transform(
        F.sequence(F.lit(0), F.col("_k") - 1), lambda j: F.pmod(F.col("_first") + j, F.lit(n_trees)))).alias("tree"))
    return tagged.groupBy("tree").applyInPandas(lambda p: _grow(p, feats, seed), NODE_SCHEMA)


def score_isolation_forest(df: DataFrame, nodes_pdf: pd.DataFrame, key: str, features,
                           sample_size: float | None = None, keep=()) -> DataFrame:
    """``key``, the columns of ``keep`` and anomaly_score, 2^(−E[h(x)] / c(ψ)), of every row (higher = more anomalous).

    ψ is the mean size of the trees' samples, read from their roots.
    """
    if sample_size is None:
        roots = nodes_pdf[nodes_pdf["node"] == 1]
        sample_size = roots["size"].sum() / max(1, len(roots))
    n_trees = max(1, nodes_pdf["tree"].nunique())
    place = {t: k for k, t in enumerate(sorted(nodes_pdf["tree"].unique()))}
    depth = int(nodes_pdf["depth"].max()) if len(nodes_pdf) else 0
    at = (nodes_pdf["tree"].map(place).to_numpy(dtype="int64"), nodes_pdf["node"].to_numpy(dtype="int64"))
    shape = (n_trees, 1 << depth + 1)
    feature, split, length = np.full(shape, -1, np.int32), np.zeros(shape), np.zeros(shape, np.int64)
    feature[at], split[at] = nodes_pdf["feature"], nodes_pdf["split"]
    length[at] = [round((d + path_length(s)) * PARTS) for d, s in zip(nodes_pdf["depth"], nodes_pdf["size"])]
    forest = df.sparkSession.sparkContext.broadcast((feature, split, length))
    c_psi, feats, keep = path_length(sample_size) or 1.0, list(features), list(keep)
    sel = df.select(key, *keep, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_x{k}") for k, c in enumerate(feats)])
    schema = sel.select(key, *keep, F.lit(0.0).alias("anomaly_score")).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feature, split, length = forest.value
        tree = np.arange(len(feature))[None, :]
        for batch in batches:
            x = np.stack([batch.column(1 + len(keep) + k).to_numpy(zero_copy_only=False) for k in range(len(feats))], 1)
            node = np.ones((len(x), len(feature)), np.int64)
            for _ in range(depth):
                f = feature[tree, node]
                right = np.take_along_axis(x, np.maximum(f, 0), 1) >= split[tree, node]
                node = np.where(f >= 0, 2 * node + right, node)
            mean = length[tree, node].sum(1) / PARTS / len(feature)
            yield pa.RecordBatch.from_arrays([*batch.columns[:1 + len(keep)], pa.array(np.power(2.0, -mean / c_psi))],
                                             names=[key, *keep, "anomaly_score"])

    return sel.mapInArrow(score, schema)


def isolation_forest(df: DataFrame, key: str, features, n_trees: int = 100,
                     sample_size: int = 256, contamination: float = 0.05,
                     seed: int = 42, keep=()) -> DataFrame:
    """M9: fit, score and flag the top ``contamination`` share as anomalies.

    The narrow projection and the scores are written once; the threshold is the
    exact quantile of the scores.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df = df.select(*dict.fromkeys([key, *features, *keep])).checkpoint()
    nodes_pdf = read_nodes(fit_isolation_forest(df, key, features, n_trees, sample_size, seed))
    scored = score_isolation_forest(df, nodes_pdf, key, features, keep=keep).checkpoint()
    edge = exact_quantiles(scored.select(F.lit("s").alias("feature"), F.col("anomaly_score").alias("x")), [1.0 - contamination])
    thr = edge.select(F.max(F.col("edges")[0])).scalar()
    return scored.withColumn("is_anomaly", (F.col("anomaly_score") > thr).cast("int"))


# What the reference reports of an anomalous customer beside id and score.
REPORTED = ["monthly_charges", "total_support_tickets", "negative_support_tickets"]


def top_anomalies(scored: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The ``k`` most anomalous among the flagged rows."""
    return scored.where("is_anomaly = 1").orderBy(F.desc("anomaly_score"), key).limit(k)


def anomaly_summary(scored: DataFrame) -> DataFrame:
    """Rows, flagged rows and rate, mean and population deviation of the scores."""
    return scored.agg(F.count("*").alias("n"), F.sum("is_anomaly").alias("n_anomalies"),
                      F.avg(F.col("is_anomaly").cast("double")).alias("anomaly_rate"),
                      F.avg("anomaly_score").alias("score_mean"), F.stddev_pop("anomaly_score").alias("score_std"))


#: Nodes of a forest that one task and the driver may hold.
MAX_NODES = 2_000_000


def read_nodes(nodes: DataFrame) -> pd.DataFrame:
    """The node table, after a check of its size."""
    rows = nodes.limit(MAX_NODES + 1).toPandas()
    if len(rows) > MAX_NODES:
        raise ValueError(f"the forest has more than {MAX_NODES} nodes")
    return rows


def save_forest(nodes: DataFrame, path: str) -> None:
    """The forest is a node table; persist it as parquet."""
    nodes.write.mode("overwrite").parquet(path)


def validate_forest(df: DataFrame, path: str, key: str, features) -> None:
    """The saved forest loads and scores a probe row; raises otherwise."""
    got = score_with_saved_forest(df.limit(1), path, key, features).first()
    if got is None or not 0.0 <= got["anomaly_score"] <= 1.0:
        raise RuntimeError(f"forest validation failed: {path}")


def score_with_saved_forest(df: DataFrame, path: str, key: str, features,
                            sample_size: int | None = None) -> DataFrame:
    """Score with a saved node table of checked size."""
    return score_isolation_forest(df, read_nodes(df.sparkSession.read.parquet(path)), key, features, sample_size)
