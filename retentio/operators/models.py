"""Spark ML models: churn ensemble (M1–M3, M14), k-means (M7), revenue GBT.

Training and scoring are MLlib estimators over DataFrames: the driver plans,
executors scan and aggregate (tree histograms, k-means sums).  Artefacts
are ``PipelineModel``s (S8); feature names live in the assembler stage.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.numeric import np_round
from ..functions.serving import with_serving_features
from ..session import ensure_checkpoint_dir
from . import clustering as CL
from .features import FEATURE_COLUMNS, model_matrix
from .segments import segment_names, zscore

# Hyper-parameters of the reference's models.
CHURN_ROUNDS = 300
REVENUE_ROUNDS = 200
CHURN_DEPTH = 6
CHURN_STEP = 0.05
CHURN_SUBSAMPLE = 0.8
POSITIVE_WEIGHT = 3.0
VOTE_WEIGHTS = (0.6, 0.4)
REVENUE_DEPTH = 4
REVENUE_STEP = 0.05
K_RANGE = range(3, 8)


def _assembler(features, out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def churn_members(features=FEATURE_COLUMNS, rounds: int = CHURN_ROUNDS, seed: int = 42) -> list:
    """M1 and M2: two boosted classifiers with different weighting and seed, after the assembler."""
    members = []
    for k, name in enumerate("ab"):
        m = GBTClassifier(featuresCol="features", labelCol="label", weightCol=f"w_{name}",
                          maxIter=rounds, maxDepth=CHURN_DEPTH, stepSize=CHURN_STEP,
                          subsamplingRate=CHURN_SUBSAMPLE, featureSubsetStrategy="0.8",
                          seed=seed + k, predictionCol=f"pred_{name}")
        members.append(m.setProbabilityCol(f"prob_{name}").setRawPredictionCol(f"raw_{name}"))
    return [_assembler(features), *members]


def with_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Sample weights: member A weights positives by 3, member B is balanced."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n_c"))
    total = counts.select(F.sum("_n_c")).scalar()
    w = counts.select(label, (total / (2.0 * F.col("_n_c"))).alias("w_b"))
    out = df.join(F.broadcast(w), label)  # w has one row per class
    return out.withColumn("w_a", F.when(F.col(label) == 1, F.lit(POSITIVE_WEIGHT)).otherwise(1.0))


#: Rows of a training partition: boosting runs several jobs a round, and small
#: frames in many partitions spend their time in task starts.
TRAIN_ROWS = 50_000
#: Most rows of a training partition, which a task's cached block holds in binned form.
MOST_TRAIN_ROWS = 2_000_000


def _sized(train: DataFrame, members: int = 1) -> DataFrame:
    """The training frame, written once, in even partitions of TRAIN_ROWS rows or more.

    Every level of every round runs a task a partition, which sends the statistics of all its nodes, features and
    bins, so there are no more partitions than the cores run at once with all ``members`` fitted side by side.
    """
    ensure_checkpoint_dir(train.sparkSession)
    rows, cores = train.count(), train.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(-(-rows // TRAIN_ROWS), cores // members), -(-rows // MOST_TRAIN_ROWS))
    if parts == 1:
        return train.checkpoint().coalesce(1)
    # The order of rows decides which are drawn, so it must not be that in which they arrived.
    return train.repartition(parts).sortWithinPartitions(F.xxhash64(*train.columns)).checkpoint()


def fit_churn(train: DataFrame, features=FEATURE_COLUMNS, rounds: int = CHURN_ROUNDS,
              seed: int = 42, strict: bool = False) -> PipelineModel:
    """M1–M3: both members, fitted side by side; ``strict`` raises where a feature is missing.

    A round of boosting is a few jobs that leave most of a cluster idle, so the two members' jobs
    are submitted from two threads, as the cross validator does with its models.
    """
    assembler, *members = churn_members(features, rounds, seed)
    m = _sized(with_weights(model_matrix(train, features, strict=strict)), len(members))
    vectors = assembler.transform(m)
    with ThreadPool(len(members)) as pool:
        fitted = pool.map(inheritable_thread_target(train.sparkSession)(lambda e: e.fit(vectors)), members)
    return PipelineModel([assembler, *fitted])


def score_churn(model: PipelineModel, df: DataFrame, features=FEATURE_COLUMNS,
                keep=(), strict: bool = False) -> DataFrame:
    """M3 + M14: soft vote of the members, tier, prediction (no refit)."""
    s = model.transform(model_matrix(df, features, label="label", keep=keep, strict=strict))
    pa = vector_to_array("prob_a")[1]
    pb = vector_to_array("prob_b")[1]
    p = F.lit(VOTE_WEIGHTS[0]) * pa + F.lit(VOTE_WEIGHTS[1]) * pb
    drop = ["features", "raw_a", "prob_a", "pred_a", "raw_b", "prob_b", "pred_b"]
    return s.withColumn("churn_prob_raw", p).drop(*drop).withColumns({
        "churn_probability": np_round(F.col("churn_prob_raw"), 4),
        "churn_prediction": R.churn_prediction(F.col("churn_prob_raw")),
        "risk_tier": R.risk_tier(F.col("churn_prob_raw")),
        "model_version": F.lit(R.MODEL_VERSION),
    })


def score_requests(model: PipelineModel, requests: DataFrame, key: str = "customer_id") -> DataFrame:
    """P17 + M14 + P19–P21: request rows of 15 fields to probability, prediction, tier, factors and
    recommendation; the request's fields stay.  One narrow pass: features, both members, texts.
    """
    held = requests.withColumn("_request", F.struct(*requests.columns))
    rows = with_serving_features(held, keep=["_request"], key=key).withColumn("label", F.lit(0))
    s = score_churn(model, rows, model_features(model), keep=["_request"], strict=True)
    s = s.select("_request.*", "churn_prob_raw", "churn_probability", "churn_prediction", "risk_tier", "model_version")
    return s.withColumns({"top_factors": R.top_factors(), "recommendation": R.recommendation(F.col("risk_tier"))})


def kmeans_segments(df: DataFrame, key: str, features, ks=K_RANGE, seed: int = 42,
                    value_col: str = "lifetime_value", max_iter: int = 300,
                    restarts: int = 10) -> DataFrame:
    """M6 + M7 + P31: z-scored features, k chosen by silhouette, clusters
    ordered by mean ``value_col`` (descending) and named.

    For each k, ``restarts`` starts are fitted (the reference's 10 initialisations), all
    of them together (:mod:`.clustering`); the one of lowest cost is scored by
    silhouette.  The scaled frame is written once and scanned once an iteration.
    An empty frame gives no rows; nulls count as 0.
    """
    held = df.select(F.col(key).alias("_key"), F.col(value_col).cast("double").alias("_value"), CL.numbered(df, key).alias("_n"),
                     *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    z = zscore(held, list(features))
    points = z.select("_key", "_value", "_n", F.array(*[F.col(f"{c}_z") for c in features]).alias("_x")).checkpoint(eager=True)
    fits = CL.fit_many(points, "_n", "_x", ks, restarts, seed, max_iter)
    best = [min((f for f in fits if f.k == k), key=lambda f: (round(f.cost, 6), f.restart)) for k in ks if any(f.k == k for f in fits)]
    scores = [round(s, 6) for s in CL.silhouettes(points, "_x", best)] if best else []
    if not best:
        sil, model = 0.0, None
        out = points.where("false").withColumn("cluster", F.lit(0))
    else:
        sil, model = max(zip(scores, best), key=lambda t: (t[0], -t[1].k))
        out = CL.assign(points, "_x", model.centroids)
    order = out.groupBy("cluster").agg(F.avg("_value").alias("_v"))
    rank = order.withColumn("cluster_rank", F.row_number().over(
        Window.orderBy(F.desc("_v"), "cluster")) - 1)  # ≤ 7 rows
    res = out.join(F.broadcast(rank.select("cluster", "cluster_rank")), "cluster")
    return res.select(F.col("_key").alias(key), "cluster", "cluster_rank",
                      segment_names("cluster_rank").alias("segment_name"),
                      F.lit(model.k if model else 0).alias("k"), F.lit(float(sil)).alias("silhouette"))


def fit_revenue(train: DataFrame, features, rounds: int = REVENUE_ROUNDS, seed: int = 42) -> PipelineModel:
    """Boosted regressor on time features."""
    gbt = GBTRegressor(featuresCol="features", labelCol="y", maxIter=rounds,
                       maxDepth=REVENUE_DEPTH, stepSize=REVENUE_STEP, subsamplingRate=0.8,
                       seed=seed, predictionCol="predicted")
    return Pipeline(stages=[_assembler(features), gbt]).fit(_sized(train))


def model_features(model: PipelineModel) -> list[str]:
    """The feature names of a fitted pipeline, in the order of its vectors."""
    return [c for s in model.stages if isinstance(s, VectorAssembler) for c in s.getInputCols()]


def save_model(model: PipelineModel, path: str, features=None) -> None:
    """Overwrite-save a fitted pipeline; its feature names lie beside it in ``path/_features``."""
    names = list(features) if features is not None else model_features(model)
    model.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    spark.createDataFrame(list(enumerate(names)), "position int, feature string").coalesce(1).write.mode("overwrite").parquet(f"{path}/_features")


def saved_features(path: str) -> list[str]:
    """The feature names saved beside a model, in order."""
    rows = SparkSession.getActiveSession().read.parquet(f"{path}/_features").collect()  # one per feature
    return [r.feature for r in sorted(rows, key=lambda r: r.position)]


def load_model(path: str, features=None) -> PipelineModel:
    """Load a fitted pipeline; a missing path raises, and so does a model whose saved feature
    list is not its own, or not ``features`` where given."""
    model = PipelineModel.load(path)
    saved = saved_features(path)
    for other in (model_features(model), features):
        if other is not None and list(other) != saved:
            raise ValueError(f"the model at {path} was saved with other features: " + ", ".join(sorted(set(other) ^ set(saved)) or ["their order differs"]))
    return model


def validate_models(paths: dict, probes: dict) -> DataFrame | None:
    """Each artefact loads and transforms its probe frame; raise on failure."""
    failed = []
    for name, path in paths.items():
        try:
            load_model(path).transform(probes[name]).limit(1).count()
        except Exception as e:  # collected and raised together
            failed.append(f"{name}: {e}")
    if failed:
        raise RuntimeError("model validation failed: " + "; ".join(failed))
    return None


def feature_importances(model, features, top: int = 10):
    """The ``top`` most important features of a tree-ensemble stage.

    The vector has one entry per feature (bounded by the feature count), so
    building the small result frame on the driver is safe.
    """
    stage = [s for s in getattr(model, "stages", [model]) if hasattr(s, "featureImportances")][0]
    imp = stage.featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame(list(zip(list(features), [float(x) for x in imp])),
                               "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(top)
