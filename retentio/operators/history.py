"""Slowly changing history (J5, D2) and the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .ranking import forward_fill, neighbours


def scd2(changes: DataFrame, key: str, ts: str, tracked, order_tiebreak: str | None = None,
         num_partitions: int | None = None) -> DataFrame:
    """Type-2 history from a change feed.

    Rows are ordered by (ts, tiebreak) per key; consecutive rows with equal
    tracked values collapse into one version; ``valid_to`` is the next
    version's ``valid_from`` (null = current); ``version`` numbers versions.

    The per-key sequence is scanned with ``ranking.neighbours`` (range
    buckets over key + time, so one key holding a third of all rows is
    still spread over many tasks); the second pass (next version start)
    also numbers the versions.  Tracked values are compared null-safely.
    """
    tracked = [tracked] if isinstance(tracked, str) else list(tracked)
    tb = [order_tiebreak] if order_tiebreak else []
    c = changes.select(key, ts, *tracked, *tb,
                       F.struct(*[F.col(t) for t in tracked]).alias("_h"))
    c = neighbours(c, [ts, *tb], "_h", partition_by=[key], num_partitions=num_partitions,
                   nxt=False)
    starts = c.filter(~F.col("prev__h").eqNullSafe(F.col("_h")))
    starts = starts.select(key, *tracked, F.col(ts).alias("valid_from"), *tb)
    v = neighbours(starts, ["valid_from", *tb], "valid_from", partition_by=[key],
                   num_partitions=num_partitions, prev=False, number="_version")
    v = v.withColumnRenamed("next_valid_from", "valid_to")
    v = v.withColumn("version", F.col("_version").cast("int"))
    return v.withColumn("is_current", F.col("valid_to").isNull()).select(
        key, *tracked, "valid_from", "valid_to", "version", "is_current")


def as_of_lookup(history: DataFrame, points: DataFrame, key: str, at: str) -> DataFrame:
    """J5 point-in-time lookup: the version with valid_from ≤ at < valid_to.

    An as-of join by sorting, not by pairs: points and versions are unioned,
    ordered by (key, time, versions before points) and the version columns
    are forward-filled with ``ranking.forward_fill`` over range buckets, so
    a key with a third of all rows is split across tasks and no key ever
    compares all its points with all its versions.  Points of a null key meet
    the versions of the null key.
    """
    vcols = [c for c in history.columns if c != key]
    value = F.struct(*[F.col(c) for c in vcols])
    extra = [c for c in points.columns if c not in (key, at)]
    ver = history.select(F.col(key), F.col("valid_from").alias("_t"), F.lit(0).alias("_kind"), value.alias("_v"),
                         F.lit(None).cast(points.schema[at].dataType).alias(at),
                         *[F.lit(None).cast(points.schema[c].dataType).alias(c) for c in extra])
    p = points.select(F.col(key), F.col(at).alias("_t"), F.lit(1).alias("_kind"),
                      F.lit(None).cast(ver.schema["_v"].dataType).alias("_v"), F.col(at), *extra)
    # Of versions that begin together the longest comes last; points of one instant are alike.
    order = ["_t", "_kind", F.col("_v.valid_to").isNull().alias("_open"), F.col("_v.valid_to").alias("_to")]
    filled = forward_fill(ver.unionByName(p), order, ["_v"], partition_by=[key])
    hit = filled.filter(F.col("_kind") == 1)
    ok = F.col("_v").isNotNull() & (F.col("_v.valid_to").isNull() | (F.col(at) < F.col("_v.valid_to")))
    return hit.select(key, at, *extra, *[F.when(ok, F.col(f"_v.{c}")).alias(c) for c in vcols])


#: Buckets that keys of a stored history are dealt to; a merge rewrites those it touches.
BUCKETS = 64
#: Tasks that write one bucket.
SPREAD = 4


def _same(a: DataFrame, b: DataFrame, key: str, how: str) -> DataFrame:
    """Semi or anti join on ``key`` in which null equals null."""
    return a.join(b.select(F.struct(F.col(key)).alias("_same")), F.struct(F.col(key)) == F.col("_same"), how)


def _dealt(df: DataFrame, ts: str) -> DataFrame:
    """Rows of a bucket in a few tasks (and files), so a hot key's bucket is not one task's."""
    return df.repartition("bucket", F.pmod(F.xxhash64(F.col(ts)), F.lit(SPREAD)))


def read_history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored history, with ``scd2``'s columns; ``schema`` is theirs."""
    stored = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("open", T.IntegerType())])
    return spark.read.schema(stored).parquet(f"{path}/history").select(*schema.names, "bucket")


def merge_history(spark: SparkSession, path: str, batch_id: str, changes: DataFrame, key: str, ts: str, tracked,
                  order_tiebreak: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Take a batch of changes, late ones included, into a stored type-2 history; returns it.

    ``path/log`` keeps the changes by batch and key bucket, ``path/history`` the versions by bucket and
    whether they are open.  The versions of the batch's keys are built anew from the log's
    buckets they lie in and replace the old ones; other buckets are neither read nor
    written.  A batch that is run again replaces itself, so a job restarted after a failure
    gives the same table.
    """
    tracked = [tracked] if isinstance(tracked, str) else list(tracked)
    cols = [key, ts, *tracked, *([order_tiebreak] if order_tiebreak else [])]
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    ensure_checkpoint_dir(spark)
    new = changes.select(*cols).withColumn("bucket", bucket)
    _dealt(new, ts).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/log/batch={batch_id}")
    held = T.StructType([*new.schema.fields[:-1], T.StructField("batch", T.StringType()), T.StructField("bucket", T.IntegerType())])
    log = spark.read.schema(held).option("basePath", f"{path}/log").parquet(f"{path}/log")
    touched = log.where(F.col("batch") == batch_id).select(key, "bucket").distinct().checkpoint()
    parts = [r.bucket for r in touched.select("bucket").distinct().collect()]  # at most ``buckets``
    events = _same(log.where(F.col("bucket").isin(parts)), touched, key, "left_semi").select(*cols)
    built = scd2(events, key, ts, tracked, order_tiebreak)
    shape = built.schema
    stored = built.withColumn("bucket", bucket).withColumn("open", F.col("is_current").cast("int"))
    spark.createDataFrame([], stored.schema).write.mode("append").partitionBy("bucket", "open").parquet(f"{path}/history")
    old = read_history(spark, path, shape).where(F.col("bucket").isin(parts))
    old = _same(old, touched, key, "left_anti").withColumn("open", F.col("is_current").cast("int"))
    # Versions of a key never become fewer, so no stored partition is left without rows.
    out = stored.unionByName(old).checkpoint()
    _dealt(out, "valid_from").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "open").parquet(f"{path}/history")
    return read_history(spark, path, shape).drop("bucket")


def run_log(metrics: DataFrame, experiment: str, run_col: str, metric_cols) -> DataFrame:
    """S10 + W8: runs as (experiment, run_id, metric, value) with the change
    against the previous run of the same experiment and metric."""
    long = metrics.select(F.lit(experiment).alias("experiment"), F.col(run_col).alias("run_id"),
                          F.explode(F.array(*[F.struct(F.lit(m).alias("metric"),
                                                       F.col(m).cast("double").alias("value"))
                                              for m in metric_cols])).alias("kv"))
    long = long.select("experiment", "run_id", "kv.metric", "kv.value")
    w = Window.partitionBy("experiment", "metric").orderBy("run_id")
    return long.withColumn("prev_value", F.lag("value").over(w)).withColumn(
        "change", F.col("value") - F.col("prev_value"))
