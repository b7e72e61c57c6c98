"""The run log — one appended row per training or monitoring run.

Replaces an external tracking server with an append-only parquet table
(``run_id, experiment, ts, params map<string,string>, metrics
map<string,double>``).  Errors are raised, not swallowed.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("experiment", T.StringType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("params", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType()), True),
])


def log_run(spark: SparkSession, path: str, experiment: str, params: dict,
            metrics: dict, run_id: str | None = None) -> str:
    """Append one run; params are stored as strings, metrics as doubles."""
    rid = run_id or uuid.uuid4().hex
    row = (rid, experiment, datetime.now(timezone.utc).replace(tzinfo=None),
           {str(k): str(v) for k, v in params.items()},
           {str(k): float(v) for k, v in metrics.items()})
    spark.createDataFrame([row], RUN_SCHEMA).write.mode("append").parquet(path)
    return rid


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def metric_history(runs: DataFrame, metric: str) -> DataFrame:
    """A metric per run with its change against the previous run."""
    from pyspark.sql import Window
    w = Window.partitionBy("experiment").orderBy("ts", "run_id")
    v = runs.select("experiment", "run_id", "ts", F.col("metrics")[metric].alias("value"))
    return v.withColumn("prev_value", F.lag("value").over(w)).withColumn(
        "change", F.col("value") - F.col("prev_value"))
