"""Structured Streaming jobs.

* R1 ``ingest_incremental`` — file-source stream in bounded micro-batches →
  event-time cast → lineage → merge by id into a parquet table partitioned by
  event date; ``trigger(availableNow=True)`` processes what is there and stops,
  and the checkpoint makes re-runs incremental.  Late rows are kept.
* R2 ``score_stream`` — the scoring rules are stateless Columns, so a
  streaming frame is scored by the same projection as a batch table.
* R3 ``daily_activity_stream`` — per-user daily counts with a watermark;
  state for a day is dropped once the watermark passes it, late rows are
  ignored.  Each micro-batch writes its updated rows to a changelog; the
  current table is the latest version of each key (``compact_changelog``).

Parquet timestamps arrive as ``timestamp_ntz``; watermarks need
``timestamp``, so event time is cast first (session zone UTC).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..session import checkpoint_dir
from ..sources.bronze import lineage_columns


def _stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
            max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if os.path.splitext(path)[1] and not any(ch in path for ch in "*?["):
        # a single file: the file source wants a folder or a glob, so the
        # last character becomes a one-letter class that matches only itself
        path = f"{path[:-1]}[{path[-1]}]"
    return r.load(path)


#: Files of one micro-batch, so a backfill is many bounded batches.
MAX_FILES = 1_000
DATE = "_event_date"


def _without(rows: DataFrame, old: DataFrame, ids: list[str]) -> DataFrame:
    """The rows whose ids (null ones too) are not among the old ones."""
    held = old.select(F.struct(*ids).alias("_old"))
    return rows.join(held, F.struct(*[rows[c] for c in ids]) == held["_old"], "left_anti")


def ingest_incremental(spark: SparkSession, source: str, schema: T.StructType, sink: str,
                       checkpoint: str, id_cols, ts_col: str, watermark: str = "1 day",
                       source_name: str = "stream", batch_id: str | None = None,
                       max_files: int = MAX_FILES):
    """Merge new rows by id into a parquet table partitioned by event date.

    A row is new when the table holds no row of its id within ``watermark``
    of the batch's event times (or without a time, if the row has none); only those date
    partitions' ids are read.  No
    row is dropped for being late, nothing is held in state, and a batch that
    is run again after a failure finds its rows and adds none.
    """
    ids = list(id_cols)
    lin = lineage_columns(source_name, batch_id or uuid.uuid4().hex[:12])
    s = _stream(spark, source, schema, max_files=max_files)
    s = s.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withColumns(lin)
    table = T.StructType([*s.schema.fields, T.StructField(DATE, T.DateType())])

    def merge(batch: DataFrame, _: int) -> None:
        # Of unequal rows of one id the least in all columns is taken, so a batch run again takes the same.
        whole = F.struct(F.col(ts_col).isNull().alias("_none"), *[F.col(c) for c in batch.columns if c not in ids])
        rows = batch.groupBy(*ids).agg(F.min(whole).alias("_row")).select(*[F.col(c) if c in ids else F.col(f"_row.{c}").alias(c) for c in batch.columns])
        rows = rows.withColumn(DATE, F.to_date(ts_col))
        span = F.expr(f"INTERVAL {watermark}")
        low, high, none = batch.agg(F.to_date(F.min(ts_col) - span), F.to_date(F.max(ts_col) + span), F.bool_or(F.col(ts_col).isNull())).first()
        if low is not None or none:
            old = spark.read.schema(table).option("recursiveFileLookup", "false").parquet(sink)
            # Rows without a time have a partition of their own, read where the batch holds such rows.
            known = F.col(DATE).between(low, high) if low is not None else F.lit(False)
            old = old.where((known | F.col(DATE).isNull()) if none else known).select(*ids)
            rows = _without(rows, old, ids)
        rows.write.mode("append").partitionBy(DATE).parquet(sink)

    # An empty table first, so that the first batch finds one.
    spark.createDataFrame([], table).write.mode("append").parquet(sink)
    q = (s.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def score_stream_with_model(df: DataFrame, model, features, keep=()) -> DataFrame:
    """R2: a fitted (or loaded) churn model over a batch or streaming frame of
    feature rows; missing features raise."""
    from ..operators.models import score_churn
    return score_churn(model, df, features, keep=keep, strict=True)


def score_stream(df: DataFrame, prob: str = "churn_prob") -> DataFrame:
    """R2: tier, prediction, factors and recommendation as stateless Columns."""
    return df.withColumns({
        "churn_prediction": R.churn_prediction(prob),
        "risk_tier": R.risk_tier(prob),
        "top_factors": R.top_factors(),
    }).withColumn("recommendation", R.recommendation(F.col("risk_tier")))


def daily_activity_stream(events: DataFrame, ts: str = "ts", user: str = "user_id",
                          kind: str = "event_type", watermark: str = "1 day") -> DataFrame:
    """Windowed per-user daily counts on a streaming frame."""
    e = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    k = F.col(kind)
    g = e.groupBy(F.window(ts, "1 day").alias("w"), F.col(user).alias("user_id")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(k == "view").alias("n_views"),
        F.count_if(k == "click").alias("n_clicks"),
        F.count_if(k == "purchase").alias("n_purchases"),
        F.count_if(k == "error").alias("n_errors"),
        F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value_dec"))
    return g.select("user_id", F.to_date(F.col("w.start")).alias("activity_date"),
                    "n_events", "n_views", "n_clicks", "n_purchases", "n_errors",
                    F.col("total_value_dec").cast("double").alias("total_value"))


def run_to_changelog(stream_df: DataFrame, out: str, checkpoint: str,
                     output_mode: str = "update"):
    """Write each micro-batch's updated rows, tagged with its batch id."""
    def write(batch: DataFrame, batch_id: int):
        batch.withColumn("_batch_id", F.lit(batch_id).cast("long")) \
            .write.mode("append").parquet(out)

    q = (stream_df.writeStream.foreachBatch(write).outputMode(output_mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def compact_changelog(spark: SparkSession, path: str, keys, schema: T.StructType | None = None) -> DataFrame:
    """Latest version of each key from a changelog written by ``run_to_changelog``."""
    r = spark.read.schema(schema) if schema is not None else spark.read
    log = r.parquet(path)
    vals = [c for c in log.columns if c not in keys and c != "_batch_id"]
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*vals), "_batch_id").alias("v"))
    return latest.select(*keys, *[F.col(f"v.{c}").alias(c) for c in vals])


def daily_activity_job(spark: SparkSession, events_path: str, work_dir: str | None = None,
                       schema: T.StructType | None = None) -> DataFrame:
    """R3 end to end: stream the events file(s), compact, return the table."""
    base = work_dir or os.path.join(checkpoint_dir(spark), "stream_daily_activity",
                                    uuid.uuid4().hex)
    sch = schema or spark.read.parquet(events_path).schema
    s = _stream(spark, events_path, sch)
    q = run_to_changelog(daily_activity_stream(s), os.path.join(base, "changelog"),
                         os.path.join(base, "_checkpoint"))
    if q.exception():
        raise q.exception()
    out_schema = T.StructType([
        T.StructField("user_id", sch["user_id"].dataType), T.StructField("activity_date", T.DateType()),
        *[T.StructField(c, T.LongType()) for c in
          ("n_events", "n_views", "n_clicks", "n_purchases", "n_errors")],
        T.StructField("total_value", T.DoubleType()), T.StructField("_batch_id", T.LongType())])
    return compact_changelog(spark, os.path.join(base, "changelog"),
                             ["user_id", "activity_date"], out_schema)


def ingest_job(spark: SparkSession, source: str, id_cols, ts_col: str, watermark: str = "1 day",
               work_dir: str | None = None, source_name: str = "stream",
               batch_id: str = "stream_batch") -> DataFrame:
    """R1 end to end: ingest ``source`` incrementally and return the sink table."""
    base = work_dir or os.path.join(checkpoint_dir(spark), "stream_ingest", uuid.uuid4().hex)
    sch = spark.read.parquet(source).schema
    sink = os.path.join(base, "table")
    q = ingest_incremental(spark, source, sch, sink, os.path.join(base, "_checkpoint"),
                           id_cols, ts_col, watermark, source_name, batch_id)
    if q.exception():
        raise q.exception()
    out_schema = T.StructType([T.StructField(f.name, T.TimestampType() if f.name == ts_col
                                             else f.dataType, True) for f in sch.fields]
                              + [T.StructField("_ingested_at", T.TimestampNTZType()),
                                 T.StructField("_source", T.StringType()),
                                 T.StructField("_batch_id", T.StringType())])
    return spark.read.schema(out_schema).parquet(sink)


def scoring_job(spark: SparkSession, features: DataFrame, work_dir: str | None = None) -> DataFrame:
    """R2 end to end: features are landed as files, streamed through
    ``score_stream`` with ``availableNow`` and the scored table is returned."""
    base = work_dir or os.path.join(checkpoint_dir(spark), "stream_scoring", uuid.uuid4().hex)
    src = os.path.join(base, "input")
    features.write.mode("overwrite").parquet(src)
    sch = spark.read.parquet(src).schema
    scored = score_stream(_stream(spark, src, sch))
    out = os.path.join(base, "scored")
    q = (scored.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(base, "_checkpoint"))
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.schema(scored.schema).parquet(out)
