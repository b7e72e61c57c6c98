"""R1 twice gives the same rows; R3 equals the batch rollup; late rows drop."""

import os
import shutil

from pyspark.sql import functions as F

from retentio.streaming.jobs import (compact_changelog, daily_activity_job, daily_activity_stream,
                                     ingest_incremental, run_to_changelog, score_stream)

from .conftest import SF001


def test_ingest_incremental_idempotent(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    for i in range(2):  # two copies: every id twice
        shutil.copy(os.path.join(SF001, "events.parquet"), src / f"part{i}.parquet")
    schema = spark.read.parquet(str(src)).schema
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    ingest_incremental(spark, str(src), schema, sink, ck, ["event_id"], "ts", "30 days", "events")
    n1 = spark.read.parquet(sink).count()
    ingest_incremental(spark, str(src), schema, sink, ck, ["event_id"], "ts", "30 days", "events")
    out = spark.read.parquet(sink)
    assert n1 == 1000 and out.count() == 1000
    assert {"_ingested_at", "_source", "_batch_id"} <= set(out.columns)


def test_stream_rollup_equals_batch(spark, tmp_path):
    from retentio.operators.engagement import daily_activity
    s = daily_activity_job(spark, os.path.join(SF001, "events.parquet"), str(tmp_path / "w"))
    b = daily_activity(spark.read.parquet(os.path.join(SF001, "events.parquet"))).drop("engagement_score")
    assert s.count() == b.count()
    assert s.exceptAll(b.select(*s.columns)).count() == 0


def test_late_rows_dropped(spark, tmp_path):
    src = tmp_path / "ev"
    src.mkdir()
    sch = "user_id long, ts timestamp_ntz, event_type string, value double"
    first = spark.createDataFrame([(1, __import__("datetime").datetime(2024, 1, d), "view", 1.0)
                                   for d in (1, 5, 10)], sch)
    first.coalesce(1).write.parquet(str(src / "a"))
    # Spark drops input older than the *previous* batch's watermark, so the
    # late row comes two batches after the one that advanced the watermark
    nxt = spark.createDataFrame([(1, __import__("datetime").datetime(2024, 1, 11), "view", 1.0)], sch)
    nxt.coalesce(1).write.parquet(str(src / "b"))
    late = spark.createDataFrame([(1, __import__("datetime").datetime(2024, 1, 1, 12), "view", 1.0)], sch)
    late.coalesce(1).write.parquet(str(src / "c"))
    stream = (spark.readStream.schema(first.schema).option("maxFilesPerTrigger", 1)
              .parquet(str(src / "*")))
    out, ck = str(tmp_path / "log"), str(tmp_path / "ck")
    run_to_changelog(daily_activity_stream(stream, watermark="1 day"), out, ck)
    t = compact_changelog(spark, out, ["user_id", "activity_date"])
    jan1 = t.filter(F.col("activity_date") == "2024-01-01").first()
    assert jan1.n_events == 1   # the late Jan-1 row arrived after the watermark passed


def test_score_stream_is_stateless(spark):
    df = spark.createDataFrame([(0.8, "Month-to-month", 3.0, "DSL", 0, "No", "No", 50.0)],
                               "churn_prob double, contract_type string, tenure_months double, "
                               "internet_service string, num_support_tickets int, online_security string, "
                               "tech_support string, monthly_charges double")
    r = score_stream(df).first()
    assert r.risk_tier == "HIGH" and r.churn_prediction and len(r.top_factors) == 4


def test_ingest_keeps_late_rows_and_bounds_batches(spark, tmp_path):
    import datetime
    src, sch = tmp_path / "in", "event_id long, ts timestamp_ntz, value double"
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    at = lambda d: datetime.datetime(2024, 1, d)
    batches = [[(1, at(1), 1.0), (2, at(20), 1.0)], [(3, at(2), 1.0), (2, at(20), 2.0), (4, None, 1.0)]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, sch).coalesce(1).write.mode("append").parquet(str(src))
        schema = spark.read.parquet(str(src)).schema
        ingest_incremental(spark, str(src), schema, sink, ck, ["event_id"], "ts", "1 day", "events", max_files=1)
    got = spark.read.parquet(sink)
    assert sorted(r.event_id for r in got.collect()) == [1, 2, 3, 4]  # 3 is 18 days late


def test_saved_model_scores_a_stream(spark, tmp_path):
    from retentio.operators import models as MD
    from retentio.streaming.jobs import score_stream_with_model
    rows = [(k, k % 2, float(k % 2 * 50 + k % 7), float(k % 5)) for k in range(200)]
    df = spark.createDataFrame(rows, "customer_id long, label int, a double, b double")
    MD.save_model(MD.fit_churn(df, ["a", "b"], rounds=2), str(tmp_path / "m"))
    df.write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    scored = score_stream_with_model(s, MD.load_model(str(tmp_path / "m")), ["a", "b"])
    q = (scored.select("customer_id", "churn_probability", "risk_tier").writeStream.format("parquet")
         .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 200 and out.where("churn_probability is null").count() == 0


def test_ingest_takes_rows_without_a_time_once(spark, tmp_path):
    """Null event times and null ids don't come again with later batches; of unequal duplicates the least stays."""
    import datetime as dt
    from retentio.streaming.jobs import ingest_incremental
    src, sink, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    schema = "event_id long, ts timestamp, value double"
    t = dt.datetime(2024, 1, 5)
    batches = [[(1, None, 1.0), (2, t, 2.0), (None, None, 9.0)], [(1, None, 1.0), (3, t, 3.5), (3, t, 3.0), (2, t, 2.0)], [(1, None, 1.0), (None, None, 9.0), (4, None, 4.0)]]
    for rows in batches:
        df = spark.createDataFrame(rows, schema)
        df.coalesce(1).write.mode("append").parquet(src)
        ingest_incremental(spark, src, df.schema, sink, ck, ["event_id"], "ts", batch_id="b")
    got = sorted(((r.event_id, r.ts, r.value) for r in spark.read.parquet(sink).collect()), key=str)
    assert got == sorted([(1, None, 1.0), (2, t, 2.0), (None, None, 9.0), (3, t, 3.0), (4, None, 4.0)], key=str)
