"""Quality gates, row counts, fingerprint, sampling and splits."""

from pyspark.sql import functions as F

from retentio.operators import quality as Q
from retentio.operators.sampling import exact_sample, hash_split, stratified_split


def test_check_table(spark):
    df = spark.createDataFrame([("a", "Yes", "10"), (None, "No", "x"), ("c", "maybe", "-1")],
                               "id string, churn string, charge string")
    r = {x.check: x for x in Q.check_table(df, {
        "no_null_ids": Q.not_null("id"), "valid_churn": Q.in_domain("churn", ["Yes", "No"]),
        "positive_charges": Q.non_negative("charge")}, min_rows=7000).collect()}
    assert not r["row_count"].ok and r["row_count"].failing_rows == 3
    assert r["no_null_ids"].failing_rows == 1
    assert r["valid_churn"].failing_rows == 1
    assert r["positive_charges"].failing_rows == 2   # junk text fails, unlike the reference


def test_fingerprint_order_free(spark):
    a = spark.range(1000).select("id", (F.col("id") * 3).alias("v"))
    b = a.repartition(7).orderBy(F.desc("id"))
    assert a.transform(Q.fingerprint).first() == b.transform(Q.fingerprint).first()
    c = a.withColumn("v", F.when(F.col("id") == 5, 0).otherwise(F.col("v")))
    assert a.transform(Q.fingerprint).first() != c.transform(Q.fingerprint).first()


def test_exact_sample_size(spark):
    df = spark.range(5000)
    assert exact_sample(df, "id", 800).count() == 800
    assert exact_sample(spark.range(100), "id", 800).count() == 100


def test_stratified_split_exact(spark):
    df = spark.range(1003).select("id", (F.col("id") % 4 == 0).cast("int").alias("label"))
    s = stratified_split(df, "id", "label", 0.8)
    g = {(r.label, r.split): r["count"] for r in s.groupBy("label", "split").count().collect()}
    n1 = df.filter("label = 1").count()
    n0 = 1003 - n1
    assert g[(1, "train")] == int(0.8 * n1) and g[(0, "train")] == int(0.8 * n0)
    assert s.count() == 1003 and s.select("id").distinct().count() == 1003


def test_hash_split_no_shuffle(spark):
    s = hash_split(spark.range(10000), "id", 0.8)
    n = s.filter("split = 'train'").count()
    assert 7700 < n < 8300
    assert "Exchange" not in s._jdf.queryExecution().executedPlan().toString()


def test_run_log_and_history(spark, tmp_path):
    from retentio.sources.runs import log_run, metric_history, read_runs
    p = str(tmp_path / "runs")
    log_run(spark, p, "churn", {"depth": 6}, {"auc": 0.80}, run_id="r1")
    log_run(spark, p, "churn", {"depth": 6}, {"auc": 0.85}, run_id="r2")
    h = metric_history(read_runs(spark, p), "auc").orderBy("ts").collect()
    assert [x.run_id for x in h] == ["r1", "r2"] and abs(h[1].change - 0.05) < 1e-12
    assert read_runs(spark, p).first().params == {"depth": "6"}


def test_monitoring_report(spark):
    from retentio.operators.drift import monitoring_report
    p = spark.createDataFrame([("a", 0.05), ("b", 0.25)], "feature string, psi double")
    s = spark.createDataFrame([(False,)], "alarm boolean")
    q = spark.createDataFrame([("row_count", True), ("ids", True)], "check string, ok boolean")
    r = monitoring_report(p, s, q).first()
    assert r.feature_drift and r.retrain_required and r.quality_ok and not r.prediction_drift


def test_scd2_collapses_and_looks_up(spark):
    import datetime as dt
    from retentio.operators.history import as_of_lookup, scd2
    D = dt.datetime
    rows = [(1, D(2020, 1, 1), "A", 1), (1, D(2020, 2, 1), "A", 2), (1, D(2020, 3, 1), "B", 3),
            (1, D(2020, 3, 1), "C", 4), (1, D(2020, 5, 1), "C", 5), (2, D(2020, 1, 5), "X", 6)]
    ch = spark.createDataFrame(rows, "cust long, ts timestamp_ntz, tier string, seq long")
    h = scd2(ch, "cust", "ts", ["tier"], order_tiebreak="seq").orderBy("cust", "version").collect()
    assert [(r.cust, r.tier, r.version) for r in h] == [(1, "A", 1), (1, "B", 2), (1, "C", 3), (2, "X", 1)]
    assert h[0].valid_to == D(2020, 3, 1) and h[2].is_current and h[3].is_current
    pts = spark.createDataFrame([(1, D(2020, 2, 15)), (1, D(2021, 1, 1)), (2, D(2019, 1, 1))],
                                "cust long, at timestamp_ntz")
    hist = scd2(ch, "cust", "ts", ["tier"], order_tiebreak="seq")
    got = {(r.cust, r.at): r.tier for r in as_of_lookup(hist, pts, "cust", "at").collect()}
    assert got[(1, D(2020, 2, 15))] == "A" and got[(1, D(2021, 1, 1))] == "C" and got[(2, D(2019, 1, 1))] is None


def test_summary_report_fields_and_length(spark):
    """Reference invariant: each summary has its fields and more than 50 characters."""
    import __spark_entry__ as E
    from .conftest import SF001
    rows = E.queries()["summary_report"](spark, SF001).collect()
    assert len(rows) == 12
    assert {r.report_type for r in rows} == {"executive", "churn", "revenue", "risk"}
    assert all(len(r.summary) > 50 for r in rows)


def test_portable_hash_large_ids(spark):
    from retentio.operators.sampling import portable_hash
    ids = [0, 1, 12345, 2**31 - 1, 2**32 + 7, 15_000_000_000, 2**62 + 3]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = [r[0] for r in df.select(portable_hash("id", 42)).collect()]
    assert got == [(i * 2654435761 + 42) % 4294967296 for i in ids]


def test_gate_raises_with_the_failed_names(spark):
    import pytest
    from retentio.operators import quality as Q
    df = spark.createDataFrame([(1, "x"), (None, "x")], "a int, b string")
    good = Q.check_table(df, {"b_known": Q.not_null("b")}, min_rows=1, table="t")
    assert Q.require(good).count() == 2
    with pytest.raises(ValueError, match="t:a_known"):
        Q.require(Q.check_table(df, {"a_known": Q.not_null("a")}, table="t"))


def test_fingerprint_tells_null_positions_apart(spark):
    from retentio.operators import quality as Q
    a = spark.createDataFrame([(None, "x")], "a string, b string")
    b = spark.createDataFrame([("x", None)], "a string, b string")
    assert Q.fingerprint(a).first() != Q.fingerprint(b).first()


def test_csv_with_other_columns_raises(spark, tmp_path):
    import pytest
    from retentio.sources.bronze import TELCO_COLUMNS, read_csv
    cols = TELCO_COLUMNS[:1] + [TELCO_COLUMNS[3], TELCO_COLUMNS[2], TELCO_COLUMNS[1]] + TELCO_COLUMNS[4:]
    p = tmp_path / "t.csv"
    p.write_text(",".join(cols) + "\n" + ",".join(["1"] * len(cols)) + "\n")
    with pytest.raises(Exception):
        read_csv(spark, str(p)).collect()
