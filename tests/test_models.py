"""Model operators: ordering, save/load, k-means naming, isolation forest rate."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from retentio.operators import models as MD
from retentio.operators.anomaly import isolation_forest
from retentio.operators.features import FEATURE_COLUMNS


def _train(spark, n=400):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        risky = i % 3 == 0
        rows.append((f"c{i}", int(risky),
                     float(rng.integers(1, 10) if risky else rng.integers(30, 72)),
                     float(rng.uniform(80, 110) if risky else rng.uniform(20, 60)),
                     int(risky), int(rng.integers(3, 8) if risky else rng.integers(0, 2))))
    return spark.createDataFrame(rows, "customer_id string, label int, tenure_months double, "
                                       "monthly_charges double, is_monthly_contract int, "
                                       "total_support_tickets int")


def test_churn_ensemble_orders_risk_and_saves(spark, tmp_path):
    df = _train(spark)
    m = MD.fit_churn(df, rounds=5)
    probe = spark.createDataFrame([("high", 0, 2.0, 95.0, 1, 6), ("low", 0, 60.0, 45.0, 0, 0)],
                                  df.schema)
    s = {r.customer_id: r for r in MD.score_churn(m, probe).collect()}
    assert 0.0 <= s["low"].churn_probability <= 1.0
    assert s["high"].churn_probability >= 0.5 and s["high"].churn_probability > s["low"].churn_probability
    assert s["low"].risk_tier in ("LOW", "MEDIUM")
    path = str(tmp_path / "churn_model")
    MD.save_model(m, path)
    again = {r.customer_id: r.churn_probability for r in MD.score_churn(MD.load_model(path), probe).collect()}
    assert again == {k: v.churn_probability for k, v in s.items()}
    MD.validate_models({"churn": path}, {"churn": MD.model_matrix(probe, FEATURE_COLUMNS)})


def test_kmeans_segments_named(spark):
    df = _train(spark).withColumn("lifetime_value", F.col("monthly_charges") * F.col("tenure_months"))
    r = MD.kmeans_segments(df, "customer_id", ["tenure_months", "monthly_charges", "total_support_tickets"],
                           ks=range(3, 5), max_iter=5)
    pdf = r.toPandas()
    assert len(pdf) == 400 and pdf["k"].iloc[0] in (3, 4)
    assert set(pdf["segment_name"]) <= {"Champions", "Loyal Customers", "Potential Loyalists", "At Risk", "Lost"}
    assert -1.0 <= pdf["silhouette"].iloc[0] <= 1.0


def test_isolation_forest_flags_outliers(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 1, (2000, 2)))]
    rows += [(5000 + i, 15.0 + i, -15.0) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    r = isolation_forest(df, "id", ["a", "b"], n_trees=50, sample_size=128).toPandas()
    assert 0.03 < r["is_anomaly"].mean() < 0.07
    assert r.loc[r.id >= 5000, "is_anomaly"].all()
    assert r.loc[r.id >= 5000, "anomaly_score"].min() > r.loc[r.id < 5000, "anomaly_score"].median()


def test_forest_is_a_function_of_its_rows(spark):
    """Partitioning and order have no bearing; every inner node has two children whose sizes add up."""
    from retentio.operators.anomaly import fit_isolation_forest, mix32, path_length, score_isolation_forest, _mix32_column
    df = spark.range(3000).select("id", (F.col("id") * 37 % 101).cast("double").alias("a"), F.when(F.col("id") % 9 > 0, F.col("id") % 7).cast("double").alias("b"))
    fit = lambda d: fit_isolation_forest(d, "id", ["a", "b"], 20, 100, 5).toPandas().sort_values(["tree", "node"]).reset_index(drop=True)
    a, b = fit(df.repartition(3)), fit(df.orderBy(F.desc("id")).repartition(7))
    assert a.equals(b) and a["tree"].nunique() == 20
    at = {(r.tree, r.node): r for r in a.itertuples()}
    for (t, n), r in at.items():
        if r.feature >= 0:
            assert at[t, 2 * n].size + at[t, 2 * n + 1].size == r.size and at[t, 2 * n].depth == r.depth + 1
        else:
            assert (t, 2 * n) not in at
    # One row's score, walked by hand.
    row = df.where("id = 77").first()
    total = 0
    for t in range(20):
        n = 1
        while at[t, n].feature >= 0:
            n = 2 * n + ((row.a, row.b or 0.0)[at[t, n].feature] >= at[t, n].split)
        total += at[t, n].depth + path_length(at[t, n].size)
    psi = sum(at[t, 1].size for t in range(20)) / 20
    got = score_isolation_forest(df.where("id = 77"), a, "id", ["a", "b"], keep=["a"]).first()
    assert abs(got.anomaly_score - 2 ** (-total / 20 / path_length(psi))) < 1e-9 and got.a == row.a
    numbers = [0, 1, 2 ** 32 - 1, 123456789, 2654435761]
    cols = spark.createDataFrame([(x,) for x in numbers], "x long").select(_mix32_column(F.col("x")).alias("m")).collect()
    assert [r.m for r in cols] == [mix32(x) for x in numbers]


def test_forest_of_few_rows_and_other_keys(spark):
    from retentio.operators.anomaly import fit_isolation_forest, isolation_forest, score_isolation_forest
    one = spark.createDataFrame([("x", 1.0)], "id string, a double")
    nodes = fit_isolation_forest(one, "id", ["a"], 3, 16).toPandas()
    assert (nodes["feature"] == -1).all()
    assert 0.0 < score_isolation_forest(one, nodes, "id", ["a"]).first().anomaly_score <= 1.0
    same = spark.createDataFrame([(str(k), 4.0) for k in range(50)], "id string, a double")
    assert isolation_forest(same, "id", ["a"], n_trees=5, sample_size=16).agg(F.sum("is_anomaly")).first()[0] == 0


def test_feature_importances_and_saved_forest(spark, tmp_path):
    from retentio.operators.anomaly import fit_isolation_forest, save_forest, score_with_saved_forest
    df = _train(spark)
    m = MD.fit_churn(df, rounds=3)
    imp = MD.feature_importances(m, FEATURE_COLUMNS, top=5).collect()
    assert len(imp) == 5 and imp[0].importance >= imp[-1].importance
    rows = spark.range(500).select("id", (F.col("id") % 17).cast("double").alias("a"),
                                   (F.col("id") % 5).cast("double").alias("b"))
    nodes = fit_isolation_forest(rows, "id", ["a", "b"], n_trees=10, sample_size=64)
    path = str(tmp_path / "forest")
    save_forest(nodes, path)
    s = score_with_saved_forest(rows, path, "id", ["a", "b"], sample_size=64)
    assert s.count() == 500 and s.filter("anomaly_score <= 0 or anomaly_score >= 1").count() == 0


def test_split_valid(spark):
    from retentio.functions.rules import split_valid
    df = spark.createDataFrame([(1, 5.0), (None, -1.0), (3, -2.0)], "id int, x double")
    good, bad = split_valid(df, {"id_present": F.col("id").isNotNull(), "x_non_negative": F.col("x") >= 0})
    assert good.count() == 1 and bad.count() == 2
    assert {tuple(r.violations) for r in bad.collect()} == {("id_present", "x_non_negative"), ("x_non_negative",)}


REQUEST = {"customer_id": "x", "tenure_months": 8.0, "monthly_charges": 85.0, "total_charges": 680.0, "contract_type": "Month-to-month",
           "payment_method": "Electronic check", "internet_service": "Fiber optic", "online_security": "No", "tech_support": "No",
           "num_support_tickets": 3, "is_senior_citizen": 0, "has_partner": "No", "has_dependents": "No", "paperless_billing": "Yes", "gender": "Male"}


def _requests(spark, *changes):
    from pyspark.sql import Row
    types = ("customer_id string, tenure_months double, monthly_charges double, total_charges double, contract_type string, payment_method string, "
             "internet_service string, online_security string, tech_support string, num_support_tickets int, is_senior_citizen int, has_partner string, "
             "has_dependents string, paperless_billing string, gender string")
    return spark.createDataFrame([Row(**{**REQUEST, **c}) for c in changes], types)


@pytest.fixture(scope="module")
def request_model(spark):
    """An ensemble fitted on the serving features of requests whose churn follows the risk rules."""
    from retentio.functions.serving import with_serving_features
    rng = np.random.default_rng(5)
    pick = lambda *v: v[int(rng.integers(len(v)))]
    rows, labels = [], []
    for k in range(500):
        tenure, monthly = float(rng.integers(1, 72)), float(rng.uniform(20, 110))
        c = {"customer_id": f"c{k}", "tenure_months": tenure, "monthly_charges": monthly, "total_charges": tenure * monthly,
             "contract_type": pick("Month-to-month", "One year", "Two year"), "internet_service": pick("Fiber optic", "DSL", "No"),
             "online_security": pick("Yes", "No"), "tech_support": pick("Yes", "No"), "num_support_tickets": int(rng.integers(0, 6))}
        risk = (c["contract_type"] == "Month-to-month") * 0.42 + (tenure < 12) * 0.31 + (c["internet_service"] == "Fiber optic") * 0.24 + (c["num_support_tickets"] >= 3) * 0.19
        rows.append(c)
        labels.append((f"c{k}", int(risk + rng.normal(0, 0.1) > 0.6)))
    train = with_serving_features(_requests(spark, *rows)).join(spark.createDataFrame(labels, "customer_id string, label int"), "customer_id")
    return MD.fit_churn(train, FEATURE_COLUMNS, rounds=12, strict=True)


def test_requests_are_scored_as_customers_are(spark, request_model):
    """A risky customer is predicted to churn with factors and a recommendation, a safe one is not."""
    safe = {"customer_id": "safe", "tenure_months": 60.0, "monthly_charges": 45.0, "total_charges": 2700.0, "contract_type": "Two year",
            "internet_service": "DSL", "online_security": "Yes", "tech_support": "Yes", "num_support_tickets": 0}
    risky = {"customer_id": "risky", "tenure_months": 2.0, "monthly_charges": 95.0, "total_charges": 190.0, "num_support_tickets": 5}
    got = {r.customer_id: r for r in MD.score_requests(request_model, _requests(spark, safe, risky)).collect()}
    assert got["risky"].churn_probability > 0.6 and got["risky"].churn_prediction and got["risky"].risk_tier in ("HIGH", "MEDIUM")
    assert got["safe"].churn_probability < 0.4 and not got["safe"].churn_prediction
    assert got["risky"].top_factors[0].feature == "contract_type" and len(got["risky"].recommendation) > 10 and got["safe"].top_factors == []
    assert got["risky"].contract_type == "Month-to-month" and got["safe"].model_version == got["risky"].model_version


def test_saved_model_knows_its_features(spark, request_model, tmp_path):
    path = str(tmp_path / "m")
    MD.save_model(request_model, path)
    assert MD.saved_features(path) == list(FEATURE_COLUMNS) == MD.model_features(MD.load_model(path, FEATURE_COLUMNS))
    with pytest.raises(ValueError, match="other features"):
        MD.load_model(path, FEATURE_COLUMNS[:-1])
    with pytest.raises(ValueError, match="order differs"):
        MD.load_model(path, FEATURE_COLUMNS[::-1])
    spark.createDataFrame([(0, "tenure_months")], "position int, feature string").write.mode("overwrite").parquet(f"{path}/_features")
    with pytest.raises(ValueError, match="other features"):
        MD.load_model(path)


def test_training_partitions_are_even_and_no_more_than_run_at_once(spark, monkeypatch):
    """Members fitted side by side share the cores; a task beyond them only adds statistics to send."""
    monkeypatch.setattr(MD, "TRAIN_ROWS", 10)
    df = spark.range(0, 4000, 1, 40).select(F.col("id").alias("customer_id"), (F.col("id") % 2).cast("int").alias("label"))
    df = df.where("customer_id % 4 = 0 or customer_id < 1000")  # uneven partitions
    got = MD._sized(df, 2)
    cores = spark.sparkContext.defaultParallelism
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert got.rdd.getNumPartitions() == max(1, cores // 2)
    assert max(sizes) <= min(sizes) + 40 and got.distinct().count() == df.count()
    monkeypatch.setattr(MD, "MOST_TRAIN_ROWS", 100)
    assert MD._sized(df, 2).rdd.getNumPartitions() == -(-df.count() // 100)
    monkeypatch.setattr(MD, "TRAIN_ROWS", 10_000)
    monkeypatch.setattr(MD, "MOST_TRAIN_ROWS", 10_000)
    assert MD._sized(df, 2).rdd.getNumPartitions() == 1
