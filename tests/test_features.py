"""Feature builder (P1–P16) on FIXTURES §1 edge rows; reference invariants."""

import math

from retentio.operators.features import FEATURE_COLUMNS, churn_features, keep_existing, model_matrix
from retentio.sources.bronze import TELCO_COLUMNS, clean_telco, normalise_columns


def _bronze(spark):
    base = dict(customerID="c", gender="Male", SeniorCitizen=0, Partner="Yes", Dependents="No",
                tenure=12, PhoneService="Yes", MultipleLines="No", InternetService="Fiber optic",
                OnlineSecurity="No", OnlineBackup="Yes", DeviceProtection="No", TechSupport="No",
                StreamingTV="Yes", StreamingMovies="No", Contract="Month-to-month",
                PaperlessBilling="Yes", PaymentMethod="Electronic check", MonthlyCharges=70.0,
                TotalCharges="840", Churn="Yes")
    edits = [
        dict(customerID="blank", TotalCharges=" ", tenure=0, Churn="No"),
        dict(customerID="junk", TotalCharges="abc", MonthlyCharges=0.0, Churn=None),
        dict(customerID="lower", Churn="yes", tenure=48, Partner="yes", gender="female"),
        dict(customerID="long", tenure=72, MonthlyCharges=70.01, Contract="Two year"),
        dict(customerID="over", tenure=80, Contract=None, InternetService="No"),
    ]
    rows = []
    for e in edits:
        r = dict(base)
        r.update(e)
        rows.append(tuple(r[c] for c in TELCO_COLUMNS))
    schema = ", ".join(f"{c} {'int' if c in ('SeniorCitizen', 'tenure') else 'double' if c == 'MonthlyCharges' else 'string'}"
                       for c in TELCO_COLUMNS)
    return clean_telco(spark.createDataFrame(rows, schema), batch_id="b1")


def test_clean_telco_lineage_and_coercion(spark):
    b = _bronze(spark)
    assert "totalcharges" in b.columns and "_batch_id" in b.columns and "customerid" in b.columns
    r = {x.customerid: x for x in b.collect()}
    assert r["blank"].totalcharges == 0.0 and r["junk"].totalcharges == 0.0
    assert len({x._ingested_at for x in r.values()}) == 1


def test_name_collision_raises(spark):
    import pytest
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError):
        normalise_columns(df)


def test_churn_features_edges(spark):
    f = churn_features(_bronze(spark))
    r = {x.customer_id: x for x in f.collect()}
    assert r["lower"].label == 1 and r["junk"].label == 0 and r["blank"].label == 0
    assert r["lower"].has_partner == 1 and r["lower"].is_male == 0
    assert r["junk"].implied_tenure == 0.0          # monthly 0 → 0, not inf
    assert r["lower"].is_long_tenure == 0 and r["long"].is_long_tenure == 1   # > 48
    assert r["blank"].is_new_customer == 1 and r["lower"].is_new_customer == 0
    assert r["lower"].is_high_value == 0 and r["long"].is_high_value == 1     # > 70
    assert r["over"].contract_type == "Month-to-month"   # null default
    assert r["over"].is_monthly_contract == 0            # flag is on the raw value
    assert r["blank"].services_count == 2                # backup + tv
    assert r["long"].lifetime_value == round(70.01 * 72, 2)


def test_reference_invariants(spark):
    f = churn_features(_bronze(spark))
    pdf = f.toPandas()
    assert set(pdf["label"].unique()) <= {0, 1}
    assert pdf["label"].notna().all()
    assert len(f.columns) >= 40
    num = pdf.select_dtypes("number")
    assert not num.isna().any().any()
    assert all(math.isfinite(v) for v in num.to_numpy().ravel())


def test_model_matrix_backfills(spark):
    f = churn_features(_bronze(spark)).drop("has_phone")
    m = model_matrix(f)
    assert m.columns[1:-1] == FEATURE_COLUMNS
    assert {r.has_phone for r in m.collect()} == {0.0}
    assert keep_existing(f, ["label", "nope", "customer_id"]).columns == ["label", "customer_id"]


def test_bronze_csv_roundtrip(spark, tmp_path):
    import csv
    from retentio.sources.bronze import load_bronze, read_csv, write_csv, write_parquet
    raw = tmp_path / "raw"
    raw.mkdir()
    with open(raw / "telco.csv", "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(TELCO_COLUMNS)
        w.writerow(["a", "Male", 0, "Yes", "No", 5, "Yes", "No", "DSL", "No", "No", "No", "No", "No", "No",
                    "Month-to-month", "Yes", "Electronic check", 29.85, " ", "No"])
        w.writerow(["b", "Female", 1, "No", "No", 40, "Yes", "Yes", "Fiber optic", "Yes", "No", "Yes", "No",
                    "Yes", "Yes", "One year", "No", "Mailed check", 99.5, "3980.1", "Yes"])
    b = clean_telco(read_csv(spark, str(raw)), source="telco_csv", batch_id="b7")
    out = str(tmp_path / "bronze")
    write_parquet(b, out, partition_by="contract")
    write_parquet(b.filter("customerid = 'b'"), out, partition_by="contract")  # dynamic overwrite
    back = load_bronze(spark, out)
    assert back.count() == 2
    assert {r.customerid: r.totalcharges for r in back.collect()} == {"a": 0.0, "b": 3980.1}
    write_csv(back.select("customerid", "totalcharges"), str(tmp_path / "csv_out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv_out")).count() == 2
    f = churn_features(back).collect()
    assert sorted(r.label for r in f) == [0, 1]


def test_format_helpers(spark):
    from retentio.functions.fmt import id_code, money_text, month_text, pct_text
    df = spark.createDataFrame([(1234.5, 0.123, 42)], "m double, p double, i long")
    r = df.select(money_text("m").alias("a"), pct_text("p").alias("b"), id_code("i").alias("c"),
                  month_text(__import__("pyspark.sql.functions", fromlist=["lit"]).lit("2024-03-05").cast("date")).alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == ("$1,234", "12.3%", "CUST_000042", "2024-03")


def test_churn_features_with_engagement(spark):
    from retentio.operators.features import ENGAGEMENT_COLUMNS
    b = _bronze(spark)
    eng = spark.createDataFrame(
        [("lower", 4, 1, 2, 3, 120.0, 40.0, 5.5, 1, 2, 60.5, 9)],
        "customer_id string, " + ", ".join(
            f"{c} {'double' if 'revenue' in c or c == 'avg_order_value' else 'int'}" for c in ENGAGEMENT_COLUMNS))
    f = {r.customer_id: r for r in churn_features(b, eng).collect()}
    assert f["lower"].total_support_tickets == 4 and f["lower"].negative_ticket_ratio == 0.25
    assert f["lower"].lifetime_value == round(70.0 * 48 + 120.0, 2)
    assert f["blank"].total_support_tickets == 0 and f["blank"].negative_ticket_ratio == 0.0
    assert f["junk"].charge_to_ltv_ratio == 0.0   # ltv 0 → 0


def test_bronze_to_score(spark):
    """Bronze and engagement → features → fit → serving row → score."""
    from retentio.functions.serving import serving_columns
    from retentio.operators import features as FE
    from retentio.operators import models as MD
    from retentio.plans import adapt as A
    from retentio.plans.catalog import telco_features
    from .conftest import SF001
    m = telco_features(spark, SF001)
    assert set(FE.FEATURE_COLUMNS) <= set(m.columns)
    model = MD.fit_churn(m, rounds=2, strict=True)
    e = A.engineered(spark, SF001)
    row = e.select("customer_id", *[c.alias(n) for n, c in serving_columns(has_partner="partner", has_dependents="dependents").items()])
    assert [c for c in row.columns if c != "customer_id"] == FE.FEATURE_COLUMNS
    s = MD.score_churn(model, row, strict=True)
    assert s.count() == 150 and s.where("churn_probability between 0 and 1").count() == 150
