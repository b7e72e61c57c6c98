"""Scoring rules (P19–P24), numeric helpers (P1–P6) and boundaries."""

from pyspark.sql import functions as F

from retentio.functions import rules as R
from retentio.functions.numeric import flag_eq, np_round, safe_div, to_number


def test_np_round_matches_numpy(spark):
    import numpy as np
    vals = [0.145, 1.005, 2.5, 3.5, -2.5, 0.125, 12.3456, 1e-9, 0.0625]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(np_round("x", 2)).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]


def test_to_number_coerces_blank_and_junk(spark):
    df = spark.createDataFrame([(" ",), ("abc",), ("12.5",), (None,), ("",)], "s string")
    got = [r[0] for r in df.select(to_number("s")).collect()]
    assert got == [0.0, 0.0, 12.5, 0.0, 0.0]


def test_flags_null_is_zero_and_case(spark):
    df = spark.createDataFrame([("Yes",), ("yes",), ("No",), (None,)], "c string")
    r = df.select(flag_eq("c", "YES", case_insensitive=True).alias("ci"),
                  flag_eq("c", "Yes").alias("cs")).collect()
    assert [x.ci for x in r] == [1, 1, 0, 0]
    assert [x.cs for x in r] == [1, 0, 0, 0]


def test_safe_div_zero(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_div("a", "b")).collect()] == [0.0, 2.5, 0.0]


def test_tier_boundaries(spark):
    df = spark.createDataFrame([(0.39999,), (0.40,), (0.5,), (0.69999,), (0.70,), (1.0,)], "p double")
    r = df.select(R.risk_tier("p").alias("t"), R.churn_prediction("p").alias("y")).collect()
    assert [x.t for x in r] == ["LOW", "MEDIUM", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]
    assert [x.y for x in r] == [False, False, True, True, True, True]


def _req(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, tenure_months double, monthly_charges double, "
                                       "contract_type string, internet_service string, online_security string, "
                                       "tech_support string, num_support_tickets int")


def test_factors_order_limit_and_titles(spark):
    df = _req(spark, [("risky", 6.0, 90.0, "Month-to-month", "Fiber optic", "No", "No", 5),
                      ("safe", 60.0, 45.0, "Two year", "DSL", "Yes", "Yes", 0),
                      ("one", 30.0, 85.0, "One year", "DSL", "Yes", "Yes", 0)])
    r = {x.customer_id: x for x in df.select(
        "customer_id", R.top_factors().alias("f"),
        R.factor_titles(R.top_factors()).alias("t")).collect()}
    assert [f.feature for f in r["risky"].f] == ["contract_type", "tenure_months", "internet_service",
                                                 "num_support_tickets", "online_security"]
    assert [f.impact for f in r["risky"].f] == [0.42, 0.31, 0.24, 0.19, 0.15]
    assert r["risky"].t == ["Contract Type", "Tenure Months", "Internet Service"]
    assert r["safe"].f == []
    assert [f.feature for f in r["one"].f] == ["monthly_charges"]
    assert all(f.direction == "increases" for f in r["risky"].f)


def test_recommendation_table(spark):
    df = spark.createDataFrame([
        ("HIGH", "Month-to-month", "Yes", "Yes"), ("HIGH", "Two year", "No", "No"),
        ("MEDIUM", "One year", "No", "Yes"), ("MEDIUM", "One year", "Yes", "Yes"),
        ("LOW", "Month-to-month", "No", "No")],
        "tier string, contract_type string, online_security string, tech_support string")
    got = [r[0] for r in df.select(R.recommendation("tier")).collect()]
    assert got == [R.REC_HIGH_MONTHLY, R.REC_HIGH_OTHER, R.REC_MEDIUM_BUNDLE, R.REC_MEDIUM_OTHER, R.REC_LOW]


def test_risk_score_segment_and_drivers(spark):
    df = _req(spark, [("a", 2.9, 95.0, "Month-to-month", "Fiber optic", "No", "No", 6)])
    df = df.withColumn("p", F.lit(0.8123))
    r = df.select(R.risk_score("p").alias("s"), R.probability_segment("p").alias("g"),
                  R.probability_segment(F.lit(1.0)).alias("g1"),
                  R.risk_drivers().alias("d")).first()
    assert r.s == 81.2 and r.g == "Lost" and r.g1 == "Lost"
    assert r.d == ["Month-to-month contract with no lock-in", "Low tenure (2 months)",
                   "High support ticket volume (6 tickets)",
                   "Fiber optic customers churn at higher rates"]


def test_drift_status_and_trend(spark):
    df = spark.createDataFrame([(0.05,), (0.10,), (0.15,), (0.20,), (0.25,)], "p double")
    assert [r[0] for r in df.select(R.drift_status("p")).collect()] == \
        ["STABLE", "STABLE", "WARNING", "WARNING", "DRIFT"]
    t = spark.createDataFrame([(100.0, 106.0), (100.0, 94.0), (100.0, 105.0)], "a double, b double")
    assert [r[0] for r in t.select(R.trend_class("a", "b")).collect()] == ["growing", "declining", "stable"]


def test_tenure_band_right_closed(spark):
    df = spark.createDataFrame([(0,), (1,), (12,), (13,), (48,), (72,), (80,)], "t int")
    assert [r[0] for r in df.select(R.tenure_band("t")).collect()] == \
        [None, "0-12", "0-12", "12-24", "36-48", "48-72", None]


def test_violations(spark):
    df = spark.createDataFrame([(1, 5.0), (None, -1.0)], "id int, x double")
    r = df.select(R.violations({"id_present": F.col("id").isNotNull(),
                                "x_non_negative": F.col("x") >= 0}).alias("v")).collect()
    assert r[0].v == [] and r[1].v == ["id_present", "x_non_negative"]


def test_risk_response_struct(spark):
    df = spark.createDataFrame([(0.81234, 0.1234, "Month-to-month", "No", "Yes")],
                               "p double, a double, contract_type string, online_security string, "
                               "tech_support string")
    r = df.select(R.risk_response("p", "a").alias("r")).first().r
    assert r.score == 81.2 and r.tier == "HIGH" and r.churn_probability == 0.8123
    assert r.anomaly_score == 0.123 and r.segment == "Lost"
    assert r.recommendations == [R.REC_HIGH_MONTHLY]


def test_strict_int_raises_on_null(spark):
    import pytest
    from retentio.functions.numeric import strict_int
    ok = spark.createDataFrame([("1",), ("0",)], "s string").select(strict_int("s")).collect()
    assert [x[0] for x in ok] == [1, 0]
    with pytest.raises(Exception):
        spark.createDataFrame([("1",), (None,)], "s string").select(strict_int("s")).collect()


def test_tiers_monotone_in_probability(spark):
    """Property: a higher probability never gets a lower tier."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    rank = {"LOW": 0, "MEDIUM": 1, "HIGH": 2}

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.floats(0.0, 1.0, allow_nan=False), min_size=2, max_size=50))
    def check(ps):
        df = spark.createDataFrame([(p,) for p in ps], "p double")
        rows = sorted(df.select("p", R.risk_tier("p").alias("t")).collect(), key=lambda r: r.p)
        tiers = [rank[r.t] for r in rows]
        assert tiers == sorted(tiers)

    check()
