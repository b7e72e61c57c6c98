"""Plan regression tests: the scale properties the README claims.

Only queries without eager build-time jobs are planned here, so the checks
are cheap.  They look at the physical plan before execution.
"""

import re

import pytest

import __spark_entry__ as E

from .conftest import SF01

PLANNED = ["churn_label", "engagement_features", "churn_by_contract", "customer_filter",
           "churn_mart", "kpi_summary", "inactive_customers", "monthly_revenue", "revenue_lags",
           "mom_growth", "segment_revenue_growth", "period_summary", "mean_drift",
           "top_outliers", "daily_activity", "value_distribution"]


def _plan(spark, key, with_subqueries: bool = False):
    df = E.queries()[key](spark, SF01)
    fmt = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return fmt if with_subqueries else fmt.split("===== Subqueries =====")[0]


@pytest.mark.parametrize("key", PLANNED)
def test_no_cartesian_or_nested_loop(spark, key):
    p = _plan(spark, key)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("key", ["monthly_revenue", "revenue_lags", "mom_growth"])
def test_monthly_series_scans_orders_once(spark, key):
    p = _plan(spark, key)
    assert len(re.findall(r"orders\.parquet", p)) == 1


def test_column_pruning_reaches_scan(spark):
    p = _plan(spark, "churn_label")
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    orders = [s for s in schemas if "o_custkey" in s]
    assert orders and all("o_totalprice" not in s and "o_orderpriority" not in s for s in orders)


def test_date_filter_pushed_to_scan(spark):
    p = _plan(spark, "mean_drift", with_subqueries=True)  # current side is a scalar subquery
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(o_orderdate", p)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", p)


def test_no_python_udf_in_feature_queries(spark):
    for key in ["churn_mart", "customer_filter", "engagement_features"]:
        p = _plan(spark, key)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
