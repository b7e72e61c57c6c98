"""Differential test: every registered query against its DuckDB oracle (sf0.01)."""

import pytest

import __spark_entry__ as E
from tests.oracle_harness import compare, duck

from .conftest import SF01

SQL = E.oracle_sql()
@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, key, E.queries()[key], SQL.get(key), SF01)
    assert r["status"] == "exact", r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1 and df.columns == ["contract_type", "n_customers", "churned", "churn_rate"]


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(E.queries())
