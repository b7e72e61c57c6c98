"""PSI, KS and mean-shift properties."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retentio.operators.drift import ks_statistic, mean_shift, psi


def test_psi_identical_is_zero(spark):
    rng = np.random.default_rng(42)
    x = spark.createDataFrame([(float(v),) for v in rng.uniform(18, 118, 1000)], "m double")
    p = psi(x, x, ["m"]).first()
    assert abs(p.psi) < 1e-12 and p.status == "STABLE"


def test_psi_shift_detected(spark):
    rng = np.random.default_rng(1)
    a = spark.createDataFrame([(float(v),) for v in rng.normal(0, 1, 2000)], "m double")
    b = spark.createDataFrame([(float(v),) for v in rng.normal(1.5, 1, 2000)], "m double")
    p = psi(a, b, ["m"]).first()
    assert p.psi > 0.2 and p.status == "DRIFT"


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 20), min_size=5, max_size=60),
       st.lists(st.integers(0, 20), min_size=5, max_size=60))
def test_psi_non_negative_ks_in_unit(spark, a, b):
    da = spark.createDataFrame([(float(v),) for v in a], "m double")
    db = spark.createDataFrame([(float(v),) for v in b], "m double")
    assert psi(da, db, ["m"]).first().psi >= -1e-12
    k = ks_statistic(da, db, "m").first().ks_statistic
    assert 0.0 <= k <= 1.0


def test_ks_against_numpy(spark):
    rng = np.random.default_rng(7)
    a, b = rng.normal(0, 1, 300), rng.normal(0.3, 1, 200)
    da = spark.createDataFrame([(float(v),) for v in a], "m double")
    db = spark.createDataFrame([(float(v),) for v in b], "m double")
    grid = np.sort(np.concatenate([a, b]))
    ref = np.max(np.abs(np.searchsorted(np.sort(a), grid, side="right") / len(a)
                        - np.searchsorted(np.sort(b), grid, side="right") / len(b)))
    assert abs(ks_statistic(da, db, "m").first().ks_statistic - ref) < 1e-12


def test_mean_shift_alarm(spark):
    a = spark.range(100).select((F.col("id") % 10).cast("double").alias("p"))
    b = spark.range(100).select(((F.col("id") % 10) * 1.2).alias("p"))
    r = mean_shift(a, b, "p").first()
    assert abs(r.drift_pct - 20.0) < 1e-9 and r.alarm


def test_psi_approx_edges_close_to_exact(spark):
    """The bounded-memory option (percentile_approx edges) stays close to exact."""
    rng = np.random.default_rng(5)
    a = spark.createDataFrame([(float(v),) for v in rng.normal(0, 1, 3000)], "m double")
    b = spark.createDataFrame([(float(v),) for v in rng.normal(0.3, 1, 3000)], "m double")
    exact = psi(a, b, ["m"], exact=True).first().psi
    approx = psi(a, b, ["m"], exact=False).first().psi
    assert abs(exact - approx) < 0.01 and exact > 0.05


def test_empty_and_nan_sides(spark):
    """A side without values gives NO DATA and null; NaN is missing, not drift."""
    from retentio.operators import drift as DR
    base = spark.createDataFrame([(float(k),) for k in range(50)], "x double")
    nan = base.unionByName(spark.createDataFrame([(float("nan"),)] * 50, "x double"))
    r = DR.psi(base, nan, ["x"]).first()
    assert abs(r.psi) < 1e-12 and r.status == "STABLE" and r.missing_cur == 0.5 and r.missing_base == 0.0
    empty = DR.psi(base, base.limit(0), ["x"]).first()
    assert empty.psi is None and empty.status == "NO DATA"
    assert DR.ks_statistic(base, base.limit(0), "x").first().ks_statistic is None
    assert DR.ks_statistic(base, nan, "x").first().ks_statistic == 0.0
