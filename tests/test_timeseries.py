"""Time features: gap filling, lags, rolling windows exclude the current row."""

import datetime as dt

import pandas as pd

from retentio.operators import timeseries as TS


def _facts(spark):
    rows = [(dt.datetime(2020, m, 5), float(m * 10)) for m in range(1, 13) if m != 4]
    rows += [(dt.datetime(2021, m, 5), float(100 + m)) for m in range(1, 7)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, amt double")


def test_calendar_fill(spark):
    m = TS.monthly_series(_facts(spark), "ts", "amt").orderBy("ds").toPandas()
    assert len(m) == 18
    assert m.loc[m.ds == dt.date(2020, 4, 1), "y"].iat[0] == 0.0


def test_lags_and_rolling_match_pandas(spark):
    m = TS.monthly_series(_facts(spark), "ts", "amt")
    f = TS.rolling_features(TS.lag_features(m), digits=None).orderBy("ds").toPandas()
    y = f["y"]
    assert f["lag_1"].iloc[1:].tolist() == y.iloc[:-1].tolist()
    exp = y.shift(1).rolling(3).mean()
    assert pd.isna(f["rolling_mean_3"].iloc[2]) and abs(f["rolling_mean_3"].iloc[3] - exp.iloc[3]) < 1e-9
    exp_std = y.shift(1).rolling(6).std()
    assert abs(f["rolling_std_6"].iloc[10] - exp_std.iloc[10]) < 1e-9
    # the current month never enters its own window
    assert f["rolling_max_3"].iloc[17] == max(y.iloc[14:17])


def test_time_split_counts(spark):
    m = TS.monthly_series(_facts(spark), "ts", "amt")
    s = TS.time_split(m).groupBy("split").count().toPandas().set_index("split")["count"]
    assert s["train"] == int(0.8 * 18) and s["test"] == 18 - int(0.8 * 18)


def test_forecast_months_use_add_months(spark):
    m = TS.monthly_series(_facts(spark), "ts", "amt")
    f = TS.forecast(TS.fit_trend_season(m), periods=24).orderBy("h").toPandas()
    assert f["ds"].iloc[0] == dt.date(2021, 7, 1)
    assert f["ds"].iloc[23] == dt.date(2023, 6, 1)
    assert (f["lower_bound"] <= f["forecast"]).all() and (f["forecast"] <= f["upper_bound"]).all()


def test_trend_summary(spark):
    m = TS.monthly_series(_facts(spark), "ts", "amt")
    r = TS.trend_summary(m).first()
    assert r.first_y == 10.0 and r.last_y == 106.0 and r.trend == "growing"


def test_reference_revenue_invariants(spark):
    """Reference invariants on the catalogue forecast: 12 periods, positive
    values, trend in its domain."""
    import __spark_entry__ as E
    from .conftest import SF01
    q = E.queries()
    f = q["forecast_trend_season"](spark, SF01).toPandas()
    assert len(f) == 12 and (f["forecast"] > 0).all()
    assert (f["lower_bound"] < f["forecast"]).all() and (f["forecast"] < f["upper_bound"]).all()
    t = q["revenue_trend"](spark, SF01).first()
    assert t.trend in ("growing", "declining", "stable")
