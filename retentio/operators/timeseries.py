"""Monthly revenue series, time features, trend forecast and errors.

Series are aggregated first (one row per series and month), so every window
below runs on a frame whose size is #series × #months, partitioned by the
series key.  Calendar gaps are filled before any lag so ``lag(k)`` is always
k months back.  Money is summed as decimals, regressions use exact decimal
moment sums, so results do not depend on partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import np_round
from ..functions.rules import forecast_band, trend_class

LAGS = (1, 2, 3, 6, 12)
ROLLING = (3, 6)


def monthly_series(facts: DataFrame, ts: str, amount: str, series: str | None = None,
                   fill_gaps: bool = True, count: str | None = None) -> DataFrame:
    """``(series, ds, y, n_orders)`` per calendar month; missing months get 0.

    One aggregation pass over the facts.  Gaps are filled from the aggregate
    alone: ``lead(ds)`` per series (a window over #series × #months rows)
    and a single ``explode`` that emits each month followed by the empty
    months before the next one — the facts are never scanned a second time
    for a calendar, and no union or join is needed.  Facts that are already
    summed name the column that holds their ``count``.
    """
    keys = [F.col(series).alias("series")] if series else [F.lit("all").alias("series")]
    m = facts.groupBy(*keys, F.date_trunc("month", F.col(ts)).cast("date").alias("ds")).agg(
        F.sum(F.col(amount).cast("decimal(18,2)")).cast("double").alias("y"),
        (F.sum(count) if count else F.count(F.lit(1))).alias("n_orders"))
    if not fill_gaps:
        return m
    nxt = F.lead("ds").over(Window.partitionBy("series").orderBy("ds"))
    m = m.withColumn("_next", nxt)
    gap = F.when(F.col("_next") > F.add_months("ds", 1),
                 F.sequence(F.add_months("ds", 1), F.add_months("_next", -1),
                            F.expr("INTERVAL 1 MONTH"))).otherwise(F.array().cast("array<date>"))
    own = F.struct(F.col("ds").alias("ds"), F.col("y").alias("y"), F.col("n_orders").alias("n_orders"))
    rows = F.concat(F.array(own), F.transform(gap, lambda d: F.struct(
        d.alias("ds"), F.lit(0.0).alias("y"), F.lit(0).cast("long").alias("n_orders"))))
    return m.select("series", F.explode(rows).alias("r")).select(
        "series", "r.ds", "r.y", "r.n_orders")


def _w(series: str = "series", ds: str = "ds"):
    return Window.partitionBy(series).orderBy(ds)


def lag_features(df: DataFrame, lags=LAGS, y: str = "y") -> DataFrame:
    """``lag_k`` of y in date order per series."""
    w = _w()
    return df.withColumns({f"lag_{k}": F.lag(y, k).over(w) for k in lags})


def rolling_features(df: DataFrame, windows=ROLLING, y: str = "y", digits: int | None = 2) -> DataFrame:
    """Rolling mean / sample std / max over the previous w rows (current
    row excluded), null until the window is full."""
    cols = {}
    for win in windows:
        fr = _w().rowsBetween(-win, -1)
        full = F.count(y).over(fr) == win
        mean = F.avg(y).over(fr)
        std = F.stddev_samp(y).over(fr)
        if digits is not None:
            mean, std = np_round(mean, digits), np_round(std, digits)
        cols[f"rolling_mean_{win}"] = F.when(full, mean)
        cols[f"rolling_std_{win}"] = F.when(full, std)
        cols[f"rolling_max_{win}"] = F.when(full, F.max(y).over(fr))
    return df.withColumns(cols)


def calendar_features(df: DataFrame, ds: str = "ds") -> DataFrame:
    """month, quarter, year and the month's position on the unit circle."""
    m = F.month(ds)
    ang = F.lit(2 * math.pi) * m / F.lit(12.0)
    return df.withColumns({"month": m, "quarter": F.quarter(ds), "year": F.year(ds),
                           "month_sin": F.sin(ang), "month_cos": F.cos(ang)})


def time_features(df: DataFrame, drop_warmup: bool = True) -> DataFrame:
    """Calendar, lag and rolling features; warm-up rows dropped."""
    out = rolling_features(lag_features(calendar_features(df)))
    return out.na.drop() if drop_warmup else out


def growth(df: DataFrame, y: str = "y") -> DataFrame:
    """Month-over-month growth % (null for the first month or a zero base)."""
    prev = F.lag(y, 1).over(_w())
    return df.withColumn("prev_y", prev).withColumn(
        "mom_growth_pct", F.try_divide((F.col(y) - F.col("prev_y")) * 100.0, F.col("prev_y")))


def cumulative(df: DataFrame, y: str = "y") -> DataFrame:
    """Running total in exact decimal arithmetic."""
    fr = _w().rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("cumulative_y",
                         F.sum(F.col(y).cast("decimal(18,2)")).over(fr).cast("double"))


def with_position(df: DataFrame) -> DataFrame:
    """Row index t (1-based) and series length n — for splits and trends."""
    return df.withColumns({"t": F.row_number().over(_w()),
                           "n_months": F.count(F.lit(1)).over(Window.partitionBy("series"))})


def time_split(df: DataFrame, train_frac: float = 0.8) -> DataFrame:
    """First ``int(train_frac * n)`` rows of each series are train."""
    p = with_position(df)
    cut = F.floor(F.col("n_months") * F.lit(train_frac))
    return p.withColumn("split", F.when(F.col("t") <= cut, "train").otherwise("test"))


def trend_summary(df: DataFrame, y: str = "y") -> DataFrame:
    """First, last, total, mean, growth % and trend class."""
    g = df.groupBy("series").agg(
        F.min_by(y, "ds").alias("first_y"), F.max_by(y, "ds").alias("last_y"),
        F.sum(F.col(y).cast("decimal(18,2)")).cast("double").alias("total_y"),
        F.count(F.lit(1)).alias("n_months"))
    return g.withColumns({
        "mean_y": F.col("total_y") / F.col("n_months"),
        "growth_pct": F.try_divide((F.col("last_y") - F.col("first_y")) * 100.0, F.col("first_y")),
        "trend": trend_class(F.col("first_y"), F.col("last_y")),
    })


def fit_trend_season(df: DataFrame, train: Column | None = None, y: str = "y") -> DataFrame:
    """M13a fit: least-squares line on t plus a mean residual per calendar month.

    Slope and intercept come from exact moment sums (bigint / decimal), so
    the fit does not depend on partitioning.  Returns one row per
    (series, month) with ``a``, ``b``, ``effect`` and the series' last t/ds.
    """
    p = with_position(df)
    if train is not None:
        p = p.filter(train)
    yd = F.col(y).cast("decimal(18,2)")
    mom = p.groupBy("series").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("t").alias("st"),
        F.sum(F.col("t") * F.col("t")).alias("stt"),
        F.sum(yd).alias("sy"),
        F.sum(yd * F.col("t")).alias("sty"),
        F.max("t").alias("t_last"), F.max("ds").alias("ds_last"))
    k, st, stt = F.col("k").cast("double"), F.col("st").cast("double"), F.col("stt").cast("double")
    sy, sty = F.col("sy").cast("double"), F.col("sty").cast("double")
    b = F.try_divide(k * sty - st * sy, k * stt - st * st)
    mom = mom.withColumn("b", F.coalesce(b, F.lit(0.0)))
    mom = mom.withColumn("a", (sy - F.col("b") * st) / k)
    res = p.join(mom.select("series", "a", "b"), "series").withColumn(
        "resid", F.col(y) - (F.col("a") + F.col("b") * F.col("t")))
    eff = res.groupBy("series", F.month("ds").alias("month")).agg(
        F.avg("resid").alias("effect"))
    return mom.select("series", "a", "b", "t_last", "ds_last").join(eff, "series")


def forecast(model: DataFrame, periods: int = 12, digits: int = 2) -> DataFrame:
    """M13a predict + P28 band for ``periods`` months after each series' end.

    Month stepping uses ``add_months`` (the reference's +32-day step skips a
    month on long horizons).
    """
    heads = model.select("series", "a", "b", "t_last", "ds_last").distinct()
    steps = heads.select("*", F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("h"))
    steps = steps.withColumns({"ds": F.add_months("ds_last", F.col("h")),
                               "t": F.col("t_last") + F.col("h")})
    steps = steps.withColumn("month", F.month("ds"))
    j = steps.join(model.select("series", "month", "effect"), ["series", "month"], "left")
    val = np_round(F.col("a") + F.col("b") * F.col("t") + F.coalesce(F.col("effect"), F.lit(0.0)), digits)
    lo, hi = forecast_band(F.col("forecast"))
    return (j.select("series", "h", "ds", val.alias("forecast"))
            .withColumns({"lower_bound": lo, "upper_bound": hi}))


def predict_on(model: DataFrame, df: DataFrame, digits: int = 2) -> DataFrame:
    """Apply a trend+season fit to the months of ``df`` (its own t index)."""
    p = with_position(df)
    j = p.join(model.select("series", "a", "b", "month", "effect"), ["series"]).filter(F.month("ds") == F.col("month"))
    return j.withColumn("predicted", np_round(F.col("a") + F.col("b") * F.col("t")
                                              + F.col("effect"), digits))


def regression_errors(df: DataFrame, actual: str = "y", pred: str = "predicted") -> DataFrame:
    """MAPE (rows with actual 0 skipped), RMSE and MAE per series."""
    e = F.col(pred) - F.col(actual)
    return df.groupBy("series").agg(
        F.count(F.lit(1)).alias("n_test"),
        F.avg(F.abs(F.try_divide(e, F.col(actual)))).alias("mape"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"))


def multi_horizon_frame(df: DataFrame, horizons: int = 12) -> DataFrame:
    """M13b training/scoring frame: one row per (series, origin month, h).

    Features are known at the origin (lags, rolling stats, origin calendar)
    plus the horizon and the target month's position on the unit circle;
    the target is y at origin + h months (an equi-join on the gap-filled
    calendar).  Rows whose target lies beyond the data are the forecast rows.
    Size: #series × #months × horizons — built on the monthly aggregate.
    """
    f = rolling_features(lag_features(calendar_features(df)))
    e = f.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizons))).alias("h"))
    e = e.withColumn("target_ds", F.add_months("ds", F.col("h")))
    tgt = df.select("series", F.col("ds").alias("target_ds"), F.col("y").alias("target_y"))
    j = e.join(tgt, ["series", "target_ds"], "left")
    ang = F.lit(2 * math.pi) * F.month("target_ds") / F.lit(12.0)
    return j.withColumns({"target_month_sin": F.sin(ang), "target_month_cos": F.cos(ang)})


MULTI_HORIZON_FEATURES = ["h", "target_month_sin", "target_month_cos", "month_sin", "month_cos",
                          "lag_1", "lag_2", "lag_3", "lag_6", "lag_12", "rolling_mean_3",
                          "rolling_std_3", "rolling_max_3", "rolling_mean_6", "rolling_std_6",
                          "rolling_max_6"]


def direct_forecast(df: DataFrame, horizons: int = 12, rounds: int = 200, seed: int = 42) -> DataFrame:
    """One GBT regressor over all horizons and series; no recursion.

    Trains on every (origin, h) whose target is known and whose features are
    complete, then predicts h = 1..horizons from each series' last month.
    """
    from .models import fit_revenue
    fr = multi_horizon_frame(df, horizons)
    feats = MULTI_HORIZON_FEATURES
    complete = F.lit(True)
    for c in feats:
        complete = complete & F.col(c).isNotNull()
    train = fr.filter(complete & F.col("target_y").isNotNull()).withColumnRenamed("y", "y_origin") \
        .withColumnRenamed("target_y", "y")
    model = fit_revenue(train, feats, rounds=rounds, seed=seed)
    last = df.groupBy("series").agg(F.max("ds").alias("ds"))
    origin = fr.join(last, ["series", "ds"]).filter(complete)
    pred = model.transform(origin.withColumnRenamed("y", "y_origin"))
    lo, hi = forecast_band(F.col("forecast"))
    return pred.select("series", "h", F.col("target_ds").alias("ds"),
                       np_round("predicted", 2).alias("forecast")).withColumns(
        {"lower_bound": lo, "upper_bound": hi})


def complete_months(monthly: DataFrame, last_ts: Column) -> DataFrame:
    """Drop a trailing partial month: the month of ``last_ts`` is kept only
    when ``last_ts`` falls on its last day.  Forecast fits and errors use
    complete months so a one-day month does not read as a revenue collapse."""
    cut = F.trunc(F.to_date(last_ts), "month")
    full = F.to_date(last_ts) == F.last_day(F.to_date(last_ts))
    return monthly.filter((F.col("ds") < cut) | full)
