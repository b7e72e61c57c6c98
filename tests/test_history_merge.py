"""Incremental history, stored profiles and features at cutoffs."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from retentio.operators import cutoffs as CF
from retentio.operators import drift as DR
from retentio.operators import history as H
from retentio.operators import profile as PF

from .conftest import SF001


def changes(n=400, keys=12, seed=1):
    rng = random.Random(seed)
    return [(None if k == 0 else k, dt.datetime(2020, 1, 1) + dt.timedelta(days=rng.randrange(300)), rng.choice(["a", "b", None]), i)
            for i in range(n) for k in [rng.choice([0, 1, 1, 1, *range(2, keys)])]]


SCHEMA = "k long, ts timestamp, v string, i int"


def rows_of(df):
    return sorted(((r.k, r.v, r.valid_from, r.valid_to, r.version, r.is_current) for r in df.collect()), key=repr)


def test_batches_give_the_rebuilt_history(spark, tmp_path):
    """Late changes, a null key, a hot key, an empty batch and a batch that runs twice."""
    every = changes()
    whole = rows_of(H.scd2(spark.createDataFrame(every, SCHEMA), "k", "ts", ["v"], "i"))
    path = str(tmp_path / "hist")
    batches = {f"b{j}": every[j::4] for j in range(4)} | {"none": []}
    for name in ["b0", "b1", "b1", "none", "b2", "b3", "b0"]:
        out = H.merge_history(spark, path, name, spark.createDataFrame(batches[name], SCHEMA), "k", "ts", ["v"], "i", buckets=5)
    assert rows_of(out) == whole


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    import os
    path = str(tmp_path / "hist")
    files = lambda: {os.path.join(d, f) for d, _, fs in os.walk(f"{path}/history") for f in fs if f.endswith(".parquet") and "bucket=" in d}
    H.merge_history(spark, path, "b0", spark.createDataFrame(changes(), SCHEMA), "k", "ts", ["v"], "i", buckets=8)
    before = files()
    late = spark.createDataFrame([(3, dt.datetime(2019, 5, 1), "z", 9999)], SCHEMA)
    H.merge_history(spark, path, "b1", late, "k", "ts", ["v"], "i", buckets=8)
    gone = {f.split("bucket=")[1].split("/")[0] for f in before - files()}
    assert len(gone) == 1


def test_profiles_agree_with_the_exact_measures(spark):
    """Up to K rows a day's sketch is exact; days merge to any period; missing values are counted."""
    rng = np.random.default_rng(4)
    rows = [(dt.date(2024, 1, 1 + int(d)), float(x), None if i % 50 == 0 else float("nan") if i % 51 == 0 else float(x) ** 2)
            for i, (d, x) in enumerate(zip(rng.integers(0, 20, 4000), rng.normal(5, 2, 4000)))]
    df = spark.createDataFrame(rows, "day date, a double, b double")
    p = PF.daily_profile(df, F.col("day"), ["a", "b"])
    assert p.count() == 40 and {r.n for r in p.groupBy("feature").agg(F.sum(F.col("n") + F.col("missing")).alias("n")).collect()} == {4000}
    base, cur = df.where("day < '2024-01-15'"), df.where("day >= '2024-01-15'").withColumn("a", F.col("a") + 1.5)
    drift = {r.feature: r for r in PF.drift(PF.merged(p.where("day < '2024-01-15'")), PF.merged(PF.daily_profile(cur, F.col("day"), ["a", "b"]))).collect()}
    for f in ("a", "b"):
        exact = DR.psi(base, cur, [f]).first()
        assert abs(drift[f].psi - exact.psi) < 0.02 * max(1, exact.psi) and drift[f].status == exact.status
        assert abs(drift[f].ks - DR.ks_statistic(base, cur, f).first().ks_statistic) <= 1 / PF.GRID + 1e-9
        assert abs(drift[f].missing_base - exact.missing_base) < 1e-12


def test_profile_without_values(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), None), (dt.date(2024, 1, 2), float("nan"))], "day date, a double")
    none = PF.merged(PF.daily_profile(df, F.col("day"), ["a"]))
    some = PF.merged(PF.daily_profile(df.fillna(1.0), F.col("day"), ["a"]))
    r = PF.drift(none, some).first()
    assert (r.psi, r.ks, r.missing_base, r.status) == (None, None, 1.0, "NO DATA")
    assert PF.drift(none.limit(0), none.limit(0)).collect() == []


@pytest.mark.parametrize("k", [400, 2000])
def test_sketches_stay_within_the_stated_rank_error(spark, k):
    n = 60_000
    df = spark.range(n).select(F.lit(dt.date(2024, 1, 1)).alias("day"), ((F.col("id") * 7919) % n).cast("double").alias("x"))
    s = PF.merged(PF.daily_profile(df, F.col("day"), ["x"], k=k))
    got = s.select(F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(i / 10) for i in range(1, 10)])).alias("q")).first().q
    assert max(abs(q / n - (i + 1) / 10) for i, q in enumerate(got)) <= 1.5 * PF.rank_error(k)


def test_no_feature_sees_its_future(spark):
    """Features stay the same when all facts on or after the cutoff are taken away; the label alone changes."""
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    cut = dt.date(1998, 6, 1)
    seen = ["n_before", "spend_before", "n_trailing", "spend_trailing", "recency_days"]
    args = ("o_custkey", "o_orderdate", "o_totalprice", [F.lit(cut)])
    full = {r.o_custkey: r for r in CF.cutoff_features(o, *args).collect()}
    past = {r.o_custkey: r for r in CF.cutoff_features(o.where(F.to_date("o_orderdate") < F.lit(cut)), *args).collect()}
    assert full.keys() == past.keys() and len(full) > 50
    assert all(full[k][c] == past[k][c] for k in full for c in seen)
    assert {r.label for r in past.values()} == {1} and {r.label for r in full.values()} == {0, 1}


def test_cutoff_borders(spark):
    """A fact on the cutoff's day is in the label's window, not in the features; nulls are left out."""
    d = dt.datetime
    rows = [(1, d(2020, 1, 1), 2.0), (1, d(2020, 1, 1, 9), 3.0), (1, d(2021, 1, 1), 5.0), (2, d(2021, 1, 1), 7.0), (None, d(2020, 1, 1), 1.0),
            (3, None, 1.0), (4, d(2019, 12, 31), 1.0), (5, d(2020, 12, 31), None)]
    df = spark.createDataFrame(rows, "k int, ts timestamp, x double")
    got = {r.k: tuple(r)[2:] for r in CF.cutoff_features(df, "k", "ts", "x", [F.lit(dt.date(2021, 1, 1))]).collect()}
    assert got == {1: (2, 5.0, 2, 5.0, 366, 0), 4: (1, 1.0, 0, 0.0, 367, 1), 5: (1, None, 1, None, 1, 1)}
    assert CF.cutoff_features(df.limit(0), "k", "ts", "x", [F.lit(dt.date(2021, 1, 1))]).collect() == []
