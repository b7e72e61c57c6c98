"""Exact distributed ranks equal SQL windows, including ties and groups."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from retentio.operators.ranking import ntile_from_rank, prefix_sums, row_number_global


def test_row_number_matches_window(spark):
    df = spark.range(0, 5000).select(F.col("id"), (F.col("id") % 7).alias("v"), (F.col("id") % 3).alias("g"))
    r = row_number_global(df, ["v", "id"], partition_by=["g"], num_partitions=16)
    w = Window.partitionBy("g").orderBy("v", "id")
    ref = df.withColumn("rn_ref", F.row_number().over(w)).withColumn("n_ref", F.count("*").over(Window.partitionBy("g")))
    j = r.join(ref, "id")
    assert j.filter((F.col("rn") != F.col("rn_ref")) | (F.col("n_in_group") != F.col("n_ref"))).count() == 0
    assert r.count() == 5000


def test_hot_value_spreads(spark):
    # a third of the rows share one value: still exact
    df = spark.range(0, 3000).select("id", F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("v"))
    r = row_number_global(df, ["v", "id"], num_partitions=8)
    ref = df.withColumn("rn_ref", F.row_number().over(Window.orderBy("v", "id")))
    assert r.join(ref, "id").filter(F.col("rn") != F.col("rn_ref")).count() == 0


def test_weighted_prefix_sums(spark):
    df = spark.createDataFrame([(1.0, 2), (2.0, 0), (3.0, 5), (4.0, 1)], "s double, w int")
    r = prefix_sums(df, ["s"], {"w": F.col("w")}).orderBy("s").collect()
    assert [x.cum_w for x in r] == [2, 2, 7, 8]
    assert {x._group_total_w for x in r} == {8}


def test_ntile_formula(spark):
    for n in (1, 7, 10, 23, 100):
        df = spark.range(1, n + 1).withColumn("n", F.lit(n))
        a = df.select(ntile_from_rank(F.col("id"), F.col("n"), 10).alias("t"),
                      F.ntile(10).over(Window.orderBy("id")).alias("ref"))
        assert a.filter(F.col("t") != F.col("ref")).count() == 0


def test_neighbours_match_lag_lead_with_hot_key(spark):
    from retentio.operators.ranking import neighbours
    df = spark.range(0, 4000).select(
        F.col("id"), F.when(F.col("id") < 1500, 0).otherwise(F.col("id") % 50).alias("k"),
        ((F.col("id") * 7919) % 1000).alias("t"))
    r = neighbours(df, ["t", "id"], ["id", "t"], partition_by=["k"], num_partitions=12)
    w = Window.partitionBy("k").orderBy("t", "id")
    ref = df.select("id", F.lag("id").over(w).alias("p"), F.lead("t").over(w).alias("nt"))
    j = r.join(ref, "id")
    bad = j.filter(~F.col("prev_id").eqNullSafe(F.col("p")) | ~F.col("next_t").eqNullSafe(F.col("nt")))
    assert bad.count() == 0 and r.count() == 4000


def test_multi_batch_partitions(spark):
    """Force small Arrow batches so carries across batches are exercised."""
    from retentio.operators.ranking import neighbours
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        df = spark.range(0, 3000).select("id", (F.col("id") % 3).alias("k"), ((F.col("id") * 31) % 500).alias("t"))
        r = neighbours(df, ["t", "id"], ["id"], partition_by=["k"], num_partitions=4)
        w = Window.partitionBy("k").orderBy("t", "id")
        ref = df.select("id", F.lag("id").over(w).alias("p"), F.lead("id").over(w).alias("n"))
        j = r.join(ref, "id")
        assert j.filter(~F.col("prev_id").eqNullSafe(F.col("p")) | ~F.col("next_id").eqNullSafe(F.col("n"))).count() == 0
        rn = row_number_global(df, ["t", "id"], partition_by=["k"], num_partitions=4)
        ref2 = df.withColumn("rr", F.row_number().over(w))
        assert rn.join(ref2, "id").filter(F.col("rn") != F.col("rr")).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_forward_fill_matches_window(spark):
    from retentio.operators.ranking import forward_fill
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "53")
    try:
        df = spark.range(0, 3000).select(
            "id", F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 7).alias("k"),
            F.when(F.col("id") % 11 == 0, F.col("id")).alias("v"))
        r = forward_fill(df, ["id"], ["v"], partition_by=["k"], num_partitions=9)
        w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
        ref = df.select("id", F.last("v", ignorenulls=True).over(w).alias("ref"))
        j = r.join(ref, "id")
        assert j.filter(~F.col("v").eqNullSafe(F.col("ref"))).count() == 0 and r.count() == 3000
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_neighbours_row_number_multi_batch(spark):
    from retentio.operators.ranking import neighbours
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "61")
    try:
        df = spark.range(0, 3000).select(
            "id", F.when(F.col("id") < 1200, 0).otherwise(F.col("id") % 9).alias("k"),
            ((F.col("id") * 37) % 700).alias("t"))
        r = neighbours(df, ["t", "id"], ["id"], partition_by=["k"], num_partitions=10, number="rn")
        w = Window.partitionBy("k").orderBy("t", "id")
        ref = df.select("id", F.row_number().over(w).alias("rr"), F.lead("id").over(w).alias("n"))
        j = r.join(ref, "id")
        assert j.filter((F.col("rn") != F.col("rr")) | ~F.col("next_id").eqNullSafe(F.col("n"))).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_null_group_large_ids_and_far_dates(spark):
    """Payload stays exact; a null group is a group; far dates are values."""
    import datetime
    from retentio.operators.history import as_of_lookup, scd2
    from retentio.operators.ranking import forward_fill, neighbours, prefix_sums
    far = datetime.datetime(9999, 12, 31)
    rows = [(None, 1, 2 ** 53 + 1), (None, 2, None), (None, 3, 2 ** 53 + 3), ("a", 1, None), ("a", 2, 5)]
    df = spark.createDataFrame(rows, "g string, t int, v long")
    n = {(r.g, r.t): (r.prev_v, r.next_v, r.rn) for r in neighbours(df, ["t"], ["v"], ["g"], 3, number="rn").collect()}
    assert n[None, 2] == (2 ** 53 + 1, 2 ** 53 + 3, 2) and n[None, 1] == (None, None, 1) and n["a", 2] == (None, None, 2)
    f = {(r.g, r.t): r.v for r in forward_fill(df, ["t"], ["v"], ["g"], 3).collect()}
    assert f[None, 2] == 2 ** 53 + 1 and f["a", 1] is None
    assert prefix_sums(df, ["t"], partition_by=["g"], num_partitions=3).count() == 5
    changes = spark.createDataFrame([("k", datetime.datetime(2020, 1, 1), None, "x"), ("k", datetime.datetime(2020, 2, 1), "x", None),
                                     ("k", far, "x", None), (None, far, "y", "z")], "k string, ts timestamp_ntz, p string, q string")
    h = scd2(changes, "k", "ts", ["p", "q"])
    assert sorted((str(r.k), r.version, str(r.valid_from.year)) for r in h.collect()) == [("None", 1, "9999"), ("k", 1, "2020"), ("k", 2, "2020")]
    pts = spark.createDataFrame([("k", datetime.datetime(2020, 3, 1), 2 ** 53 + 1), (None, far, 7), ("z", far, 8)], "k string, at timestamp_ntz, id long")
    got = {r.id: (r.p, r.version) for r in as_of_lookup(h, pts, "k", "at").collect()}
    assert got == {2 ** 53 + 1: ("x", 2), 7: ("y", 1), 8: (None, None)}


def test_plans_have_no_python(spark):
    from retentio.operators.ranking import neighbours
    df = spark.range(100).selectExpr("id", "id % 3 as g")
    plan = neighbours(df, ["id"], ["id"], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan and "InArrow" not in plan
