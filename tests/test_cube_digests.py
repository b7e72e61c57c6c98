"""Daily cube, partition digests, staging and request domains."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from retentio.functions import rules as R
from retentio.operators import cube as CU
from retentio.operators import engagement as EG
from retentio.operators.quality import fingerprint
from retentio.sources import digests as DG

from .conftest import SF001


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF001}/orders.parquet")


RANGES = [("all", None, None), ("year", dt.date(1996, 1, 1), dt.date(1996, 12, 31)), ("day", dt.date(1997, 5, 5), dt.date(1997, 5, 5)),
          ("never", dt.date(2050, 1, 1), None)]


def scanned(df, key="o_custkey", ts="o_orderdate", amount="o_totalprice"):
    out = {}
    for name, a, b in RANGES:
        day = F.to_date(ts)
        r = df.where((day >= F.lit(a or dt.date(1900, 1, 1))) & (day <= F.lit(b or dt.date(2200, 1, 1)))).agg(
            F.count("*"), F.countDistinct(key), F.coalesce(F.sum(F.col(amount).cast("decimal(18,2)")).cast("double"), F.lit(0.0))).first()
        out[name] = tuple(r)
    return out


def totals(cube):
    return {r.date_range: (r.n, r.n_keys, r.amount) for r in CU.range_totals(cube, RANGES).collect()}


def test_ranges_from_the_cube_equal_the_scan(orders):
    assert totals(CU.daily_cube(orders, "o_custkey", "o_orderdate", "o_totalprice")) == scanned(orders)


def test_cube_takes_late_rows(spark, orders, tmp_path):
    """Two batches that share days, the second stored on top, and a third with rows of known days."""
    path = str(tmp_path / "cube")
    parts = [orders.where(F.col("o_orderkey") % 3 == k) for k in range(3)]
    CU.save_cube(CU.daily_cube(parts[0], "o_custkey", "o_orderdate", "o_totalprice"), path)
    for p in parts[1:]:
        CU.add_rows(spark, path, p, "o_custkey", "o_orderdate", "o_totalprice")
    assert totals(CU.load_cube(spark, path)) == scanned(orders)
    whole = CU.merge(*[CU.daily_cube(p, "o_custkey", "o_orderdate", "o_totalprice") for p in parts])
    assert totals(whole) == scanned(orders)


def test_cube_edges(spark):
    """Null keys count but are nobody's, null days are in no range, large numbers open blocks of their own."""
    d = dt.datetime(1996, 3, 1)
    rows = [(None, d, 1.5), (0, d, 2.0), (40_000, d, 3.0), (40_000, d, None), (7, None, 9.0), (10 ** 12, d, 1.0)]
    df = spark.createDataFrame(rows, "o_custkey long, o_orderdate timestamp, o_totalprice double")
    got = totals(CU.daily_cube(df, "o_custkey", "o_orderdate", "o_totalprice"))
    assert got["year"] == got["all"] == (5, 3, 7.5) and got["never"] == (0, 0, 0.0)
    assert set(totals(CU.daily_cube(df.limit(0), "o_custkey", "o_orderdate", "o_totalprice")).values()) == {(0, 0, 0.0)}


def test_fingerprint_tells_shifted_bars_apart(spark):
    one = lambda *rows: tuple(fingerprint(spark.createDataFrame(list(rows), "a string, b string")).first())
    assert one(("a|vb", "c")) != one(("a", "b|vc"))
    assert one(("1:x", None)) != one(("x", "n")) and one(("", None)) != one((None, ""))
    assert one(("a", "b"), ("c", "d")) == one(("c", "d"), ("a", "b"))


def test_digest_tree_adds_up(spark, orders):
    leaves = DG.digest_by(orders, {"y": F.year("o_orderdate"), "m": F.month("o_orderdate")})
    tree = {(r.level, r.unit): (r.n_rows, r.xor_hash, r.mod_sum_hash) for r in DG.digest_tree(leaves, ["y", "m"]).collect()}
    assert tree[0, ""] == tuple(fingerprint(orders).first())
    assert sum(n for (level, _), (n, _, _) in tree.items() if level == 2) == orders.count()


def test_only_changed_files_are_read(spark, tmp_path):
    """One changed file is named; files that look as before are not opened, even if they are damaged."""
    path, store = str(tmp_path / "table"), str(tmp_path / "digests")
    df = spark.range(300).select("id", (F.col("id") % 3).alias("part"), F.lit("x").alias("v"))
    df.repartition(1).write.partitionBy("part").parquet(path)
    first = DG.refresh(spark, path, store, "run1").collect()
    assert len(first) == 3 and {r.part for r in first} == {"part=0", "part=1", "part=2"} and sum(r.n_rows for r in first) == 300
    at = {r.part: r.file.replace("file:", "").replace("//", "/") for r in first}
    damaged, kept = at["part=0"], os.stat(at["part=0"])
    with open(damaged, "r+b") as f:
        f.write(b"\0" * 64)
    os.utime(damaged, ns=(kept.st_atime_ns, kept.st_mtime_ns))
    os.remove(at["part=2"])
    df.where("part = 2").withColumn("v", F.when(F.col("id") == 2, "y").otherwise(F.col("v"))).drop("part").repartition(1).write.mode("append").parquet(f"{path}/part=2")
    DG.refresh(spark, path, store, "run2", previous="run1")
    runs = DG.read_runs(spark, store)
    assert {tuple(r) for r in DG.changes(runs, "run1", "run2", "part").collect()} == {("part=2", "changed")}
    assert {r.change for r in DG.changes(runs, "run1", "run2").collect()} == {"added", "removed"}


def test_staged_tickets_edges(spark):
    rows = [(1, 5, dt.datetime(2024, 2, 3, 4), " Negative ", False), (2, None, None, "positive", None), (3, 5, dt.datetime(2024, 2, 3), "odd", True),
            (4, 5, dt.datetime(2024, 2, 3), None, True)]
    t = spark.createDataFrame(rows, "id int, who int, at timestamp, mood string, done boolean")
    got = [(r.ticket_id, r.sentiment, r.sentiment_code, r.is_negative, r.is_resolved, r.needs_action)
           for r in EG.staged_tickets(t, "id", "who", "at", F.col("mood"), F.col("done")).orderBy("ticket_id").collect()]
    assert got == [(1, "negative", -1, 1, 0, 1), (2, "positive", 1, 0, 0, 0), (3, "odd", None, 0, 1, 0), (4, None, None, 0, 1, 0)]


def test_service_request_domains(spark):
    rows = [("executive", "last_7_days", 6, "monthly"), ("weekly", None, 0, "daily"), (None, "last_year", 25, None)]
    df = spark.createDataFrame(rows, "report_type string, date_range string, periods int, granularity string")
    df = R.with_request_defaults(R.with_request_defaults(df, R.SUMMARY_DEFAULTS), R.REVENUE_DEFAULTS)
    got = [r.v for r in df.select(R.violations({**R.summary_rules(), **R.revenue_rules()}).alias("v")).collect()]
    assert got == [[], ["report_type_domain", "periods_range", "granularity_domain"], ["date_range_domain", "periods_range"]]
