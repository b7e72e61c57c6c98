"""Partition digests (S13): which files of a table changed, without reading the rest.

Leaves are files: rows, xor and sum of row digests, with the size and time the store lists.
Leaves add up to partitions and these to the table, so two runs are compared
from the top down.  A refresh lists the files, keeps the leaves of those whose size
and time are as before, and reads the others only.  Runs are rows of one
append-only table, linked with the run log (S10) by ``run_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import row_digest
from ..session import ensure_checkpoint_dir

LEAF = "run_id string, file string, part string, size bigint, modified timestamp, n_rows bigint, xor_hash bigint, mod_sum_hash bigint"
_SUMS = ("n_rows", "xor_hash", "mod_sum_hash")


def digest_columns(h) -> list:
    """The three order-free sums of a digest column."""
    return [F.count(h).alias("n_rows"), F.bit_xor(h).alias("xor_hash"), F.sum(F.pmod(h, F.lit(1000003))).alias("mod_sum_hash")]


def roll_up(leaves: DataFrame, by) -> DataFrame:
    """Digests of coarser units from finer ones: no row is read again."""
    return leaves.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), F.bit_xor("xor_hash").alias("xor_hash"), F.sum("mod_sum_hash").alias("mod_sum_hash"))


def digest_by(df: DataFrame, by: dict, cols=None) -> DataFrame:
    """Digests of the groups of ``by`` ({name: Column}); one pass."""
    held = df.select(*[c.alias(n) for n, c in by.items()], row_digest(cols or df.columns).alias("_h"))
    return held.groupBy(*by).agg(*digest_columns(F.col("_h")))


def digest_tree(leaves: DataFrame, levels: list[str]) -> DataFrame:
    """(level, unit, sums) from the finest of ``levels`` up to the whole table; units are
    the levels' values joined by a slash."""
    out = None
    for k in range(len(levels), -1, -1):
        by = levels[:k]
        one = roll_up(leaves, by) if by else leaves.agg(F.sum("n_rows").alias("n_rows"), F.bit_xor("xor_hash").alias("xor_hash"),
                                                        F.sum("mod_sum_hash").alias("mod_sum_hash"))
        unit = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in by]) if by else F.lit("")
        one = one.select(F.lit(k).alias("level"), unit.alias("unit"), *_SUMS)
        out = one if out is None else out.unionByName(one)
    return out


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """(file, part, size, modified) of the table's files, from the store's listing alone."""
    root = path.rstrip("/")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
             .load(root).select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")))
    inside = F.substring_index("file", root.split("://")[-1].rstrip("/") + "/", -1)
    return files.withColumn("part", F.regexp_replace(inside, r"/?[^/]*$", "")).select("file", "part", "size", "modified")


def _leaves(spark: SparkSession, path: str, files: list[str], schema=None) -> DataFrame:
    """Digests of the rows of some files of the table."""
    reader = spark.read.option("basePath", path)
    df = (reader.schema(schema) if schema is not None else reader).parquet(*files)
    cols = df.columns
    held = df.select(F.col("_metadata.file_path").alias("file"), row_digest(cols).alias("_h"))
    return held.groupBy("file").agg(*digest_columns(F.col("_h")))


def read_runs(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.schema(LEAF).parquet(store)


def refresh(spark: SparkSession, path: str, store: str, run_id: str, previous: str | None = None, schema=None) -> DataFrame:
    """Digest the table's files as run ``run_id``; files that run ``previous`` saw with the same size and
    time are not read.  Returns the run's leaves.

    The list of files to read goes through the driver, as Spark's own file listing does.
    """
    ensure_checkpoint_dir(spark)
    listing = _listing(spark, path).checkpoint()
    spark.createDataFrame([], LEAF).write.mode("append").parquet(store)
    old = read_runs(spark, store).where(F.col("run_id") == (previous or "")).drop("run_id", "part")
    known = listing.join(old, ["file", "size", "modified"])
    unread = listing.join(known.select("file"), "file", "left_anti").checkpoint()
    out = known.select("file", "part", "size", "modified", *_SUMS)
    new = [r.file for r in unread.select("file").collect()]
    if new:
        zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _SUMS]  # files without rows
        fresh = unread.join(_leaves(spark, path, new, schema), "file", "left")
        out = out.unionByName(fresh.select("file", "part", "size", "modified", *zero))
    out.withColumn("run_id", F.lit(run_id)).select(*[c.split()[0] for c in LEAF.split(", ")]).write.mode("append").parquet(store)
    return read_runs(spark, store).where(F.col("run_id") == run_id)


def changes(runs: DataFrame, before: str, after: str, unit: str = "file") -> DataFrame:
    """(unit, change) between two runs: added, removed or changed files (or ``part``s)."""
    side = lambda run: roll_up(runs.where(F.col("run_id") == run), [unit])
    a, b = side(before).toDF(unit, "n0", "x0", "s0"), side(after).toDF(unit, "n1", "x1", "s1")
    j = a.join(b, unit, "full")
    change = (F.when(F.col("n0").isNull(), "added").when(F.col("n1").isNull(), "removed")
              .when(F.struct("n0", "x0", "s0") != F.struct("n1", "x1", "s1"), "changed"))
    return j.select(unit, change.alias("change")).where("change is not null")
