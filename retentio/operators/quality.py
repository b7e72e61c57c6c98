"""Data-quality gates (Q1, Q2, A13) and the dataset fingerprint.

Checks run as one aggregate pass per table and are unpivoted to rows of
(check, ok, failing_rows) so a caller can both report and raise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_table(df: DataFrame, checks: dict, min_rows: int | None = None,
                table: str | None = None) -> DataFrame:
    """``{name: row_predicate}`` → rows (table, check, ok, failing_rows).

    A null predicate result counts as failing.  ``min_rows`` adds the
    row-count check.  One scan, one aggregate.
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    for name, pred in checks.items():
        aggs.append(F.count_if(~F.coalesce(pred, F.lit(False))).alias(name))
    one = df.agg(*aggs)
    items = []
    if min_rows is not None:
        items.append(F.struct(F.lit("row_count").alias("check"),
                              (F.col("_n") >= min_rows).alias("ok"),
                              F.when(F.col("_n") >= min_rows, 0).otherwise(F.col("_n")).cast("long")
                              .alias("failing_rows")))
    for name in checks:
        items.append(F.struct(F.lit(name).alias("check"), (F.col(name) == 0).alias("ok"),
                              F.col(name).cast("long").alias("failing_rows")))
    out = one.select(F.explode(F.array(*items)).alias("r")).select("r.*")
    return out.withColumn("table_name", F.lit(table)) if table else out


def not_null(c: str) -> Column:
    return F.col(c).isNotNull()


def in_domain(c: str, values) -> Column:
    return F.col(c).isin(list(values))


def non_negative(c: str) -> Column:
    """Charge ≥ 0; unparseable text fails (the reference let it pass as 0)."""
    v = F.col(c).try_cast("double")
    return v >= 0


def row_counts(tables: dict, minimums: dict) -> DataFrame:
    """Q1: ``{name: DataFrame}`` → (table_name, n_rows, min_rows, ok).

    ``count()`` on parquet is answered from footers (no column is read).
    """
    rows = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows",
        F.lit(int(minimums[name])).cast("long").alias("min_rows"))
        for name, df in tables.items()]
    u = reduce(DataFrame.unionByName, rows)
    return u.withColumn("ok", F.col("n_rows") >= F.col("min_rows"))


def require(report: DataFrame, name: str = "check") -> DataFrame:
    """Q1/Q2 gate: raises with the names of the failed checks, else the report.

    A report has one row per check, so its failures fit the driver.
    """
    failed = [":".join(str(r[c]) for c in ("table_name", name) if c in report.columns)
              for r in report.where(~F.coalesce("ok", F.lit(False))).collect()]
    if failed:
        raise ValueError("quality checks failed: " + ", ".join(sorted(failed)))
    return report


def row_digest(cols) -> Column:
    """60 bits of the MD5 of a row's values as text.

    Every value stands with its length and nulls are marked, so different rows have different
    texts, and any engine can compute them.
    """
    part = lambda c: F.when(F.col(c).isNull(), "n").otherwise(
        F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")))
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[part(c) for c in cols]).cast("binary")), 1, 15), 16, 10).cast("long")


def fingerprint(df: DataFrame, cols=None) -> DataFrame:
    """Order-free content hash: count, xor and sum of row digests.

    Equal multisets of rows give equal fingerprints whatever the file
    layout or partitioning; a partial aggregate per task, one tiny merge.
    """
    h = row_digest(cols or df.columns)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.bit_xor(h).alias("xor_hash"),
                  F.sum(F.pmod(h, F.lit(1000003))).alias("mod_sum_hash"))
