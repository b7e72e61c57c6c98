"""Parquet table access (S3) for a directory of one-file-per-table parquet."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")

# timestamp columns stored without zone; Spark reads them as timestamp_ntz
NTZ_COLUMNS = {"orders": ("o_orderdate",), "lineitem": ("l_shipdate",),
               "events": ("ts",)}


def table_path(sf_dir: str, name: str) -> str:
    p = os.path.join(sf_dir, f"{name}.parquet")
    return p


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(sf_dir, name))


def with_event_time(df: DataFrame, cols) -> DataFrame:
    """Cast ``timestamp_ntz`` columns to session-zone ``timestamp``.

    Watermarks and ``window`` on streams require ``timestamp``; the session
    zone is UTC so wall-clock values are unchanged.
    """
    return df.withColumns({c: F.col(c).cast("timestamp") for c in cols})
