"""Bronze ingestion: CSV scan, name normalisation, coercion, lineage, sinks.

S1 CSV scan · S2 name normalisation · S4/S5 sinks · S6 lineage ·
S7 bronze clean · S11 load (a missing source raises).
"""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import to_number

# Raw telco CSV columns, in file order (fixed values of the public dataset).
TELCO_COLUMNS = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
    "MonthlyCharges", "TotalCharges", "Churn",
]
_NUMERIC = {"SeniorCitizen": T.IntegerType(), "tenure": T.IntegerType(),
            "MonthlyCharges": T.DoubleType()}

TELCO_CSV_SCHEMA = T.StructType([
    T.StructField(c, _NUMERIC.get(c, T.StringType()), True) for c in TELCO_COLUMNS])


def read_csv(spark: SparkSession, path: str, schema: T.StructType = TELCO_CSV_SCHEMA,
             header: bool = True) -> DataFrame:
    """CSV scan with an explicit schema (no inference pass over the data).

    ``TotalCharges`` stays a string here: the raw file has blanks that the
    clean step coerces.  Malformed numeric fields become null (PERMISSIVE).
    With a header, columns whose names differ from the schema's raise.
    """
    return (spark.read.schema(schema).option("header", header).option("enforceSchema", not header)
            .option("mode", "PERMISSIVE").csv(path))


def normalise_name(name: str) -> str:
    """Lower case, spaces and hyphens to underscores."""
    return re.sub(r"[ \-]", "_", name.strip().lower())


def normalise_columns(df: DataFrame) -> DataFrame:
    """S2 on every column; two columns mapping to one name is an error."""
    names = [normalise_name(c) for c in df.columns]
    dup = {n for n in names if names.count(n) > 1}
    if dup:
        raise ValueError(f"column names collide after normalisation: {sorted(dup)}")
    return df.toDF(*names)


def lineage_columns(source: str, batch_id: str | None = None,
                    ingested_at: datetime | None = None) -> dict:
    """One constant timestamp, source and batch id for a whole load."""
    ts = ingested_at or datetime.now(timezone.utc).replace(tzinfo=None)
    bid = batch_id or uuid.uuid4().hex[:12]
    # built from text so the value does not depend on the session time zone
    return {"_ingested_at": F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz"),
            "_source": F.lit(source),
            "_batch_id": F.lit(bid)}


def add_lineage(df: DataFrame, source: str, batch_id: str | None = None,
                ingested_at: datetime | None = None) -> DataFrame:
    return df.withColumns(lineage_columns(source, batch_id, ingested_at))


def clean_telco(df: DataFrame, source: str = "telco_csv",
                batch_id: str | None = None,
                ingested_at: datetime | None = None) -> DataFrame:
    """Normalise names, coerce ``totalcharges`` (blank/junk → 0), lineage.

    One ``select`` so Catalyst fuses it into the scan's codegen stage.
    """
    d = normalise_columns(df)
    cols = [to_number("totalcharges").alias("totalcharges") if c == "totalcharges"
            else F.col(c) for c in d.columns]
    lin = lineage_columns(source, batch_id, ingested_at)
    return d.select(*cols, *[v.alias(k) for k, v in lin.items()])


def write_parquet(df: DataFrame, path: str, partition_by=None,
                  mode: str = "overwrite") -> None:
    """Parquet sink; with partitions only the touched ones are replaced."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with a header line."""
    df.write.mode(mode).option("header", True).csv(path)


def load_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Parquet load; a missing path raises (no silent synthetic data)."""
    return normalise_columns(spark.read.parquet(path))
