"""retentio — customer-retention and revenue analytics on Spark DataFrames.

Every operator is a function of DataFrames or a ``Column`` builder; nothing
here collects data-sized frames to the driver.  Sub-packages:

* ``sources``   — table loading, bronze ingest with lineage, sinks, run log
* ``functions`` — ``Column`` builders (flags, coercion, rounding, risk rules)
* ``operators`` — ``DataFrame -> DataFrame`` operators (features, KPIs, time
  series, drift, quality, ranking metrics, models, anomaly scores, SCD2)
* ``plans``     — the query catalogue run on the test tables, with DuckDB twins
* ``streaming`` — Structured Streaming ingest, scoring and activity rollups

Typical use::

    from retentio.session import get_session
    from retentio.sources.bronze import read_csv, clean_telco, write_parquet
    from retentio.operators.features import churn_features
    from retentio.functions import rules as R

    spark = get_session()
    bronze = clean_telco(read_csv(spark, "/data/raw/telco/"))
    write_parquet(bronze, "/data/bronze/telco", partition_by="contract")
    feats = churn_features(bronze)
    scored = feats.withColumn("risk_tier", R.risk_tier("churn_prob"))  # with a model's prob
"""

__version__ = "0.1.0"
