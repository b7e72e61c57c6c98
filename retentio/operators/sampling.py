"""Deterministic samples and splits.

The hash is portable (multiplicative, mod 2^32) so the same rows are chosen
by Spark and by a SQL engine.  It is computed in 16-bit limbs, so no
intermediate exceeds 2^49 and any 64-bit id works under ANSI overflow checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import row_number_global

KNUTH = 2654435761
MOD32 = 4294967296


def portable_hash(key, seed: int = 0) -> Column:
    """(key · 2654435761 + seed) mod 2^32 — identical in any SQL engine.

    With k = key mod 2^32 = a + b·2^16 (a, b < 2^16):
    k·M mod 2^32 = (a·M + ((b·M) mod 2^16)·2^16) mod 2^32.
    """
    k = F.pmod((F.col(key) if isinstance(key, str) else key).cast("long"), F.lit(MOD32))
    a = F.pmod(k, F.lit(65536))
    b = F.floor(k / F.lit(65536)).cast("long")
    m = F.lit(KNUTH)
    return F.pmod(a * m + F.pmod(b * m, F.lit(65536)) * F.lit(65536) + F.lit(seed), F.lit(MOD32))


def exact_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, count)`` rows, the smallest seeded hashes.

    ``orderBy(hash, key).limit(n)`` is a TakeOrderedAndProject: each task
    keeps a heap of n rows, so memory is bounded by n, not by the table.
    """
    return df.withColumn("_h", portable_hash(key, seed)).orderBy("_h", key).limit(n).drop("_h")


def hash_split(df: DataFrame, key: str, train_frac: float = 0.8, seed: int = 42) -> DataFrame:
    """Shuffle-free approximate split: hash below ``train_frac · 2^32`` is train."""
    return df.withColumn("split", F.when(portable_hash(key, seed) < F.lit(int(train_frac * MOD32)),
                                         "train").otherwise("test"))


def stratified_split(df: DataFrame, key: str, label: str, train_frac: float = 0.8,
                     seed: int = 42) -> DataFrame:
    """Exact per-label split — the first ``floor(train_frac · n_label)``
    rows by (hash, key) of each label are train.

    Ranks come from ``row_number_global`` (range partitioned on label, hash,
    key), so a label holding most rows is still spread over many tasks.
    """
    h = df.withColumn("_h", portable_hash(key, seed))
    r = row_number_global(h, ["_h", key], partition_by=[label])
    cut = F.floor(F.col("n_in_group") * F.lit(train_frac))
    return r.withColumn("split", F.when(F.col("rn") <= cut, "train").otherwise("test")) \
        .drop("_h", "rn", "n_in_group")
