"""Small helpers of the subpackage's Spark code."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path


#: With this setting Spark deletes a frame's shuffle files when its job has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of a batch that goes to a Python worker; the JVM and the worker hold a few of them each.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Frames run in here leave no shuffle files behind and send Python workers small batches:
    for frames that are run once."""
    settings = {CLEANUP: "true", BATCH: str(BATCH_BYTES)}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cut(df: DataFrame) -> DataFrame:
    """Write the frame to the shared checkpoint folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_deleted(df.sparkSession):
        return df.select("*").checkpoint()


#: Bytes of a row group of stored tables.
ROW_GROUP = 8 << 20


def stored(df: DataFrame) -> DataFrame:
    """Write the frame as a Parquet table in the shared checkpoint folder and go on from
    there: for wide frames of which later steps read a few columns each.

    Row groups are small, so that a writing task holds little of its rows at a time.
    """
    path = scratch_path(df.sparkSession, f"tables/{uuid.uuid4().hex}")
    with shuffles_deleted(df.sparkSession):
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learnt from: crc32 of the id mod 4 is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


#: Address bits of the filter of ids: 2 ** 26 bits are 8 MB, whatever the data.
FILTER_BITS = 26


def text_key(id_col: str, text_col: str):
    """What tells texts apart where ids repeat or are null: a 64-bit hash of id and text."""
    return F.xxhash64(F.col(id_col), F.col(text_col).cast("string"))


def _bitmap(ids: DataFrame, at) -> tuple[np.ndarray | None, np.ndarray]:
    """Bits at the addresses ``at`` (below 2 ** FILTER_BITS) of all rows, summed in Spark, for ``_bits``.

    Broadcast values lie on the disk of the driver and of every executor, so a bitmap of few bits is
    kept as the words that hold them and their places.
    """
    with shuffles_deleted(ids.sparkSession):
        words = (ids.select(at.cast("long").alias("h")).where("h is not null")
                 .select(F.shiftright("h", 6).alias("w"), F.col("h").bitwiseAND(F.lit(63)).cast("int").alias("k"))
                 .groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, k)")).alias("v")).toArrow())
    few = words.column(0).to_numpy().astype(np.int32), words.column(1).to_numpy()
    return few if 12 * len(few[0]) < 1 << (FILTER_BITS - 3) else (None, _bits(few))


def _bits(kept: tuple[np.ndarray | None, np.ndarray]) -> np.ndarray:
    """The whole bitmap."""
    at, words = kept
    if at is None:
        return words
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bits[at] = words
    return bits


def _held(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 6] >> (at & 63) & 1).astype(bool)


def _address(col: str):
    return F.pmod(F.xxhash64(F.lit("filter"), F.col(col)), F.lit(1 << FILTER_BITS))


def passing(df: DataFrame, ids: DataFrame, col: str, *, once: bool = False) -> DataFrame:
    """The rows of ``df`` whose ``col`` may be among those of ``ids``.

    A bitmap of hashed ids, of fixed size, is summed in Spark and broadcast;
    rows that surely have no partner are left out before a join on ``col``,
    which must follow.  Null ids are left out.  With ``once`` a task lets the
    first row of a hashed id pass only, so copies of a row don't meet in a join.
    """
    shared = df.sparkSession.sparkContext.broadcast(_bitmap(ids.where(F.col(col).isNotNull()), _address(col)))
    whole = F.xxhash64(F.lit("once"), F.col(col))
    q = df.where(F.col(col).isNotNull()).withColumn("_h", _address(col)).withColumn("_w", whole)
    schema = q.schema

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = _bits(shared.value), set()
        for batch in batches:
            ok = _held(table, batch.column(batch.num_columns - 2).to_numpy())
            if once:
                whole = batch.column(batch.num_columns - 1).to_numpy()
                for k in np.flatnonzero(ok).tolist():
                    w = whole[k]
                    if w in seen:
                        ok[k] = False
                    else:
                        seen.add(w)
            yield batch.filter(pa.array(ok))

    return q.mapInArrow(test, schema).drop("_h", "_w")


def shared_lists(df: DataFrame, lists: str, nodes: DataFrame | None = None, col: str = "h") -> DataFrame:
    """``df`` with the array column ``lists`` (32-bit list numbers) cut down to lists that more than one
    row holds, and ``maybe``, as by ``in_lists``."""
    more = df.select(F.explode(lists).alias("list")).groupBy("list").agg(F.count("*").alias("m")).where("m > 1")
    return in_lists(df, lists, more, nodes, col)


def in_lists(df: DataFrame, lists: str, wanted: DataFrame, nodes: DataFrame | None = None, col: str = "h") -> DataFrame:
    """``df`` with the array column ``lists`` (32-bit list numbers) cut down to those that ``wanted`` has
    in ``list``; a filter of fixed size, so others may stay.

    With ``nodes`` a column ``maybe`` tells whether ``col`` may be among theirs (surely not, if
    false): the other rows need no join with them.
    """
    mask = (1 << FILTER_BITS) - 1
    spark = df.sparkSession
    bits = _bitmap(wanted, F.col("list").bitwiseAND(F.lit(mask)))
    known = None if nodes is None else _bitmap(nodes, _address(col))
    held = spark.sparkContext.broadcast((bits, known))
    q = df.withColumn("_a", F.lit(0).cast("long") if nodes is None else _address(col))
    schema = df.withColumn("maybe", F.lit(False)).schema
    at = df.columns.index(lists)

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = (None if x is None else _bits(x) for x in held.value)
        for batch in batches:
            column = batch.column(at)
            flat = column.flatten()
            ok = _held(bits, flat.to_numpy(zero_copy_only=False).astype(np.int64) & mask)
            off = np.concatenate(([0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())))
            kept = np.concatenate(([0], np.cumsum(ok)))[off].astype(np.int32)
            out = list(batch.columns[:-1])
            out[at] = pa.ListArray.from_arrays(pa.array(kept), flat.filter(pa.array(ok)))
            address = batch.column(batch.num_columns - 1).to_numpy()
            maybe = np.ones(len(address), bool) if known is None else _held(known, address)
            yield pa.RecordBatch.from_arrays([*out, pa.array(maybe)], names=schema.names)

    return q.mapInArrow(one, schema).where(F.size(lists) > 0)
