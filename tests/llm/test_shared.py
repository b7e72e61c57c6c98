import glob
import os
import pickle
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from retentio.llm import components as C
from retentio.llm import shared, text


def shuffle_files(spark):
    top = os.environ.get("SPARK_LOCAL_DIRS") or spark.sparkContext.getConf().get("spark.local.dir", "/tmp")
    return set(glob.glob(f"{top}/blockmgr-*/*/shuffle_*"))


def test_written_frames_leave_no_shuffle_files(spark):
    """What a checkpointed or stored frame has shuffled is deleted when it is written; it can be run again."""
    before = shuffle_files(spark)
    q = spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.collect_list("id").alias("ids"))
    cut, stored = shared.cut(q), shared.stored(q)
    for _ in range(40):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.25)
    assert not shuffle_files(spark) - before
    assert q.count() == cut.count() == stored.count() == 1000
    assert spark.conf.get(shared.CLEANUP) == "false"


def test_python_workers_get_small_batches(spark):
    """A worker of a written frame holds few bytes at a time, however many rows a task has."""
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    q = spark.range(0, 20_000, 1, 1).select(F.rpad(F.col("id").cast("string"), 1000, "x").alias("text")).mapInArrow(sizes, "n long, size long")
    before = spark.conf.get(shared.BATCH)
    for held in (shared.cut(q), shared.stored(q)):
        got = held.agg(F.sum("n"), F.max("size")).first()
        assert got[0] == 20_000 and got[1] < 1.25 * shared.BATCH_BYTES
    assert spark.conf.get(shared.BATCH) == before


def test_pieces_hold_all_rows_in_order():
    batches = [pa.RecordBatch.from_arrays([pa.array(range(a, b), pa.int64())], names=["x"]) for a, b in ((0, 700), (700, 700), (700, 703))]
    got = list(text.pieces(iter(batches), 256))
    assert [b.num_rows for b in got] == [256, 256, 188, 3]
    assert [x for b in got for x in b.column(0).to_pylist()] == list(range(703))


def test_a_bitmap_of_few_ids_is_small(spark):
    """It is written to the disk of the driver and of every executor; its bits are those of the whole one."""
    ids = spark.range(0, 3000, 3)
    kept = shared._bitmap(ids, shared._address("id"))
    assert len(pickle.dumps(kept)) < 20_000
    bits = shared._bits(kept)
    assert len(bits) << 6 == 1 << shared.FILTER_BITS
    want = {r.a for r in ids.select(shared._address("id").alias("a")).collect()}
    assert sum(int(x).bit_count() for x in bits.view(np.uint64)[np.flatnonzero(bits)]) == len(want)
    assert shared._held(bits, np.array(sorted(want))).all()
    assert sorted(r.id for r in shared.passing(spark.range(3000), ids, "id").collect()) == list(range(0, 3000, 3))


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_components_settled_early_are_parts_of_the_whole_ones(spark, rounds):
    rng = random.Random(rounds)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(400, 460)]
    frame = spark.createDataFrame(links, "a long, b long")
    whole = {r.node: r.root for r in C.components(frame).collect()}
    assert whole[460] == 400 and all(whole[a] == whole[b] for a, b in links if a != b)
    e = C.settled(frame, rounds)
    early = {r.node: r.root for r in C.least_of(e).collect()}
    assert set(early) == set(whole) and all(whole[early[x]] == whole[x] for x in early)
    assert {r.node: r.root for r in C.components(e).collect()} == whole


def test_a_round_of_components_has_no_union(spark, monkeypatch):
    """Both ends of a link come from one scan."""
    plans = []
    cut = C.cut
    monkeypatch.setattr(C, "cut", lambda df: plans.append(df) or cut(df))
    C.settled(spark.createDataFrame([(1, 2), (2, 3)], "a long, b long"), 1)
    plan = plans[1]._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "Generate" in plan
