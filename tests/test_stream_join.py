"""Orders and tickets joined as streams give the batch join's rows on closed windows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from retentio.streaming.joins import orders_with_tickets, orders_with_tickets_job

O = "order_id long, customer_id long, ordered_at timestamp"
T = "ticket_id long, customer_id long, opened_at timestamp"


def rows(n=90, seed=2):
    rng = random.Random(seed)
    at = lambda k: dt.datetime(2024, 1, 1) + dt.timedelta(hours=6 * k, minutes=rng.randrange(300))
    orders = [(k, rng.choice([1, 2, 3, 4, None]), at(k)) for k in range(n)]
    tickets = [(k, rng.choice([1, 1, 1, 2, 9, None]), at(k)) for k in range(0, n, 2)]
    return orders, tickets


@pytest.mark.parametrize("files", [1, 3])
def test_closed_windows_equal_the_batch_join(spark, tmp_path, files):
    orders, tickets = rows()
    src = {"o": str(tmp_path / "orders"), "t": str(tmp_path / "tickets")}
    for k in range(files):
        for name, data, schema in (("o", orders, O), ("t", tickets, T)):
            size = -(-len(data) // files)
            spark.createDataFrame(data[k * size:(k + 1) * size], schema).coalesce(1).write.mode("append").parquet(src[name])
        got = orders_with_tickets_job(spark, src["o"], src["t"], lambda d: d, lambda d: d, within_days=2, work_dir=str(tmp_path / "work"), max_files=1)
    closed = min(max(r[2] for r in x if r[2]) for x in (orders, tickets)) - dt.timedelta(days=1) - dt.timedelta(days=2)
    key = lambda df: sorted((tuple(r) for r in df.where(F.col("ordered_at") < F.lit(closed)).collect()), key=str)
    want = key(orders_with_tickets(spark.createDataFrame(orders, O), spark.createDataFrame(tickets, T), within_days=2))
    assert key(got) == want and any(r[3] is None for r in want) and any(r[3] is not None for r in want)
    again = orders_with_tickets_job(spark, src["o"], src["t"], lambda d: d, lambda d: d, within_days=2, work_dir=str(tmp_path / "work"))
    assert key(again) == want
