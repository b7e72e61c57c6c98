"""J1 as a stream–stream join: orders with the tickets opened soon after them.

Both sides carry watermarks and the join a time range, so Spark keeps an order in state only until no
ticket for it can come any more; an order without a ticket is emitted then, once, with nulls.  On
closed windows the rows are those of the batch join.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .jobs import _stream

WITHIN_DAYS = 7


def orders_with_tickets(orders: DataFrame, tickets: DataFrame, within_days: int = WITHIN_DAYS, watermark: str = "1 day") -> DataFrame:
    """(order_id, customer_id, ordered_at, ticket_id, opened_at) for ``orders`` (order_id, customer_id,
    ordered_at) and ``tickets`` (ticket_id, customer_id, opened_at).

    A ticket belongs to every order of its customer in the ``within_days`` before it.  Streams are joined
    as streams, tables as tables.  Orders without a customer have no tickets.
    """
    o, t = orders, tickets.withColumnRenamed("customer_id", "_customer")
    if orders.isStreaming:
        o, t = o.withWatermark("ordered_at", watermark), t.withWatermark("opened_at", watermark)
    same = (F.col("customer_id") == F.col("_customer")) & (F.col("opened_at") >= F.col("ordered_at")) & (
        F.col("opened_at") <= F.col("ordered_at") + F.expr(f"INTERVAL {within_days} DAYS"))
    return o.join(t, same, "left").select("order_id", "customer_id", "ordered_at", "ticket_id", "opened_at")


def orders_with_tickets_job(spark: SparkSession, orders_path: str, tickets_path: str, as_orders, as_tickets, within_days: int = WITHIN_DAYS,
                            watermark: str = "1 day", work_dir: str | None = None, max_files: int | None = None) -> DataFrame:
    """Stream what is there of both sources and return the table so far; called again with the same
    ``work_dir`` it goes on.  ``as_orders`` and ``as_tickets`` shape the sources' rows."""
    base = work_dir or os.path.join(checkpoint_dir(spark), "stream_order_tickets", uuid.uuid4().hex)
    source = lambda p: _stream(spark, p, spark.read.parquet(p).schema, max_files=max_files)
    rows = orders_with_tickets(as_orders(source(orders_path)), as_tickets(source(tickets_path)), within_days, watermark)
    out = os.path.join(base, "table")
    q = (rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", os.path.join(base, "_checkpoint"))
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.schema(rows.schema).parquet(out)
