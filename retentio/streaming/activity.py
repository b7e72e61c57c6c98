"""Keyed state and timers (R1, R3): duplicate events dropped and quiet users flagged as the stream runs.

Every user has state of their own: the ids and times of the events that may still be followed.  An
event is passed on when its id is seen first.  The earliest open event sets a timer one ``quiet``
span later; when the watermark passes it, every event up to then has come or is late for good, so a
user without a later event in that span is flagged once, whatever the order or the
batches in which events came.  The timer also gives the state of all events up to the watermark less
``quiet`` back and is set anew for the next, so
state holds the events of about ``quiet`` plus the watermark's delay.  Ids of events without a time
are kept: nothing ever makes them late.

Needs Spark's RocksDB state store, which the jobs here set for their query.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import checkpoint_dir
from .jobs import _stream

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT, QUIET = "event", "quiet"
#: Events of one element of a user's state.
CHUNK = 4096


class QuietUsers(StatefulProcessor):
    """Passes on each event once and flags users that stay without events for ``quiet_ms``.

    Every call to the state costs a round trip to the executor's JVM, so a user's open events are read
    and written as a few chunks, and one timer, that of the earliest open event, closes all that are due.
    """

    def __init__(self, quiet_ms: int) -> None:
        self.quiet = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "at array<long>, ids array<string>")
        self.untimed = handle.getMapState("untimed", "id string", "seen boolean")

    def _held(self) -> list[tuple[int, str]]:
        """The open events (time, id) of the user at hand."""
        return [event for at, ids in self.open.get() for event in zip(at, ids)]

    def _chunks(self, events: list[tuple[int, str]]) -> list[tuple[list[int], list[str]]]:
        parts = [events[k:k + CHUNK] for k in range(0, len(events), CHUNK)]
        return [([at for at, _ in part], [i for _, i in part]) for part in parts]

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self._held()
        seen, first = {i for _, i in held}, min((at for at, _ in held), default=None)
        kept, new = self.untimed.exists(), []
        for row in rows:
            event, at = str(row.event_id), row.at_ms
            if event in seen or kept and self.untimed.containsKey((event,)):
                continue
            seen.add(event)
            if at is None:
                self.untimed.updateValue((event,), (True,))
            else:
                new.append((at, event))
            yield Row(user_id=key[0], kind=EVENT, event_id=event, at_ms=at)
        if new:
            self.open.appendList(self._chunks(new))
            earliest = min(at for at, _ in new)
            if first is None or earliest < first:
                self.handle.registerTimer(earliest + self.quiet)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) - self.quiet
        held = self._held()
        left = [event for event in held if event[0] > due]
        if len(left) == len(held):  # closed by an earlier timer
            return
        if left:
            self.open.put(self._chunks(left))
            self.handle.registerTimer(min(at for at, _ in left) + self.quiet)
        else:
            self.open.clear()
        times = sorted({at for at, _ in held})
        for at, after in zip(times, [*times[1:], None]):
            if at <= due and (after is None or after > at + self.quiet):
                yield Row(user_id=key[0], kind=QUIET, event_id=None, at_ms=at + self.quiet)

    def close(self) -> None:
        pass


def quiet_users_stream(events: DataFrame, quiet_ms: int, watermark: str = "1 day", user: str = "user_id", event_id: str = "event_id",
                       ts: str = "ts") -> DataFrame:
    """(user_id, kind, event_id, at): each event once, and a row of kind ``quiet`` per quiet span, at its end.

    Rows of a null user belong to a user of their own; a row without an event time never sets a timer.
    """
    at = F.col(ts).cast("timestamp")
    e = events.withColumn(ts, at).withWatermark(ts, watermark)
    e = e.select(F.col(user).alias("user_id"), F.col(event_id).cast("string").alias("event_id"), F.unix_millis(F.col(ts)).alias("at_ms"), F.col(ts).alias("ts"))
    schema = T.StructType([T.StructField("user_id", events.schema[user].dataType), T.StructField("kind", T.StringType()),
                           T.StructField("event_id", T.StringType()), T.StructField("at_ms", T.LongType())])
    out = e.groupBy("user_id").transformWithState(statefulProcessor=QuietUsers(quiet_ms), outputStructType=schema, outputMode="Append", timeMode="EventTime")
    return out.select("user_id", "kind", "event_id", F.timestamp_millis("at_ms").alias("at"))


def quiet_users_job(spark: SparkSession, source: str, quiet_ms: int, watermark: str = "1 day", work_dir: str | None = None,
                    max_files: int | None = None, schema: T.StructType | None = None) -> DataFrame:
    """R1 + R3 end to end: what is there now is streamed, and the table of all rows so far returned; called
    again with the same ``work_dir`` it goes on where it stopped."""
    base = work_dir or os.path.join(checkpoint_dir(spark), "stream_quiet_users", uuid.uuid4().hex)
    s = _stream(spark, source, schema or spark.read.parquet(source).schema, max_files=max_files)
    out = os.path.join(base, "table")
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    try:
        rows = quiet_users_stream(s, quiet_ms, watermark)
        q = (rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", os.path.join(base, "_checkpoint"))
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    if q.exception():
        raise q.exception()
    return spark.read.schema(rows.schema).parquet(out)
