"""The lease machine as a stateful stream, and the status of a queue as a streaming aggregate.

State is one small record for each open task.  Each event in time yields a receipt, so foreign submissions and those
after a lease's end are seen in the output rather than lost.  Timers follow the events' own time: a lease
that runs out returns to the queue when the stream's time has passed it, whether or not the task has another event,
and a task that is submitted is forgotten after ``keep`` seconds, so the state holds open tasks and
those of late.  The state can be read with ``held``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sparkloom.operators.broker import LEASE_SECONDS, Task

EVENTS = "task_id string, seq long, at double, action string, token string, answer string"
RECEIPTS = "task_id string, seq long, action string, accepted boolean, state string, at double"
NAMES = [c.split()[0] for c in RECEIPTS.split(", ")]
STATE = "state string, digest string, expires double, leases int, rejected int, answer string"
KEEP_SECONDS = 7 * 86400
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Leases(StatefulProcessor):
    """One task's machine; its only timer is the end of its lease, or the time to forget it."""

    def __init__(self, seconds: float, keep: float):
        self.seconds, self.keep = seconds, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.held = handle, handle.getValueState("task", STATE)

    def due(self, at: float | None) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if at is not None:
            self.handle.registerTimer(int(at * 1000) + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        task = Task(*self.held.get()) if self.held.exists() else Task()
        out, submitted = [], None
        for at, seq, action, token, answer in sorted((r for f in rows for r in zip(f["at"], f["seq"], f["action"], f["token"], f["answer"])), key=lambda r: r[:2]):
            ok = task.apply(action, at, token, answer, self.seconds)
            out.append((key[0], seq, action, ok, task.state, at))
            submitted = at if ok and action == "submit" else submitted
        self.held.update(task.row())
        if task.state == "leased":
            self.due(task.expires)
        elif task.state == "queued":
            self.due(None)
        elif submitted is not None:
            self.due(submitted + self.keep)
        yield pd.DataFrame(out, columns=NAMES)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        task = Task(*self.held.get())
        action = "forget" if task.state == "submitted" else "expire"
        if action == "forget":
            self.held.clear()
        else:
            task.expire(expiredTimerInfo.getExpiryTimeInMs() / 1000)
            self.held.update(task.row())
        yield pd.DataFrame([(key[0], -1, action, True, task.state, expiredTimerInfo.getExpiryTimeInMs() / 1000)], columns=NAMES)

    def close(self) -> None:
        pass


def receipts(events: DataFrame, seconds: float = LEASE_SECONDS, delay: str = "10 minutes", keep: float = KEEP_SECONDS) -> DataFrame:
    """A receipt for each event of a stream with columns EVENTS, and one of seq -1 for each lease that runs out and
    each task that is forgotten.

    Within a trigger the events of a task are applied in order of (at, seq); across triggers in order of arrival.  The
    stream's time follows the events' ``at``, ``delay`` behind the latest; an event from before it is dropped, as leases have been
    judged by then, and the query's progress counts it (the log's fold takes it in).  Sets the session's state store to
    RocksDB, which such state needs."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    # a stream's time starts at 0, and an event of that very time would be late
    ts = F.timestamp_micros((F.col("at") * 1_000_000).cast("long") + 1)
    rows = events.select("task_id", "seq", "at", "action", "token", "answer", ts.alias("ts")).withWatermark("ts", delay)
    return rows.groupBy("task_id").transformWithStateInPandas(Leases(seconds, keep), RECEIPTS, "Append", "EventTime")


def held(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state that a stream of receipts holds, read from its checkpoint: task_id, the fields of STATE."""
    rows = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "task").load()
    return rows.select("key.task_id", "value.*")


def live_status(events: DataFrame, key: str, state: str, order: list[str]) -> DataFrame:
    """Latest state of each task of a stream (complete or update mode)."""
    return events.groupBy(key).agg(F.max_by(state, F.struct(*order)).alias("state"))


def windowed_actions(events: DataFrame, ts: str = "ts", delay: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Actions by event-time window; events later than ``delay`` are dropped by the watermark."""
    return events.withWatermark(ts, delay).groupBy(F.window(ts, width), "action").agg(F.count("*").alias("n"))


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", most_seconds: float = 3600) -> None:
    """Run a stream over all that is there, into Parquet, until nothing is left to do."""
    query = stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        if not query.awaitTermination(int(most_seconds)):
            raise TimeoutError("a stream did not drain in time")
    finally:
        query.stop()
