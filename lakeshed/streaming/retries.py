"""Retries as a stateful stream: attempts by key, dead after so many, handled keys forgotten after a while."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The state store that keeps a key's state beyond memory, which such streams need.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
WAITING, DONE, DEAD = "retry", "done", "dead"


class _Attempts(StatefulProcessor):
    """A key's attempts in order of time: each failure counts until one succeeds or there were ``most``; what comes after is ignored."""

    def __init__(self, most: int, forget_ms: int):
        self.most, self.forget_ms = most, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("attempts", "attempts long, status string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        attempts, status = self.state.get() if self.state.exists() else (0, None)
        before = (attempts, status)
        frame = pd.concat(rows).sort_values(["at", "number"])
        last = None
        for at, failed in zip(frame["at"], frame["failed"], strict=True):
            if status in (DONE, DEAD):
                break
            attempts += bool(failed)
            status, last = (DEAD if attempts >= self.most else WAITING) if failed else DONE, at
        if (attempts, status) != before:
            self.state.update((int(attempts), status))
            self.handle.registerTimer(int(pd.Timestamp(last).timestamp() * 1000) + self.forget_ms)
            yield pd.DataFrame({"key": [key[0]], "attempts": [int(attempts)], "status": [status], "at": [last]})

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """A key with a later timer has been heard of since."""
        if self.state.exists() and not any(t > expiredTimerInfo.getExpiryTimeInMs() for t in self.handle.listTimers()):
            self.state.clear()
        yield from ()

    def close(self) -> None:
        pass


@contextmanager
def with_store(spark: SparkSession) -> Iterator[None]:
    """Sets the state store that ``attempts`` needs for the streams that start within."""
    name, store = STORE
    before = spark.conf.get(name, None)
    spark.conf.set(name, store)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def attempts(stream: DataFrame, key: str, at: str, number: str, failed: str, most: int = 3, late: str = "1 hour", forget: str = "30 days") -> DataFrame:
    """(key, attempts, status, at): a row for each key and micro-batch that changed it; the last one by ``at`` holds.

    Rows have a key (a number), the time ``at``, a ``number`` that orders rows of one time,
    and whether they ``failed``.  Status is ``retry``, ``done`` or, after ``most`` failures,
    ``dead``.  A key is forgotten ``forget`` after its last change, by the time of the
    stream; rows later than ``late`` are left out.
    """
    ms = int(pd.Timedelta(forget).total_seconds() * 1000)
    rows = stream.select(F.col(key).cast("long").alias("key"), F.col(at).alias("at"), F.col(number).cast("long").alias("number"), F.col(failed).alias("failed")).filter("key is not null and at is not null and failed is not null")
    return rows.withWatermark("at", late).groupBy("key").transformWithStateInPandas(_Attempts(most, ms), "key long, attempts long, status string, at timestamp", "append", "EventTime")


def last_status(found: DataFrame) -> DataFrame:
    """key, attempts, status as last told; repeated rows of a batch that ran again change nothing."""
    best = F.max_by(F.struct("attempts", "status"), F.struct("at", "attempts", F.col("status") != WAITING))
    return found.groupBy("key").agg(best.alias("x")).select("key", "x.*")
