"""Periodic status of running queries: a report row per tick, from metrics that the queries observe.

The feed's query observes how many transactions and duplicates a micro-batch had, the query of the connection log how many
clients went up or down and how many were new. A listener adds these few numbers up on the driver and writes a row whenever both
queries have come to a tick; no row of the feed is read again. The number of live signatures comes out of the state of the feed's query.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

REPORT = (
    "tick_ms bigint, uptime_s bigint, active bigint, seen bigint, transactions bigint, duplicates bigint, size bigint,"
    " max_size bigint, ttl_ms bigint"
)
FEED, CLIENTS = "status_feed", "status_clients"


def observed_feed(judged: DataFrame) -> DataFrame:
    """A judged stream that tells its transactions, duplicates and newest time of each micro-batch."""
    return judged.observe(
        FEED,
        F.count_if(~F.col("is_duplicate")).alias("transactions"),
        F.count_if(F.col("is_duplicate")).alias("duplicates"),
        F.max("received_ms").alias("newest_ms"),
    )


def observed_clients(events: DataFrame) -> DataFrame:
    """Endpoint events with ``change`` and ``first`` that tell the clients gone up or down and the new ones."""
    return events.observe(
        CLIENTS,
        F.coalesce(F.sum("change"), F.lit(0)).alias("active"),
        F.coalesce(F.sum(F.col("first").cast("int")), F.lit(0)).alias("seen"),
        F.max("timestamp").alias("newest_ms"),
    )


class StatusLog(StreamingQueryListener):
    """Writes a row of ``REPORT`` below ``path`` for each tick that both queries have reached.

    A tick is reached by a query when it has finished a micro-batch of rows up to it: give the queries a trigger of the tick's
    length, or call ``reached`` where the caller knows. A tick that is told again overwrites its row. ``size`` gives the live keys
    at a time, such as ``stream_size`` on the feed's checkpoint. Totals start at zero with the listener; a job that goes on from
    a checkpoint gives the last row as ``totals``.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        *,
        start_ms: int,
        tick_ms: int = 30_000,
        ttl_ms: int = 60_000,
        max_size: int = 10_000,
        size: Callable[[int], int] | None = None,
        totals: dict[str, int] | None = None,
    ):
        self.spark, self.path, self.size = spark, path.rstrip("/"), size
        self.start_ms, self.tick_ms, self.ttl_ms, self.max_size = start_ms, tick_ms, ttl_ms, max_size
        self.totals = {"transactions": 0, "duplicates": 0, "active": 0, "seen": 0, **(totals or {})}
        self.newest: dict[str, int] = {}
        self.batches: dict[str, int] = {}  # the last micro-batch of each query
        self.lock = threading.Lock()

    def tick_of(self, at_ms: int) -> int:
        """The first tick at or after a time."""
        return max(1, -(-(at_ms - self.start_ms) // self.tick_ms)) * self.tick_ms + self.start_ms

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            if name in (FEED, CLIENTS):
                self.add(name, progress.batchId, row.asDict())

    def add(self, name: str, batch_id: int, metrics: dict) -> None:
        """Take the metrics of one micro-batch, once."""
        with self.lock:
            if self.batches.get(name, -1) >= batch_id:
                return
            self.batches[name] = batch_id
            newest = metrics.pop("newest_ms", None)
            for what, n in metrics.items():
                self.totals[what] += n or 0
            if newest is not None:
                self.newest[name] = max(newest, self.newest.get(name, newest))
            ticks = {self.tick_of(n) for n in self.newest.values()}
            if len(self.newest) == 2 and len(ticks) == 1:
                self._write(ticks.pop())

    def reached(self, tick_ms: int) -> None:
        """Write the row of a tick that both queries are known to have come to."""
        with self.lock:
            self._write(tick_ms)

    def _write(self, tick: int) -> None:
        totals = self.totals
        size = self.size(tick) if self.size else None
        row = (
            tick, (tick - self.start_ms + 500) // 1000, totals["active"], totals["seen"], totals["transactions"],
            totals["duplicates"], size, self.max_size, self.ttl_ms,
        )
        table = self.spark.createDataFrame([row], REPORT).coalesce(1)
        table.write.mode("overwrite").parquet(f"{self.path}/tick={tick}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """The rows that a listener has written so far."""
    return spark.read.schema(REPORT).parquet(f"{path.rstrip('/')}/tick=*")
