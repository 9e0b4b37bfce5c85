"""One redundant feed from its endpoints to its events, as one object."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamfuse.config import Endpoint, PoolOptions, SubscribeRequest
from streamfuse.functions.text import received_time
from streamfuse.operators import dedup, events, health
from streamfuse.operators.subscriptions import subscribe
from streamfuse.sources import feeds, routing
from streamfuse.streaming import dedup as stream_dedup
from streamfuse.streaming import health as stream_health
from streamfuse.streaming import sinks


@dataclass(frozen=True)
class Feed:
    """Endpoints, options and a subscription; the methods take and return DataFrames.

    Stored and streaming inputs go through the same methods, except that reports as of a point in
    time need stored ones. Rows carry ``signature``, ``received_ms`` and ``seq`` besides the
    columns the subscription speaks of.
    """

    endpoints: Sequence[Endpoint]
    options: PoolOptions = field(default_factory=PoolOptions)
    request: SubscribeRequest | Mapping | None = None
    state_buckets: int = 1024
    # Hashes of the keys that are too frequent for one task; None: look for them in each stored input.
    hot_keys: Sequence[int] | None = None

    def endpoints_table(self, spark: SparkSession) -> DataFrame:
        return feeds.endpoints_table(spark, self.endpoints)

    def merge(
        self, sources: Sequence[DataFrame | str], spark: SparkSession | None = None
    ) -> DataFrame:
        """One source per endpoint; a path that cannot be read is left out while any other can."""
        pairs = list(zip(self.endpoints, sources, strict=True))
        return feeds.fan_in(pairs, spark, require_any=True)

    def select(self, deliveries: DataFrame) -> DataFrame:
        """Transactions the subscription asks for, as far as they have a signature."""
        wanted = subscribe(deliveries, self.request) if self.request is not None else deliveries
        return routing.valid_signature(routing.transactions_only(wanted))

    def timed(self, selected: DataFrame, fallback_ms: Column | None = None) -> DataFrame:
        """Missing and zero receive times replaced, by the time of reading unless another is given."""
        now = fallback_ms if fallback_ms is not None else F.unix_millis(F.current_timestamp())
        return selected.withColumn("received_ms", received_time(F.col("received_ms"), now))

    def judge(self, selected: DataFrame, fallback_ms: Column | None = None) -> DataFrame:
        """Mark repeats within the time-to-live; every row has a time before it is judged."""
        by = ("signature", "received_ms", self.options.dedup_ttl_ms)
        timed = self.timed(selected, fallback_ms)
        if selected.isStreaming:
            return stream_dedup.dedup_ttl_stream(timed, *by, buckets=self.state_buckets)
        return dedup.dedup_ttl(timed, *by, hot_keys=self.hot_keys)

    def transactions(self, judged: DataFrame, data: Sequence[str]) -> DataFrame:
        return events.transaction_events(dedup.split_unique(judged)[0], data)

    def duplicates(self, judged: DataFrame) -> DataFrame:
        return events.duplicate_events(dedup.split_unique(judged)[1])

    def cache(self, judged: DataFrame, tick_ms: int = 30_000) -> DataFrame:
        """Live signatures at every report tick."""
        ttl, cap = self.options.dedup_ttl_ms, self.options.max_cache_size
        return dedup.dedup_occupancy(judged, ttl, cap, tick_ms)

    def endpoint_events(self, log: DataFrame) -> DataFrame:
        if log.isStreaming:
            return stream_health.endpoint_events_stream(log)
        return health.endpoint_events(log, recovery_details=True)

    def pool_events(self, log: DataFrame) -> DataFrame:
        return health.pool_events(log)

    def status(self, log: DataFrame, now_ms: int) -> DataFrame:
        """Every configured client, also those the log does not know yet."""
        return health.status_snapshot(log, now_ms, self.endpoints_table(log.sparkSession))

    def stale(self, log: DataFrame, start_ms: int = 0, end_ms: int = 0) -> DataFrame:
        """Silent clients: found by the checks of a stored log, or as they happen in a stream."""
        if log.isStreaming:
            return stream_health.stale_stream(log, self.options.stale_timeout_ms)
        found = health.stale_episodes(log, self.options.stale_timeout_ms, end_ms)
        return health.stale_detected(found, start_ms, self.options)

    def retries(self, log: DataFrame) -> DataFrame:
        o = self.options
        return health.retry_schedule(
            log, o.initial_retry_delay_ms, o.retry_backoff_factor, o.max_retry_delay_ms
        )

    def on(self, judged: DataFrame, checkpoint: str, **handlers: Callable[[DataFrame, int], None]):
        """Call ``transaction`` and ``duplicate`` handlers on each micro-batch of a judged stream."""
        kind = F.when(F.col("is_duplicate"), "duplicate").otherwise("transaction")
        return sinks.on_events(judged.withColumn("type", kind), handlers, checkpoint)
