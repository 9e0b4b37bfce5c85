"""Health of the endpoints: events, stale clients, retries, reports and a closing summary.

Usage: python examples/monitoring.py [sf_dir]
"""

import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from streamfuse.config import PoolOptions  # noqa: E402
from streamfuse.functions import text  # noqa: E402
from streamfuse.operators import counts  # noqa: E402
from streamfuse.plans import reports, samples  # noqa: E402
from streamfuse.plans.feed import Feed  # noqa: E402

OPTIONS = PoolOptions(
    stale_timeout_ms=3_600_000,
    dedup_ttl_ms=45_000,
    max_cache_size=5_000,
    initial_retry_delay_ms=1_000,
    max_retry_delay_ms=60_000,
    retry_backoff_factor=1.5,
)


def main(sf_dir: str) -> None:
    spark = SparkSession.builder.master("local[*]").getOrCreate()
    feed = Feed(samples.ENDPOINTS, OPTIONS)
    log = samples.connection_log(spark, sf_dir)
    judged = feed.judge(feed.select(samples.deliveries(spark, sf_dir)))
    start, end = log.agg(F.min("ts_ms"), F.max("ts_ms")).first()

    events = feed.endpoint_events(log)
    events.select(
        text.iso_time(F.col("timestamp")).alias("at"),
        "client_id",
        text.status_label(F.col("status")).alias("status"),
        "details",
    ).orderBy("at").show(8, truncate=False)
    feed.pool_events(log).orderBy("timestamp").show(5)
    feed.stale(log, start, end).show(5)
    feed.retries(log).show(5)
    feed.status(log, end).show()
    reports.status_report(
        judged,
        log,
        start_ms=start,
        end_ms=end,
        tick_ms=86_400_000,
        ttl_ms=OPTIONS.dedup_ttl_ms,
        max_size=OPTIONS.max_cache_size,
    ).orderBy("tick_ms").show(5)
    counts.connected_summary(feed.status(log, end)).show()
    summary = reports.run_summary(judged, feed.status(log, end), events, start, end)
    summary.show(truncate=False, vertical=True)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001")
