"""Reports that put several operators together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from streamfuse.functions.text import client_state
from streamfuse.operators.health import client_changes_per_tick
from streamfuse.operators.ticks import running_totals


def run_summary(
    deduped: DataFrame,
    snapshot: DataFrame,
    events: DataFrame,
    start_ms: int,
    end_ms: int,
) -> DataFrame:
    """One row: whole seconds, uniques, duplicates, total, final state and events per client.

    The parts are single rows; they are stacked and folded into one instead of being joined. Lists
    have one entry per configured client.
    """
    counts = deduped.agg(
        F.count_if(~F.col("is_duplicate")).alias("n_unique"),
        F.count_if(F.col("is_duplicate")).alias("n_duplicate"),
    )
    entry = F.concat_ws(" ", "client_id", client_state(F.col("connected")))
    states = snapshot.agg(F.array_join(F.sort_array(F.collect_list(entry)), "; ").alias("states"))
    per_status = events.groupBy("client_id", "status").agg(F.count("*").alias("n"))
    entry = F.concat_ws(" ", "client_id", "status", F.col("n").cast("string"))
    totals = per_status.agg(
        F.array_join(F.sort_array(F.collect_list(entry)), "; ").alias("events")
    )
    stacked = counts.unionByName(states, allowMissingColumns=True).unionByName(
        totals, allowMissingColumns=True
    )
    one = stacked.agg(*[F.max(c).alias(c) for c in ("n_unique", "n_duplicate", "states", "events")])
    seconds = F.call_function("div", F.lit(end_ms - start_ms + 500), F.lit(1000))
    return one.select(
        seconds.cast("bigint").alias("duration_s"),
        "n_unique",
        "n_duplicate",
        (F.col("n_unique") + F.col("n_duplicate")).alias("n_total"),
        "states",
        "events",
    )


def status_report(
    deduped: DataFrame,
    log: DataFrame,
    *,
    start_ms: int,
    end_ms: int,
    tick_ms: int = 30_000,
    ttl_ms: int = 60_000,
    max_size: int = 10_000,
    points: Sequence[Row] | None = None,
) -> DataFrame:
    """At every tick: uptime, active and seen clients, transactions, duplicates, live signatures.

    Every input is reduced to changes per tick first, so one row per tick reaches the running sums.
    """

    def first_tick(column: Column) -> Column:
        """First tick at or after a time; what came before the start belongs to the first one."""
        since = column - start_ms
        tick = since + F.pmod(-since, F.lit(tick_ms)) + start_ms
        return F.greatest(tick, F.lit(start_ms + tick_ms).cast("bigint"))

    def change(at: Column, **by: Column) -> Column:
        names = ("transactions", "duplicates", "size")
        values = [by.get(n, F.lit(0)).cast("bigint").alias(n) for n in names]
        return F.struct(first_tick(at).alias("tick_ms"), *values)

    repeat, anchor = F.col("is_duplicate"), F.col("anchor_ms")
    one = F.when(repeat | anchor.isNull(), 0).otherwise(1)
    # One pass over the judged rows: each is a message, an entry of the cache and its expiry.
    moves = F.array(
        change(F.col("received_ms"), transactions=~repeat, duplicates=repeat),
        change(anchor, size=one),
        change(anchor + ttl_ms + 1, size=-one),
    )
    feed = (
        deduped.select(F.explode(moves).alias("m"))
        .select("m.*")
        .groupBy("tick_ms")
        .agg(*[F.sum(n).alias(n) for n in ("transactions", "duplicates", "size")])
    )
    clients = client_changes_per_tick(log, tick_ms, start_ms, points).withColumn(
        "tick_ms", F.greatest("tick_ms", F.lit(start_ms + tick_ms).cast("bigint"))
    )
    stacked = feed.unionByName(clients, allowMissingColumns=True)
    names = ["active", "seen", "transactions", "duplicates", "size"]
    changes = stacked.groupBy("tick_ms").agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]
    )
    n_ticks = (end_ms - start_ms) // tick_ms
    spine = deduped.sparkSession.range(1, n_ticks + 1).select(
        (F.col("id") * tick_ms + start_ms).alias("tick_ms")
    )
    return running_totals(spine, changes, names, tick_ms).select(
        "tick_ms",
        F.call_function("div", F.col("tick_ms") - start_ms + 500, F.lit(1000)).alias("uptime_s"),
        *names,
        F.lit(max_size).cast("bigint").alias("max_size"),
        F.lit(ttl_ms).cast("bigint").alias("ttl_ms"),
    )
