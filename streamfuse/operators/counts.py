"""Counts, shares and rates. Shares are integer arithmetic, rounded half up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from streamfuse.operators.ordered import scan, split_points


def _rounded(part: Column, whole: Column, scale: int) -> Column:
    """round(scale * part / whole), half up; 0 when there is nothing."""
    half_up = F.call_function("div", 2 * scale * part + whole, 2 * whole)
    return F.when(whole > 0, half_up).otherwise(F.lit(0).cast("bigint"))


def duplicate_pct(duplicates: Column, total: Column) -> Column:
    """Share of duplicates as a whole percentage."""
    return _rounded(duplicates, total, 100)


def unique_pct(unique: Column, total: Column) -> Column:
    """Share of unique rows as a whole percentage."""
    return _rounded(unique, total, 100)


def dedup_counts(
    df: DataFrame,
    window_ms: int | None = None,
    ts: str = "received_ms",
    by: Sequence[str] = (),
) -> DataFrame:
    """Unique, duplicate and total rows with both shares, per window of time when one is given."""
    keys: list[Column | str] = list(by)
    if window_ms is not None:
        start = F.col(ts) - F.pmod(F.col(ts), F.lit(window_ms))
        keys.insert(0, start.alias("window_start_ms"))
    repeat = F.col("is_duplicate")
    counts = df.groupBy(*keys).agg(
        F.count_if(~repeat).alias("n_unique"),
        F.count_if(repeat).alias("n_duplicate"),
        F.count("*").alias("n_total"),
    )
    total = F.col("n_total")
    return counts.withColumns(
        {
            "unique_pct": unique_pct(F.col("n_unique"), total),
            "duplicate_pct": duplicate_pct(F.col("n_duplicate"), total),
        }
    )


def running_rate(
    df: DataFrame, order: Sequence[str], every: int = 10, points: Sequence[Row] | None = None
) -> DataFrame:
    """Messages and duplicates so far and the unique share, at every ``every``-th message.

    Give ``points`` from the feed before it was judged; else two more passes over ``df`` find them.
    """
    if points is None:
        points = split_points(df, order)
    slim = df.select(*order, F.col("is_duplicate").cast("bigint").alias("_repeat"))
    running = scan(
        slim,
        order,
        points=points,
        sums={"n_messages": F.lit(1).cast("bigint"), "n_duplicates": F.col("_repeat")},
    )
    total, repeats = F.col("n_messages"), F.col("n_duplicates")
    return running.filter(total % every == 0).select(
        "n_messages",
        "n_duplicates",
        (_rounded(total - repeats, total, 1000) / 10).alias("unique_share"),
    )


def throughput(df: DataFrame, start_ms: int, now_ms: int, ts: str = "received_ms") -> DataFrame:
    """Messages from ``start_ms`` to ``now_ms``, and per second to one decimal."""
    elapsed = F.lit(now_ms - start_ms).cast("bigint")
    counted = df.filter(F.col(ts).between(start_ms, now_ms)).agg(F.count("*").alias("n_messages"))
    tenths = _rounded(F.col("n_messages"), elapsed, 10_000)
    return counted.withColumn("messages_per_second", tenths / 10)


def status_counts(events: DataFrame, pivot: bool = False) -> DataFrame:
    """Endpoint events per client and status; one column per status with ``pivot``."""
    if pivot:
        statuses = ["connected", "disconnected", "reconnected"]
        return events.groupBy("client_id").pivot("status", statuses).count().fillna(0)
    return events.groupBy("client_id", "status").agg(F.count("*").alias("n_events"))


def connected_summary(snapshot: DataFrame) -> DataFrame:
    """Connected clients over all clients."""
    return snapshot.agg(
        F.count_if("connected").alias("n_connected"), F.count("*").alias("n_clients")
    )


def first_messages(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` messages; each task keeps its own first ``n`` before they meet."""
    return df.orderBy(*order).limit(n)


def sequence_numbers(
    df: DataFrame,
    order: Sequence[str],
    family: Sequence[str] = (),
    name: str = "number",
    points: Sequence[Row] | None = None,
) -> DataFrame:
    """Arrival number from 1, counted separately for each event family; ``points`` as above."""
    if points is None:
        points = split_points(df, order)
    return scan(df, order, family, points=points, sums={name: F.lit(1).cast("bigint")})
