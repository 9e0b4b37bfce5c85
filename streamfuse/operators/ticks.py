"""Report ticks: rounding to them, listing them, and running totals over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Ticks of one task.
CHUNK = 4_096


def next_tick(column: str, tick_ms: int) -> Column:
    """The first tick at or after a time."""
    c = F.col(column)
    return c + F.pmod(-c, F.lit(tick_ms))


def _chunk(tick_ms: int) -> Column:
    return F.call_function("div", F.col("tick_ms"), F.lit(tick_ms * CHUNK))


def tick_spine(per_tick: DataFrame, tick_ms: int) -> DataFrame:
    """Every tick from the first to the last of a per-tick table, a chunk of them in each row before
    they are listed, so that no task lists them all."""
    ends = per_tick.agg(F.min("tick_ms").alias("lo"), F.max("tick_ms").alias("hi"))
    step = F.lit(tick_ms).cast("bigint")
    chunks = ends.filter(F.col("lo").isNotNull()).select(
        "hi", F.explode(F.sequence("lo", "hi", step * CHUNK)).alias("lo")
    )
    parts = int(per_tick.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.least(F.col("lo") + step * (CHUNK - 1), F.col("hi"))
    return chunks.repartition(parts, "lo").select(
        F.explode(F.sequence("lo", last, step)).alias("tick_ms")
    )


def running_totals(
    spine: DataFrame, changes: DataFrame, names: Sequence[str], tick_ms: int
) -> DataFrame:
    """At each tick of ``spine`` the totals of ``changes`` up to it.

    Ticks are summed in chunks; one row for each chunk carries the totals of the chunks before. Changes before
    the first tick of the spine count, too.
    """
    at, chunk = F.col("tick_ms"), _chunk(tick_ms)
    per_chunk = changes.groupBy(chunk.alias("_chunk")).agg(*[F.sum(n).alias(n) for n in names])
    # A row for every chunk of the spine, also where nothing changes.
    empty = spine.select(chunk.alias("_chunk")).distinct()
    blank = empty.select("_chunk", *[F.lit(0).cast("bigint").alias(n) for n in names])
    stacked = per_chunk.unionByName(blank).groupBy("_chunk").agg(*[F.sum(n).alias(n) for n in names])
    earlier = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = stacked.select("_chunk", *[F.sum(n).over(earlier).alias(f"_from_{n}") for n in names])

    local = spine.withColumn("_shown", F.lit(True)).join(changes, "tick_ms", "full")
    place = Window.partitionBy("_chunk").orderBy(at)
    so_far = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = local.withColumn("_chunk", chunk).withColumns(
        {f"_sum_{n}": F.sum(F.coalesce(n, F.lit(0))).over(so_far) for n in names}
    )
    total = {n: F.col(f"_sum_{n}") + F.coalesce(f"_from_{n}", F.lit(0)) for n in names}
    return (
        summed.filter("_shown")
        .join(carried, "_chunk", "left")
        .select("tick_ms", *[c.alias(n) for n, c in total.items()])
    )
