"""Running values over one total order, without sending a whole order through one task.

A plain window over all rows, or over the rows of one busy client, runs in a single task. Here
the order is cut at split points taken from a sample (so a burst, even within one millisecond, is
cut as well), each block is scanned on its own, and a table of one row per block carries
sums and last values across. The split points only steer the placement of rows: every choice
of them gives the same result.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK = "_block"


def split_points(
    df: DataFrame,
    order: Sequence[str],
    target_rows: int = 1_000_000,
    min_blocks: int | None = None,
    max_blocks: int = 65_536,
    sample_per_block: int = 20,
) -> list[Row]:
    """Sampled quantiles of the order columns; at most ``max_blocks - 1`` of them.

    Blocks grow only beyond ``max_blocks * target_rows`` rows, 65 billion; a block is sorted and
    scanned on disk if it has to be, so larger ones cost time, not memory. The sample on the driver has about ``blocks * sample_per_block`` rows of the order columns,
    whatever the size of the data.
    """
    keys = df.select(*order)
    total = keys.count()
    if min_blocks is None:
        min_blocks = df.sparkSession.sparkContext.defaultParallelism
    blocks = min(max(math.ceil(total / target_rows), min_blocks), max_blocks, max(total, 1))
    if blocks < 2:
        return []
    fraction = min(1.0, blocks * sample_per_block / total)
    sample = sorted(tuple(r) for r in keys.sample(fraction, seed=17).collect())
    picks = sorted({sample[len(sample) * i // blocks] for i in range(1, blocks)} if sample else ())
    return [Row(*p) for p in picks]


def with_block(df: DataFrame, order: Sequence[str], points: Sequence[Row]) -> DataFrame:
    """Add the number of split points at or before a row, by binary search in a constant array.

    One column per step, so that the steps compile into the loop over the rows; a search inside one
    lambda expression is interpreted, and took about five times as long.
    """
    placed = df.withColumn(BLOCK, F.lit(0))
    if not points:
        return placed
    fields = ", ".join(f"o{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(order))
    text = json.dumps([{f"o{i}": v for i, v in enumerate(p)} for p in points])
    cuts = F.from_json(F.lit(text), f"array<struct<{fields}>>")
    here = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    found = F.col(BLOCK)
    for step in (1 << b for b in reversed(range(len(points).bit_length()))):
        reached = F.get(cuts, found + step - 1) <= here
        placed = placed.withColumn(BLOCK, F.when(reached, found + step).otherwise(found))
    return placed


def scan(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    *,
    points: Sequence[Row],
    sums: Mapping[str, Column] | None = None,
    latest: Mapping[str, Column] | None = None,
    previous: Mapping[str, Column] | None = None,
    following: Mapping[str, Column] | None = None,
    keep_blocks: bool = False,
) -> DataFrame:
    """Add running columns in the order of ``order``, separately for each value of ``by``.

    With ``keep_blocks`` the result keeps its blocks, and a further scan by the same columns finds the
    rows where it needs them instead of shuffling them again.

    ``sums``: total up to and including the row. ``latest``: last value that is not null, up to
    and including the row. ``previous``: the same, before the row. ``following``: first value
    that is not null, after the row. ``order`` must be unique within ``by``, without nulls.
    """
    sums, latest = dict(sums or {}), dict(latest or {})
    previous, following = dict(previous or {}), dict(following or {})
    inputs = {
        **{f"_sum_{n}": F.coalesce(c, F.lit(0)) for n, c in sums.items()},
        **{f"_lat_{n}": c for n, c in latest.items()},
        **{f"_pre_{n}": c for n, c in previous.items()},
        **{f"_fol_{n}": c for n, c in following.items()},
    }
    staged = df if BLOCK in df.columns else with_block(df, order, points)
    staged = staged.withColumns(inputs)
    spent = [*inputs] if keep_blocks else [BLOCK, *inputs]

    place = Window.partitionBy(BLOCK, *by).orderBy(*order)
    upto = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = place.rowsBetween(Window.unboundedPreceding, -1)
    over = f"OVER (PARTITION BY {', '.join([BLOCK, *by])} ORDER BY {', '.join(order)})"
    local = staged.withColumns(
        {
            **{n: F.sum(f"_sum_{n}").over(upto) for n in sums},
            **{n: F.last(f"_lat_{n}", ignorenulls=True).over(upto) for n in latest},
            **{n: F.last(f"_pre_{n}", ignorenulls=True).over(before) for n in previous},
            **{n: F.expr(f"lead(_fol_{n}) IGNORE NULLS {over}") for n in following},
        }
    )
    if not points:
        return local.drop(*spent)

    def extreme(pick, column):
        told = F.struct(*order, F.col(column).alias("_told"))
        return pick(F.when(F.col(column).isNotNull(), told))["_told"].alias(column)

    ends = staged.groupBy(BLOCK, *by).agg(
        *[F.sum(f"_sum_{n}").alias(f"_sum_{n}") for n in sums],
        *[extreme(F.max, f"_lat_{n}") for n in latest],
        *[extreme(F.max, f"_pre_{n}") for n in previous],
        *[extreme(F.min, f"_fol_{n}") for n in following],
    )
    # At most max_blocks rows for each value of by.
    earlier = (
        Window.partitionBy(*by).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    )
    across = f"OVER ({'PARTITION BY ' + ', '.join(by) if by else ''} ORDER BY {BLOCK})"
    carried = ends.select(
        BLOCK,
        *by,
        *[F.sum(f"_sum_{n}").over(earlier).alias(f"_from_{n}") for n in sums],
        *[
            F.last(f"_{p}_{n}", ignorenulls=True).over(earlier).alias(f"_from_{n}")
            for p, names in (("lat", latest), ("pre", previous))
            for n in names
        ],
        *[F.expr(f"lead(_fol_{n}) IGNORE NULLS {across}").alias(f"_from_{n}") for n in following],
    )
    # No broadcast hint: the engine broadcasts by measured size, or joins on the window's placement.
    joined = local.join(carried, [BLOCK, *by], "left")
    names = [*sums, *latest, *previous, *following]
    return joined.withColumns(
        {
            **{n: F.col(n) + F.coalesce(f"_from_{n}", F.lit(0)) for n in sums},
            **{n: F.coalesce(n, f"_from_{n}") for n in (*latest, *previous, *following)},
        }
    ).drop(*spent, *[f"_from_{n}" for n in names])


def prefix_sum(
    df: DataFrame,
    value: Column,
    order: Sequence[str],
    name: str,
    by: Sequence[str] = (),
    points: Sequence[Row] | None = None,
) -> DataFrame:
    """Running total of one value over the whole order."""
    if points is None:
        points = split_points(df, order)
    return scan(df, order, by, points=points, sums={name: value})
