"""Deduplication by key with a time-to-live that starts at the first sighting.

A row within ``ttl`` (inclusive) of its key's anchor is a duplicate; the next later row is unique
and becomes the new anchor. A hit never extends the time-to-live. Order inside a key is
``(ts, *order)`` and must be unique.
"""



import warnings
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from streamfuse.operators import anchors
from streamfuse.operators.ticks import next_tick, running_totals, tick_spine
from streamfuse.session import checkpointed

ORDER = ("ordinal", "seq")

# Rows of one key that are worth more than one task.
HOT_ROWS = 5_000_000

# Distinct milliseconds one task holds of one hot key.
BLOCK_VALUES = 2_000_000
# Where a time-to-live is longer than that, it is cut into so many columns, or more if they had more milliseconds than a
# packed block may have: 128 KB at most.
COLUMNS = 256
PACKED_MS = 1 << 20
# Shares of the key space, each with a sketch of its own.
SKETCHES = 64
# Keys listed and tracked by a sketch; when the last one listed is hot too, both grow tenfold.
LISTED, TRACKED = 100, 4_000
MOST_TRACKED = 1_000_000
# Size of the anchors of all hot keys that are sent to every task; above it their rows are spread by salt.
BROADCAST_BYTES = 64 * 1024 * 1024
# What a row of the anchors takes besides its key, in memory.
ROW_BYTES = 100
SALTS = 256
# Rows of one cell of a hot key, beyond which they are spread by salt.
CELL_ROWS = 200_000


@dataclass(frozen=True)
class _Rule:
    keys: tuple[str, ...]
    ts: str
    ttl: int
    order: tuple[str, ...]
    block_ms: int | None
    enter: str | None

    def in_order(self) -> Column:
        return F.struct(*self.order)


def find_hot_keys(df: DataFrame, key: str | Sequence[str], min_rows: int) -> list[int]:
    """Hashes of the keys with about ``min_rows`` rows or more.

    A count of the rows with a key comes first: fewer than ``min_rows`` hold no such key, and counting computes no key. Then one
    pass over the key column goes into mergeable sketches, each for a share of the keys so that they
    merge in parallel; rows do not shuffle. A key with more than a thousandth of the rows of its
    share is always found. Where a whole list is hot, the pass is made again with a longer one. The list
    only chooses between two exact methods.
    """
    keys = _names(key)
    keyed = df.select(*keys).dropna(subset=keys)
    if keyed.count() < min_rows:
        return []
    hashed = keyed.select(F.xxhash64(*keys).alias("h"))
    listed, tracked = LISTED, TRACKED
    while True:
        found = hashed.groupBy(F.pmod("h", F.lit(SKETCHES)).alias("share")).agg(
            F.expr(f"approx_top_k(h, {listed}, {tracked})").alias("top")
        )
        rows = found.select("share", F.explode("top").alias("t")).filter(F.col("t.count") >= min_rows)
        hot = rows.select("share", "t.item").collect()
        full = Counter(r.share for r in hot)
        whole = max(full.values(), default=0) < listed
        if not whole and tracked * 10 > MOST_TRACKED:
            # The result of a deduplication is the same; the keys not listed are one task's work each.
            warnings.warn(f"more than {listed} hot keys in a share of the keys; not all are listed", stacklevel=2)
        if whole or tracked * 10 > MOST_TRACKED:
            return sorted(r.item for r in hot)
        listed, tracked = listed * 10, tracked * 10


def dedup_ttl(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str,
    ttl_ms: int,
    order: Sequence[str] = ORDER,
    *,
    hot_rows: int | None = None,
    hot_keys: Sequence[int] | None = None,
    block_ms: int | None = None,
    enter: str | None = None,
) -> DataFrame:
    """Add ``is_duplicate`` and ``anchor_ms``.

    Rows shuffle once, on the key. Keys with ``hot_rows`` rows or more (five million) take a second
    way that never holds a key in one task; finding them is a pass over the key column when this is
    called, unless ``hot_keys`` gives them. A row without a key or without a time is unique and has no anchor.
    ``enter`` names a column with the anchor, or null, that a key brings along from earlier data; its value
    is the same in all rows of a key, and rows older than it are duplicates.
    """
    if block_ms is None and ttl_ms < BLOCK_VALUES:
        block_ms = (ttl_ms + 1) * (BLOCK_VALUES // (ttl_ms + 1))
    if block_ms is not None and block_ms <= ttl_ms:
        raise ValueError("block_ms must exceed ttl_ms")
    rule = _Rule(_names(key), ts, ttl_ms, tuple(order), block_ms, enter)
    if hot_keys is None:
        hot_keys = find_hot_keys(df, key, hot_rows or HOT_ROWS)
    if not hot_keys:
        return _by_window(df, rule)
    hot = is_hot(rule.keys, hot_keys) & F.col(ts).isNotNull()
    return _by_window(df.filter(~hot), rule).unionByName(_by_blocks(df.filter(hot), rule))


def is_hot(key: str | Sequence[str], hot_keys: Sequence[int]) -> Column:
    """Whether a row has one of the keys ``find_hot_keys`` listed."""
    keys = _names(key)
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return F.xxhash64(*keys).isin(list(hot_keys)) & ~missing


def _names(key: str | Sequence[str]) -> tuple[str, ...]:
    return (key,) if isinstance(key, str) else tuple(key)


def _keyless(rule: _Rule) -> Column:
    """Rows that nothing can be a repeat of: without a key or without a time."""
    missing = [F.col(k).isNull() for k in (*rule.keys, rule.ts)]
    return reduce(lambda a, b: a | b, missing)


def _fold(ttl: int):
    """Stateful over the sorted rows of a partition; only times and flags leave the JVM."""

    def fold(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        return anchors.fold_groups(batches, ttl)

    return F.arrow_udf(fold, "anchor_ms bigint, is_duplicate boolean").asNondeterministic()


def _chain(ttl: int):
    def chain(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        return anchors.chain_blocks(batches, ttl)

    return F.arrow_udf(chain, "bigint").asNondeterministic()


def _by_window(df: DataFrame, rule: _Rule) -> DataFrame:
    """One shuffle and sort on the key, then one pass over the sorted rows.

    A row more than ``ttl`` after its predecessor is certainly unique, because an anchor is never
    later than the previous row. Such rows begin the groups which are folded independently.
    """
    # Rows without a key are spread by their order columns instead of meeting in one task.
    keyless = _keyless(rule)
    spread = F.when(keyless, F.xxhash64(*rule.keys, rule.ts, *rule.order))
    placed = df.withColumn("_spread", spread)
    sorting = [*rule.keys, "_spread", rule.ts, *rule.order]
    in_key = Window.partitionBy(*rule.keys, "_spread").orderBy(rule.ts, *rule.order)
    near = F.col(rule.ts) - F.col("_previous") <= rule.ttl
    grouped = (
        placed.withColumn("_previous", F.lag(rule.ts).over(in_key))
        .withColumn("_first", ~F.coalesce(near, F.lit(False)))
        .sortWithinPartitions(*sorting)  # already so after the window; states what the fold needs
    )
    seed = F.col(rule.enter) if rule.enter else F.lit(None).cast("bigint")
    folded = grouped.withColumn("_fold", _fold(rule.ttl)(rule.ts, "_first", seed))
    return folded.select(
        *df.columns,
        (F.col("_fold.is_duplicate") & ~keyless).alias("is_duplicate"),
        F.when(~keyless, F.col("_fold.anchor_ms")).alias("anchor_ms"),
    )


def _by_blocks(df: DataFrame, rule: _Rule) -> DataFrame:
    """The same rule for hot keys, with work spread over time.

    Copies at one millisecond are combined before the shuffle. Each block of time works out which
    last anchor every possible first anchor leads to; chaining these small tables gives the
    anchor each block starts with, then all blocks are folded in parallel. Runs when called, up to
    the table of anchors.
    """
    keys, ts, ttl = list(rule.keys), rule.ts, rule.ttl
    entered = F.lit(False)
    if rule.enter:
        entered = F.coalesce(F.col(ts) <= F.col(rule.enter) + ttl, F.lit(False))
    times = df.filter(~entered).select(*keys, ts).distinct()
    anchors_of = _anchors_of_packed if rule.block_ms is None else _anchors_of_blocks
    return _with_anchors(df, rule, checkpointed(anchors_of(times, rule)), entered)


def _anchors_of_packed(times: DataFrame, rule: _Rule) -> DataFrame:
    """The anchors where a time-to-live has more milliseconds than a task should hold.

    Time is written in rows of one time-to-live and a millisecond, and rows are cut into columns. The next anchor is the first time
    at the same place of the next row or later, so as long as there is one in its column, the chain of anchors stays there; else
    it goes on at the start of the next column. Each column works out on its own, for a chain that comes into any of its rows, in
    which row it leaves. From these small numbers the rows that the chain comes into are found, and the columns fold those.
    No task reads the times of more than one column.
    """
    keys, ts = list(rule.keys), rule.ts
    period = rule.ttl + 1
    width = min(-(-period // COLUMNS), PACKED_MS)
    width += -width % 8
    columns = -(-period // width)
    place = F.pmod(F.col(ts), F.lit(period))
    inside = F.pmod(place, F.lit(width))
    cells = times.select(
        *keys,
        ((F.col(ts) - place) / period).cast("bigint").alias("_row"),
        ((place - inside) / width).cast("bigint").alias("_column"),
        inside.alias("_inside"),
    )
    schema = cells.select(*keys, "_row", "_column").schema.add("_times", T.BinaryType())

    def pack(table):
        one = table.slice(0, 1).select([*keys, "_row", "_column"]).combine_chunks()
        packed = anchors.pack_times(table.column("_inside").to_numpy(), width)
        return one.append_column("_times", pa.array([packed], pa.binary()))

    def exits(table):
        rows, order = _in_rows(table)
        left = anchors.column_exits(rows, table.column("_times").take(order).to_pylist(), width)
        return table.select([*keys, "_row", "_column"]).take(order).append_column("_exit", pa.array(left, pa.int64()))

    def walk(table):
        rows, order = _in_rows(table)
        ordered = table.take(order)
        entered = ordered.column("_entered").to_pylist()
        found = anchors.column_anchors(rows, ordered.column("_times").to_pylist(), entered, width)
        at, inside_ = (np.array(x, dtype=np.int64) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
        column = table.column("_column")[0].as_py() if table.num_rows else 0
        made = ordered.select(keys).take(pa.array(at))
        return made.append_column(ts, pa.array(rows[at] * period + column * width + inside_, pa.int64()))

    packed = checkpointed(cells.groupBy(*keys, "_row", "_column").applyInArrow(pack, schema))
    left = packed.groupBy(*keys, "_column").applyInArrow(
        exits, packed.select(*keys, "_row", "_column").schema.add("_exit", T.LongType())
    )

    def chain(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        return anchors.chain_columns(batches, columns)

    chained = F.arrow_udf(chain, "boolean").asNondeterministic()
    in_key = Window.partitionBy(*keys).orderBy("_row", "_column")
    entered = (
        left.withColumn("_opens", F.lag("_row").over(in_key).isNull())
        .sortWithinPartitions(*keys, "_row", "_column")
        .withColumn("_entered", chained("_row", "_column", "_exit", "_opens"))
        .filter("_entered")
        .select(*keys, "_row", "_column", "_entered")
    )
    rows = packed.join(entered, [*keys, "_row", "_column"], "left")
    return rows.groupBy(*keys, "_column").applyInArrow(walk, times.select(*keys, ts).schema)


def _in_rows(table: pa.Table) -> tuple[np.ndarray, pa.Array]:
    """The rows of a column in order, and where they stand."""
    rows = table.column("_row").to_numpy()
    order = np.argsort(rows, kind="stable")
    return rows[order], pa.array(order)


def _anchors_of_blocks(times: DataFrame, rule: _Rule) -> DataFrame:
    """The anchors by blocks of at least one time-to-live, each small enough for a task."""
    keys, ts, ttl = list(rule.keys), rule.ts, rule.ttl
    block = F.col(ts) - F.pmod(F.col(ts), F.lit(rule.block_ms))
    times = times.withColumn("_block_ms", block)
    longs = T.ArrayType(T.LongType())
    exits_schema = (
        times.select(*keys, "_block_ms").schema.add("_heads", longs).add("_exits", longs)
    )

    def block_table(table):
        ordered = np.sort(table.column(ts).to_numpy())
        start = table.column("_block_ms")[0].as_py()
        heads, exits = anchors.block_exits(ordered, start, ttl)
        one = table.slice(0, 1).select([*keys, "_block_ms"]).combine_chunks()
        return one.append_column("_heads", pa.array([heads], pa.list_(pa.int64()))).append_column(
            "_exits", pa.array([exits], pa.list_(pa.int64()))
        )

    exits = times.groupBy(*keys, "_block_ms").applyInArrow(block_table, exits_schema)
    in_key = Window.partitionBy(*keys).orderBy("_block_ms")
    entering = (
        exits.withColumn("_opens", F.lag("_block_ms").over(in_key).isNull())
        .sortWithinPartitions(*keys, "_block_ms")
        .withColumn("_enter_ms", _chain(ttl)("_block_ms", "_opens", "_heads", "_exits"))
        .select(*keys, "_block_ms", "_enter_ms")
    )

    in_block = Window.partitionBy(*keys, "_block_ms").orderBy(ts)
    return (
        times.join(entering, [*keys, "_block_ms"], "left")
        .withColumn("_opens", F.lag(ts).over(in_block).isNull())
        .sortWithinPartitions(*keys, "_block_ms", ts)
        .withColumn("_fold", _fold(ttl)(ts, "_opens", "_enter_ms"))
        .filter(~F.col("_fold.is_duplicate"))
        .select(*keys, ts)
    )


def _with_anchors(df: DataFrame, rule: _Rule, found: DataFrame, entered: Column) -> DataFrame:
    """Judge the rows of hot keys by the anchors found for them."""
    keys, ts, ttl = list(rule.keys), rule.ts, rule.ttl
    # The usual case: a few hot keys with one anchor per time-to-live. Their rows do not shuffle. The
    # table that is sent to every task has up to two rows for each anchor.
    key_bytes = reduce(lambda a, b: a + b, [F.octet_length(F.col(k).cast("string")) for k in keys])
    size = found.agg(F.sum(2 * (key_bytes + ROW_BYTES)).alias("b")).first().b or 0
    small = size <= BROADCAST_BYTES
    # Of the rows at an anchor's time the first one in order owns it.
    at_anchor = df.join(F.broadcast(found), [*keys, ts], "left_semi") if small else df
    owners = at_anchor.groupBy(*keys, ts).agg(F.min(rule.in_order()).alias("_first"))
    if not small:
        owners = owners.join(found, [*keys, ts], "left_semi")

    # A cell of ttl + 1 ms has at most one anchor; a row's anchor is in its cell or the one before.
    width = ttl + 1

    def cell(c: str) -> Column:
        return F.col(c) - F.pmod(F.col(c), F.lit(width))

    own = F.struct(F.col(ts).alias("at"), F.col("_first").alias("first"))
    here = F.struct(
        cell(ts).alias("_cell"),
        own.alias("_own"),
        F.lit(None).cast("bigint").alias("_before"),
    )
    after = F.struct(
        (cell(ts) + width).alias("_cell"),
        F.when(F.lit(False), own).alias("_own"),
        F.col(ts).alias("_before"),
    )
    lookup = (
        owners.select(*keys, F.explode(F.array(here, after)).alias("e"))
        .groupBy(*keys, "e._cell")
        .agg(F.max("e._own").alias("_own"), F.max("e._before").alias("_before"))
    )
    rows = df.withColumn("_cell", cell(ts))
    if small:
        tagged = rows.join(F.broadcast(lookup), [*keys, "_cell"], "left")
    else:
        # Only cells with many rows are worth salting; their number is known before rows move.
        sizes = rows.groupBy(*keys, "_cell").agg(F.count("*").alias("_n"))
        crowded = checkpointed(sizes.filter(F.col("_n") > CELL_ROWS).select(*keys, "_cell"))
        marked = lookup.join(crowded.withColumn("_many", F.lit(True)), [*keys, "_cell"], "left")
        every = F.sequence(F.lit(0), F.lit(SALTS - 1))
        copies = F.explode(F.when(F.col("_many"), every).otherwise(F.array(F.lit(0))))
        salt = F.pmod(F.xxhash64(*rule.order), F.lit(SALTS)).cast("int")
        salted = rows.join(crowded.withColumn("_many", F.lit(True)), [*keys, "_cell"], "left")
        salted = salted.withColumn("_salt", F.when(F.col("_many"), salt).otherwise(F.lit(0)))
        tagged = salted.drop("_many").join(
            marked.withColumn("_salt", copies).drop("_many"), [*keys, "_cell", "_salt"], "left"
        )
    is_own = F.coalesce(F.col("_own.at") <= F.col(ts), F.lit(False))
    is_first = is_own & (F.col("_own.at") == F.col(ts)) & (F.col("_own.first") == rule.in_order())
    anchor = F.when(is_own, F.col("_own.at")).otherwise(F.col("_before"))
    if rule.enter:
        anchor = F.when(entered, F.col(rule.enter)).otherwise(anchor)
    return tagged.select(
        *df.columns,
        (entered | ~is_first).alias("is_duplicate"),
        anchor.alias("anchor_ms"),
    )


def split_unique(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The unique rows and the duplicate rows; the first endpoint to deliver owns the unique one."""
    repeat = F.col("is_duplicate")
    return df.filter(~repeat), df.filter(repeat)


def dedup_occupancy(
    df: DataFrame, ttl_ms: int, max_size: int, tick_ms: int, ts: str = "anchor_ms"
) -> DataFrame:
    """Live keys at every report tick, with the size limit and the time-to-live.

    Sweep over anchors: one in at the anchor, one out a millisecond after the time-to-live. All sums
    are by tick, so only one row per tick reaches the running total.
    """
    anchored = df.filter(~F.col("is_duplicate") & F.col(ts).isNotNull())
    changes = anchored.select(
        F.explode(
            F.array(
                F.struct(F.col(ts).alias("at"), F.lit(1).alias("change")),
                F.struct((F.col(ts) + ttl_ms + 1).alias("at"), F.lit(-1).alias("change")),
            )
        ).alias("e")
    ).select("e.*")
    per_tick = changes.groupBy(next_tick("at", tick_ms).alias("tick_ms")).agg(
        F.sum("change").alias("change")
    )
    running = running_totals(tick_spine(per_tick, tick_ms), per_tick, ["change"], tick_ms)
    return (
        running.withColumnRenamed("change", "size")
        .withColumns(
            {
                "max_size": F.lit(max_size).cast("bigint"),
                "ttl_ms": F.lit(ttl_ms).cast("bigint"),
                "cap_would_act": F.col("size") >= max_size,
            }
        )
    )


def live_keys(df: DataFrame, key: str | Sequence[str], now_ms: int, ttl_ms: int) -> DataFrame:
    """Keys not yet expired at ``now_ms``, with the time they were first seen."""
    recent = F.col("anchor_ms").between(now_ms - ttl_ms, now_ms)
    return (
        df.filter(~F.col("is_duplicate") & recent)
        .groupBy(*_names(key))
        .agg(F.max("anchor_ms").alias("first_seen_ms"))
    )
