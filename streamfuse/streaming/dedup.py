"""Anchored deduplication of a stream.

Two forms of one rule. ``dedup_ttl_stream`` is a stateful operator that fits into any streaming
query. ``MicroBatchDedup`` judges each micro-batch with the batch operator and keeps the anchors as a table
partitioned by their time; payload never leaves the JVM there and hot keys are spread. Both give the result of the
batch operator unless bounded state is asked for.

An anchor older than a row by more than the time-to-live says nothing about it. So both keep anchors by cells of time, and a
batch reads those from its own least time on, less the time-to-live, whatever the age of the feed.
"""

from collections.abc import Callable, Iterator, Sequence
from functools import partial, reduce
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from streamfuse.operators.anchors import mark_anchors
from streamfuse.operators.dedup import HOT_ROWS, ORDER, dedup_ttl, find_hot_keys, is_hot
from streamfuse.session import use_keyed_state
from streamfuse.streaming.clock import CLOCK, with_clock

# Cells of state in a time-to-live. More let keys leave sooner, fewer are less to look up.
CELLS = 4
# Pieces of state that are looked up one by one; from there on the list of those that exist is asked for.
LOOKED_UP = 64
# A piece of state is at most this part of the cells a batch sets anchors in.
PARTS = 16
# Before all cells.
NEVER = -(1 << 62)
HOUR_MS = 3_600_000
# Folders of anchors that are named one by one when they are read.
NAMED_CELLS = 500


def cell_width(ttl_ms: int) -> int:
    """Milliseconds of a cell of state: a quarter of the time-to-live."""
    return max(1, ttl_ms // CELLS)


def cut(first: int, end: int, level: int) -> list[tuple[int, int]]:
    """The cells from ``first`` to before ``end`` as pieces (level, cell), the longest that fit up to a level.

    A piece is 2**level cells, from a multiple of that on.
    """
    pieces = []
    while first < end:
        fits = max(n for n in range(level + 1) if first % (1 << n) == 0 and first + (1 << n) <= end)
        pieces.append((fits, first))
        first += 1 << fits
    return pieces


def dedup_ttl_stream(
    df: DataFrame,
    key: str,
    ts: str,
    ttl_ms: int,
    order: Sequence[str] = ORDER,
    lateness_ms: int | None = None,
    buckets: int = 1024,
) -> DataFrame:
    """Add ``is_duplicate``, ``anchor_ms`` and, with ``lateness_ms``, ``maybe_expired`` to a stream.

    ``key`` is a binary or text column; rows without a key or without a time are unique. A row older than
    its anchor is a duplicate. Python is called once for a bucket of keys. A bucket's state is one entry for each piece of
    time, with the keys that have an anchor there. A piece is a cell, or many where a micro-batch sets anchors in many, so a
    micro-batch reads and writes a few dozen entries for a bucket however long a time it spans.

    State is unbounded by default, which is what the rule needs: a row may repeat an anchor however
    late it comes. With ``lateness_ms`` an event-time timer for each piece lets the keys of its cells go when the watermark, the
    newest time of the whole feed, is later than the cell's end, ``ttl_ms`` and ``lateness_ms`` together; that is at most a
    quarter of the time-to-live after the same counted from the anchor, and happens in buckets without rows too. What is left
    of a piece is dealt to shorter ones. Rows are
    never dropped for being late; unique rows that come so late that their anchor may have left are flagged.
    ``buckets`` and ``ttl_ms`` must not change over the life of a checkpoint. All rows of a bucket in one micro-batch meet in
    one task: limit the rate at the source, or use ``MicroBatchDedup`` where keys are frequent. Sets the session's
    state store to the one that keeps keyed state.
    """
    use_keyed_state(df.sparkSession)
    sorting = [ts, *order]
    text = T.StructType.fromDDL("_repeat boolean, _anchor_ms bigint, _late boolean")
    schema = T.StructType([*df.schema.fields, *text.fields])
    columns = schema.names
    key_type = df.schema[key].dataType
    entry = T.StructType([
        T.StructField("keys", T.ArrayType(key_type)), T.StructField("anchors", T.ArrayType(T.LongType())),
    ])
    plain = bytes if isinstance(key_type, T.BinaryType) else lambda k: k
    width = cell_width(ttl_ms)

    class Judge(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.cells = handle.getMapState("cells", "level int, cell bigint", entry)
            self.ends = handle.getValueState("ends", "by_level array<bigint>")

        def handleInputRows(self, key_, rows, timerValues) -> Iterator[pd.DataFrame]:
            if key_[0] == CLOCK:
                return
            found = pd.concat(list(rows), ignore_index=True)
            timed = found[ts].notna().to_numpy()
            codes, keys = pd.factorize(found[key].where(timed))  # a missing key gets code -1
            at = np.lexsort([*(found[c].to_numpy() for c in reversed(sorting)), codes])
            found, codes = found.iloc[at], codes[at]

            keyed = int(np.searchsorted(codes, 0))
            repeat = np.zeros(len(found), dtype=bool)
            late = np.zeros(len(found), dtype=bool)
            anchor = pd.array([pd.NA] * len(found), dtype="Int64")
            if keyed < len(found):
                times = found[ts].to_numpy()[keyed:].astype(np.int64)
                of = codes[keyed:]
                starts = np.flatnonzero(np.diff(of, prepend=-1))
                stored = self._stored((int(times.min()) - ttl_ms) // width)
                known = [pair for held in stored.values() for pair in zip(*held, strict=True)]
                latest = dict(sorted(known, key=itemgetter(1)))
                seen = [latest.get(k) for k in keys]
                seeded = np.array([a is not None for a in seen])
                seeds = np.array([0 if a is None else a for a in seen], dtype=np.int64)
                # Rows up to an anchor's time-to-live repeat it, even those before it.
                within = seeded[of] & (times <= seeds[of] + ttl_ms)
                limits = np.where(seeded, seeds + ttl_ms, times[starts] - 1)
                marks = mark_anchors(times, starts, limits, ttl_ms)
                row = np.maximum.accumulate(np.where(marks, np.arange(len(marks)), -1))
                values = np.where(within, seeds[of], times[row])
                repeat[keyed:], anchor[keyed:] = ~marks, values
                last = values[np.append(starts[1:], len(of)) - 1]
                changed = np.flatnonzero(~seeded | (last != seeds))
                if len(changed):
                    at = last[changed] // width
                    first, end = int(at.min()), int(at.max()) + 1
                    pieces = cut(first, end, max(1, (end - first) // PARTS).bit_length() - 1)
                    self._store(pieces, [keys[i] for i in changed], last[changed], stored.get)
                if lateness_ms is not None:
                    late[keyed:] = marks & (times <= timerValues.getCurrentWatermarkInMs() - lateness_ms)
            yield found.assign(_repeat=repeat, _anchor_ms=anchor, _late=late)[columns]

        def _ends(self) -> list[int]:
            """The first cell after the newest piece of each level."""
            found = self.ends.get()
            return [int(end) for end in found[0]] if found else []

        def _entry(self, piece: tuple[int, int]) -> tuple[list, list] | None:
            """Keys and anchors of a piece."""
            found = self.cells.getValue(piece)
            return found and ([plain(k) for k in found[0]], [int(a) for a in found[1]])

        def _stored(self, first: int) -> dict[tuple[int, int], tuple[list, list]]:
            """Keys and anchors by piece, of those that reach up to a cell or beyond."""
            ranges = [range(first >> n << n, end, 1 << n) for n, end in enumerate(self._ends())]
            if sum(map(len, ranges)) > LOOKED_UP:
                pieces = [(n, c) for n, c in self.cells.keys() if c + (1 << n) > first]
            else:
                pieces = [(n, c) for n, cells in enumerate(ranges) for c in cells]
            entries = ((p, self._entry(p)) for p in pieces)
            return {p: e for p, e in entries if e is not None}

        def _store(self, pieces: list[tuple[int, int]], keys: list, anchors: np.ndarray, held: Callable) -> None:
            """Add anchors to the pieces that their cells are in; ``held`` gives what a piece has."""
            of = np.searchsorted([c for _, c in pieces], anchors // width, side="right") - 1
            before = self._ends()
            levels = max(len(before), 1 + max(n for n, _ in pieces))
            ends = before + [NEVER] * (levels - len(before))
            for i in np.unique(of):
                piece, rows = pieces[i], np.flatnonzero(of == i)
                old = held(piece)
                if lateness_ms is not None and old is None:
                    self.handle.registerTimer((piece[1] + 1) * width + ttl_ms + lateness_ms)
                old_keys, old_anchors = old or ([], [])
                self.cells.updateValue(piece, ([*old_keys, *(keys[r] for r in rows)], [*old_anchors, *anchors[rows].tolist()]))
                ends[piece[0]] = max(ends[piece[0]], piece[1] + (1 << piece[0]))
            if ends != before:
                self.ends.update((ends,))

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            after = ttl_ms + lateness_ms
            cell = (expiredTimerInfo.getExpiryTimeInMs() - after) // width - 1
            # The first cell that is not too old.
            first = max(cell + 1, (timerValues.getCurrentWatermarkInMs() - after) // width)
            for level, end in enumerate(self._ends()):
                if end <= cell or cell % (1 << level):
                    continue
                entry = self._entry((level, cell))
                if entry is None:
                    continue
                self.cells.removeKey((level, cell))
                anchors = np.array(entry[1], dtype=np.int64)
                left = np.flatnonzero(anchors // width >= first)
                if len(left):
                    pieces = cut(first, cell + (1 << level), level)
                    self._store(pieces, [entry[0][i] for i in left], anchors[left], self._entry)
            return iter(())

        def close(self) -> None:
            pass

    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    spread = F.pmod(F.xxhash64(*sorting), F.lit(buckets)).cast("int")
    placed = df.withColumn("_bucket", F.when(F.col(key).isNull(), spread).otherwise(bucket))
    if lateness_ms is not None:
        placed = with_clock(placed, ts, {"_bucket": F.lit(CLOCK)})
    mode = "none" if lateness_ms is None else "EventTime"
    judged = placed.groupBy("_bucket").transformWithStateInPandas(Judge(), schema, outputMode="append", timeMode=mode)
    # Renaming makes plain rows of the Arrow ones, which a sink that sorts cannot take.
    flags = [F.col("_repeat").alias("is_duplicate"), F.col("_anchor_ms").alias("anchor_ms")]
    if lateness_ms is not None:
        flags.append(F.col("_late").alias("maybe_expired"))
    return judged.select(*df.columns, *flags)


def state_anchors(spark: SparkSession, checkpoint: str, key: str, batch_id: int | None = None) -> DataFrame:
    """(key, anchor_ms): the anchors that the state of ``dedup_ttl_stream`` holds, read out of a query's checkpoint.

    The query may be running; its last finished batch is read, or the one named. A key has one row for each cell of time that
    it has an anchor in.
    """
    reader = spark.read.format("statestore").option("stateVarName", "cells")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    entries = reader.load(checkpoint).select(F.explode(F.arrays_zip("user_map_value.keys", "user_map_value.anchors")).alias("e"))
    return entries.select(F.col("e.keys").alias(key), F.col("e.anchors").alias("anchor_ms"))


def stream_live_keys(
    spark: SparkSession, checkpoint: str, key: str, now_ms: int, ttl_ms: int, batch_id: int | None = None
) -> DataFrame:
    """``live_keys`` of a running stream: keys not yet expired at ``now_ms`` and when they were first seen."""
    recent = state_anchors(spark, checkpoint, key, batch_id).filter(F.col("anchor_ms").between(now_ms - ttl_ms, now_ms))
    return recent.groupBy(key).agg(F.max("anchor_ms").alias("first_seen_ms"))


def stream_size(
    spark: SparkSession, checkpoint: str, key: str, now_ms: int, ttl_ms: int, max_size: int, batch_id: int | None = None
) -> DataFrame:
    """One row of ``dedup_occupancy`` for a running stream."""
    size = stream_live_keys(spark, checkpoint, key, now_ms, ttl_ms, batch_id).agg(F.count("*").alias("size"))
    return size.select(
        F.lit(now_ms).cast("bigint").alias("tick_ms"), "size", F.lit(max_size).cast("bigint").alias("max_size"),
        F.lit(ttl_ms).cast("bigint").alias("ttl_ms"), (F.col("size") >= max_size).alias("cap_would_act"),
    )


def drop_repeats_builtin(df: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """The engine's own stream deduplication: cheap, but a different rule.

    It frees a key only when the watermark passes, and judges by presence, not by age, so a repeat
    after the time-to-live may still be dropped. Duplicates are not reported.
    """
    at = F.timestamp_millis(F.col(ts))
    kept = df.withColumn("_at", at).withWatermark("_at", delay)
    return kept.dropDuplicatesWithinWatermark([key]).drop("_at")


class MicroBatchDedup:
    """Deduplicate micro-batches against a table of anchors, inside ``foreachBatch``.

    The table is partitioned by the hour of the anchors (or by ``cell_ms``) and by batch. A batch reads the cells from its least
    time less the time-to-live on, and adds the anchors it set, so what it reads and writes follows its own rows and the
    time-to-live, not the age of the feed or the keys in it; a row that comes very late makes its batch read from there on.
    A batch that is repeated after a failure overwrites only what it wrote.

    By default no anchor expires and the result is that of the batch operator. With ``lateness_ms``,
    anchors older than the newest row by ``ttl_ms`` and ``lateness_ms`` together are left out, also
    when their keys send nothing any more, and unique rows whose anchor may be among them are flagged in
    ``maybe_expired``; cells older than that may be deleted at any time. Keys with ``hot_rows`` rows in a batch are spread, and
    so are rows without a key.
    """

    def __init__(
        self,
        state_path: str,
        key: str,
        ts: str,
        ttl_ms: int,
        order: Sequence[str] = ORDER,
        lateness_ms: int | None = None,
        hot_rows: int = HOT_ROWS,
        cell_ms: int | None = None,
    ):
        self.state_path, self.key, self.ts, self.ttl_ms = state_path.rstrip("/"), key, ts, ttl_ms
        self.order, self.lateness_ms, self.hot_rows = tuple(order), lateness_ms, hot_rows
        self.cell_ms = cell_ms or max(HOUR_MS, ttl_ms + 1)
        self.anchors_path = f"{self.state_path}/anchors"

    def _clock(self, batch_id: int) -> str:
        return f"{self.state_path}/newest/batch_id={batch_id}"

    def newest_ms(self, spark: SparkSession, batch_id: int) -> int | None:
        """The newest time of all rows up to a batch."""
        if batch_id < 0:
            return None
        return spark.read.schema("newest_ms bigint").parquet(self._clock(batch_id)).first()[0]

    def known(
        self, spark: SparkSession, key_type: T.DataType, batch_id: int, least_ms: int | None, newest_ms: int | None
    ) -> DataFrame | None:
        """(key, anchor_ms) rows set before a batch, those that can matter to rows from ``least_ms`` on, or all.

        A key may have several; the largest anchor counts.
        """
        if newest_ms is None:
            return None
        bounds = [b for b in (least_ms, newest_ms - self.lateness_ms if self.lateness_ms is not None else None) if b is not None]
        low = max(bounds) - self.ttl_ms if bounds else None
        longs = T.StructType.fromDDL("anchor_ms bigint, cell bigint, batch_id bigint")
        schema = T.StructType([T.StructField(self.key, key_type), *longs.fields])
        reader = spark.read.schema(schema).option("basePath", self.anchors_path)
        paths = self.anchors_path
        if low is not None:
            first, last = low // self.cell_ms, newest_ms // self.cell_ms
            if first > last:
                return None
            if last - first < NAMED_CELLS:
                paths = f"{self.anchors_path}/cell={{{','.join(map(str, range(first, last + 1)))}}}"
        try:
            rows = reader.parquet(paths)
        except AnalysisException as missing:  # no key had an anchor in these cells
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        rows = rows.filter(F.col("batch_id") < batch_id)
        if low is not None:
            rows = rows.filter((F.col("cell") >= low // self.cell_ms) & (F.col("anchor_ms") >= low))
        return rows.select(self.key, "anchor_ms")

    def live(self, spark: SparkSession, key_type: T.DataType, batch_id: int) -> DataFrame:
        """The anchors that count after a batch, one for each key."""
        rows = self.known(spark, key_type, batch_id + 1, None, self.newest_ms(spark, batch_id))
        if rows is None:
            empty = T.StructType([T.StructField(self.key, key_type), T.StructField("anchor_ms", T.LongType())])
            return spark.createDataFrame([], empty)
        return rows.groupBy(self.key).agg(F.max("anchor_ms").alias("anchor_ms"))

    def judged(self, batch: DataFrame, known: DataFrame | None) -> DataFrame:
        """The batch with ``is_duplicate`` and ``anchor_ms``, given the anchors (key, anchor_ms)."""
        hot_keys = find_hot_keys(batch, self.key, self.hot_rows)
        judge = partial(
            dedup_ttl,
            key=self.key,
            ts=self.ts,
            ttl_ms=self.ttl_ms,
            order=self.order,
            hot_keys=hot_keys,
        )
        if known is None:
            return judge(batch)
        known = known.select(self.key, F.col("anchor_ms").alias("_enter_ms"))
        # Rows without a key have nothing to look up, and would all meet in one task of the join.
        keyless = batch.filter(F.col(self.key).isNull())
        parts = [keyless.withColumn("_enter_ms", F.lit(None).cast("bigint"))]
        keyed = batch.filter(F.col(self.key).isNotNull())
        if hot_keys:
            # At most one anchor for each of the listed keys, so these are sent to every task.
            hot = is_hot(self.key, hot_keys)
            parts.append(
                keyed.filter(hot).join(F.broadcast(known.filter(hot)), self.key, "left")
            )
            keyed = keyed.filter(~hot)
        parts.append(keyed.join(known, self.key, "left"))
        entered = reduce(DataFrame.unionByName, parts)
        return judge(entered, enter="_enter_ms").select(
            *batch.columns, "is_duplicate", "anchor_ms"
        )

    def run(
        self, batch: DataFrame, batch_id: int, write: Callable[[DataFrame, int], None]
    ) -> None:
        """Judge one micro-batch, hand it to ``write`` and store the anchors it set."""
        key, spark = self.key, batch.sparkSession
        newest = self.newest_ms(spark, batch_id - 1)
        batch = batch.persist()
        # Rows without a key look nothing up and set no anchor.
        times = F.when(F.col(key).isNotNull(), F.col(self.ts))
        least, here = batch.agg(F.min(times), F.max(self.ts)).first()
        known = None
        if least is not None:
            known = self.known(spark, batch.schema[key].dataType, batch_id, least, newest)
        if known is not None:
            known = known.groupBy(key).agg(F.max("anchor_ms").alias("anchor_ms"))
        judged = self.judged(batch, known)
        if self.lateness_ms is not None:
            late = F.lit(False)
            if newest is not None:
                late = ~F.col("is_duplicate") & F.col("anchor_ms").isNotNull()
                late = late & (F.col(self.ts) < newest - self.lateness_ms)
            judged = judged.withColumn("maybe_expired", late)
        judged = judged.persist()
        try:
            write(judged, batch_id)
            set_here = judged.filter(~F.col("is_duplicate") & F.col("anchor_ms").isNotNull() & F.col(key).isNotNull())
            set_here = set_here.groupBy(key).agg(F.max("anchor_ms").alias("anchor_ms"))
            set_here = set_here.withColumns({
                "cell": F.floor(F.col("anchor_ms") / F.lit(self.cell_ms)), "batch_id": F.lit(batch_id).cast("bigint"),
            })
            out = set_here.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            out.partitionBy("cell", "batch_id").parquet(self.anchors_path)
            newest = max((t for t in (newest, here) if t is not None), default=None)
            clock = spark.createDataFrame([(newest,)], "newest_ms bigint").coalesce(1)
            clock.write.mode("overwrite").parquet(self._clock(batch_id))
        finally:
            judged.unpersist()
            batch.unpersist()
