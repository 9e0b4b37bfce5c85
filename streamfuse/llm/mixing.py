"""Mixing sources to target weights by Pfair scheduling.

Every source's documents are cut into blocks of equal size, and one block is served at a time. A source with the
share w of the slots must have its block i (from 0) served in the window from floor(i / w), its release, to
ceil((i + 1) / w), its deadline. Serving the released block with the earliest deadline meets all of them,
so at any time no source is a whole block ahead of its target or behind it.

Shares are whole slots of a period of 2^50 slots, so weights hold to the last bits of a double and windows are
exact in whole numbers. The driver plays the schedule through once and keeps only how many blocks of each source are
served at every 65,536th slot; from these states tasks play the stretches in parallel and tell the slot of
each block. When a source ends, a new phase begins: the others go on with their shares of what is left. All
documents are kept.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamfuse.llm.common import neutral, original, whole
from streamfuse.session import new_work_dir

BLOCK_DOCS = 16
PERIOD = 1 << 50
# Slots that a task plays from one state.
STRETCH = 65_536
# Numbers in the states that the driver holds before it writes them to the shared folder.
HELD_NUMBERS = 2_000_000
# Rows are ranked inside cells (source, salt).
MIN_SALTS = 64
SALT_ROWS = 5_000
TEMPERATURE = 0.5


def period_of(weights: Mapping[str, float], period: int = PERIOD) -> dict[str, int]:
    """Whole slots of a period for each source, one at least."""
    total = sum(weights.values())
    if any(w <= 0 for w in weights.values()) or not total:
        raise ValueError("weights must be positive")
    return {s: max(1, round(period * w / total)) for s, w in weights.items()}


def window(i: int, slots: int, period: int) -> tuple[int, int]:
    """Release and deadline of block i of a source with ``slots`` slots of a period."""
    return i * period // slots, -(-(i + 1) * period // slots)


def served(
    slots: Mapping[str, int], done: Mapping[str, int], at: int = 0
) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block, slot, release, deadline) in order of the slots, without end, from the slot ``at`` on
    when ``done`` blocks of each source have been served."""
    period = sum(slots.values())
    waiting: list[tuple[int, str, int, int]] = []  # (release, source, block, deadline)
    ready: list[tuple[int, str, int, int]] = []  # (deadline, source, block, release)
    for s in slots:
        release, deadline = window(done[s], slots[s], period)
        waiting.append((release, s, done[s], deadline))
    heapq.heapify(waiting)
    t = at
    while True:
        while waiting and waiting[0][0] <= t:
            release, s, i, deadline = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, s, i, release))
        deadline, s, i, release = heapq.heappop(ready)
        yield s, i, t, release, deadline
        release, deadline = window(i + 1, slots[s], period)
        heapq.heappush(waiting, (release, s, i + 1, deadline))
        t += 1


def earliest_deadline_first(slots: Mapping[str, int]) -> list[tuple[str, int, int, int, int]]:
    """One period: (source, block, slot, release, deadline) in order of the slots."""
    return list(islice(served(slots, dict.fromkeys(slots, 0)), sum(slots.values())))


def stretches(blocks: Mapping[str, int], slots: Mapping[str, int]) -> Iterator[tuple]:
    """(first slot of the phase, slot in the phase, slots, sources, their shares, blocks before the phase, blocks
    served in it) for every stretch; a phase ends with the last block of a source."""
    before = dict.fromkeys(blocks, 0)
    active = sorted(s for s in blocks if blocks[s])
    base = 0
    while active:
        shares = {s: slots[s] for s in active}
        done = dict.fromkeys(active, 0)
        offsets = [before[s] for s in active]
        start, t, state = 0, 0, list(done.values())
        for s, _, t, _, _ in served(shares, done):
            done[s] += 1
            ends = before[s] + done[s] == blocks[s]
            if ends or t + 1 - start == STRETCH:
                yield base, start, t + 1 - start, active, list(shares.values()), offsets, state
                start, state = t + 1, list(done.values())
            if ends:
                break
        base += t + 1
        for s in active:
            before[s] += done[s]
        active = [s for s in active if before[s] < blocks[s]]


STRETCHES = (
    "base bigint, at bigint, n bigint, sources array<string>, shares array<bigint>,"
    " before array<bigint>, done array<bigint>"
)
TURNS = "_s string, block bigint, slot bigint, release bigint, deadline bigint"


def states_of(spark: SparkSession, blocks: Mapping[str, int], slots: Mapping[str, int]) -> DataFrame:
    """The stretches as a table; where there are many, they are written as they are made, so the driver holds a few."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, held, numbers = None, [], 0
    for stretch in stretches(blocks, slots):
        held.append(stretch)
        numbers += 4 * len(stretch[3])
        if numbers > HELD_NUMBERS:
            path = path or new_work_dir(spark, "mixing-states")
            spark.createDataFrame(held, STRETCHES).write.mode("append").parquet(path)
            held, numbers = [], 0
    rest = spark.createDataFrame(held, STRETCHES)
    if path is None:
        return rest.repartition(max(1, min(len(held), parts)))
    return spark.read.schema(STRETCHES).parquet(path).unionByName(rest).repartition(parts)


def turns(states: DataFrame) -> DataFrame:
    """One row for each block: its slot, release and deadline."""

    def of_partition(batches):
        for batch in batches:
            for r in batch.to_pylist():
                shares = dict(zip(r["sources"], r["shares"], strict=True))
                before = dict(zip(r["sources"], r["before"], strict=True))
                done = dict(zip(r["sources"], r["done"], strict=True))
                base = r["base"]
                rows = [
                    (s, before[s] + i, base + t, base + release, base + deadline)
                    for s, i, t, release, deadline in islice(served(shares, done, r["at"]), r["n"])
                ]
                columns = list(zip(*rows, strict=True))
                arrays = [pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]]
                yield pa.RecordBatch.from_arrays(arrays, ["_s", "block", "slot", "release", "deadline"])

    return states.mapInArrow(of_partition, TURNS)


def source_key(column: str = "source") -> Column:
    """A null source is a source of its own, unlike any text."""
    return F.coalesce(F.concat(F.lit("s"), F.col(column)), F.lit("null"))


def scheduled(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    tie: Column | None = None,
    block_docs: int = BLOCK_DOCS,
    period: int = PERIOD,
) -> DataFrame:
    """Add ``block``, ``release``, ``deadline``, ``slot`` and ``rank`` to every row.

    The mixed order is (slot, rank): ``slot`` numbers the turns of the schedule, ``rank`` the documents of a source.
    ``weights`` names target weights by source; without them a source counts with the square root of
    its documents. Sources that ``weights`` doesn't name get its smallest weight. Inside a source the order
    is by hash of doc_id. Repeated rows take part like others; equal ones may change places with each other. An
    empty table gives an empty one.
    """
    names = ["block", "release", "deadline", "slot", "rank"]
    tie = F.xxhash64(whole("text")) if tie is None else tie
    total = docs.count()
    salts = max(MIN_SALTS, -(-total // SALT_ROWS))
    keyed = docs.withColumns({"_s": source_key(), "_h": F.xxhash64("doc_id", F.lit(5))})
    keyed = keyed.withColumns({"_tie": tie, "_salt": F.pmod("_h", F.lit(salts))})

    counts = keyed.groupBy("_s", "_salt").agg(F.count("*").alias("_n"))
    sizes = {r["_s"]: r["n"] for r in counts.groupBy("_s").agg(F.sum("_n").alias("n")).collect()}
    if weights is None:
        target = {s: n**TEMPERATURE for s, n in sizes.items()}
    else:
        named = {f"s{s}" if s is not None else "null": w for s, w in weights.items()}
        target = {s: named.get(s, min(named.values())) for s in sizes}
    slots = period_of(target, max(period, len(target))) if target else {}
    blocks = {s: -(-n // block_docs) for s, n in sizes.items()}
    spark = docs.sparkSession
    plan = turns(states_of(spark, blocks, slots))

    # The number of a row in its source: rows of earlier cells, and its number in its own cell.
    before = Window.partitionBy("_s").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.select(
        "_s", "_salt", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    # Each cell gets the turns of its blocks, in order: an array of bounded length.
    last = F.floor((F.col("_before") + F.col("_n") - 1) / block_docs)
    cells = cells.withColumn("_first", F.floor(F.col("_before") / block_docs))
    wanted = cells.select("_s", "_salt", F.explode(F.sequence("_first", last)).alias("block"))
    turn = F.struct("block", "slot", "release", "deadline")
    dealt = wanted.join(plan, ["_s", "block"]).groupBy("_s", "_salt")
    dealt = dealt.agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    cells = cells.join(dealt, ["_s", "_salt"]).select("_s", "_salt", "_before", "_first", "_turns")

    in_cell = Window.partitionBy("_s", "_salt").orderBy("_h", "doc_id", "_tie")
    ranked = keyed.withColumn("_row", F.row_number().over(in_cell) - 1).join(cells, ["_s", "_salt"])
    ranked = ranked.withColumn("rank", F.col("_before") + F.col("_row"))
    ranked = ranked.withColumn("block", F.floor(F.col("rank") / block_docs))
    own = F.get("_turns", (F.col("block") - F.col("_first")).cast("int"))
    placed = ranked.withColumn("_turn", own).withColumns(
        {n: F.col(f"_turn.{n}") for n in ("slot", "release", "deadline")}
    )
    return placed.select(*docs.columns, *names)


def mix_schedule(docs: DataFrame) -> DataFrame:
    """The place of every document in the mixed order."""
    slim = docs.select("doc_id", "source", F.xxhash64(whole("text")).alias("_text_hash"))
    made = scheduled(slim, tie=F.col("_text_hash"))
    return made.drop("_text_hash")


def mixed(docs: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """All documents, sorted in the mixed order."""
    order = scheduled(neutral(docs, ["doc_id", "source", "text"]), weights).orderBy("slot", "rank")
    return order.select(*original(docs))
