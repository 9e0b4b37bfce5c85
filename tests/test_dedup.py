import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from streamfuse.operators import anchors, dedup
from tests.folds import fold_rows

SCHEMA = "signature binary, received_ms bigint, ordinal int, seq bigint"
BASE = 1_000_000_000


def rows_of(seed, n=3000, keys=40, span=4000):
    """Many keys, one of them a third of all rows, with ties in time and copies at one time."""
    r = random.Random(seed)
    out = []
    for seq in range(n):
        k = 0 if r.random() < 0.34 else r.randrange(keys)
        key = None if k == 7 else b"" if k == 8 else f"k{k}".encode()
        out.append((key, BASE + r.randrange(span), r.randrange(1, 5), seq))
    return out


def judged_by(frame):
    got = {
        (None if r.signature is None else bytes(r.signature), r.received_ms, r.ordinal, r.seq): (
            r.is_duplicate,
            r.anchor_ms,
        )
        for r in frame.collect()
    }
    return got


@pytest.mark.parametrize("ttl", [0, 1, 60, 700])
@pytest.mark.parametrize("way", ["window", "blocks", "mixed", "salted", "packed"])
def test_same_as_the_plain_fold(spark, monkeypatch, ttl, way):
    if way == "salted":
        monkeypatch.setattr(dedup, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(dedup, "SALTS", 5)
        monkeypatch.setattr(dedup, "CELL_ROWS", 20)
    if way == "packed":
        monkeypatch.setattr(dedup, "BLOCK_VALUES", 0)
        monkeypatch.setattr(dedup, "PACKED_MS", 64)
    rows = rows_of(ttl)
    frame = spark.createDataFrame(rows, SCHEMA)
    hashes = [r.h for r in frame.select(F.xxhash64("signature").alias("h")).distinct().collect()]
    hot = {"window": [], "mixed": hashes[::2]}.get(way, hashes)
    got = judged_by(
        dedup.dedup_ttl(
            frame,
            "signature",
            "received_ms",
            ttl,
            hot_keys=hot,
            block_ms=None if way == "packed" else 3 * (ttl + 1),
        )
    )
    assert got == fold_rows(rows, ttl)


def test_limits_of_the_time_to_live(spark):
    at = [(b"a", 0), (b"a", 60_000), (b"b", 0), (b"b", 60_001), (b"c", 5), (b"c", 5)]
    rows = [(k, BASE + t, 2 - i % 2, i) for i, (k, t) in enumerate(at)]
    got = fold_rows(rows, 60_000)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert judged_by(dedup.dedup_ttl(frame, "signature", "received_ms", 60_000)) == got
    unique = {(r[0], r[1] - BASE, r[2]) for r, (repeat, _) in got.items() if not repeat}
    # Exactly the time-to-live is a duplicate, one more is not; at one time the lower ordinal wins.
    assert unique == {(b"a", 0, 2), (b"b", 0, 2), (b"b", 60_001, 1), (b"c", 5, 1)}


def test_rows_without_a_key_are_unique(spark):
    rows = [(None, BASE, 1, i) for i in range(50)] + [(b"", BASE, 1, 99), (b"", BASE + 1, 1, 100)]
    got = judged_by(dedup.dedup_ttl(spark.createDataFrame(rows, SCHEMA), "signature", "received_ms", 9))
    assert sum(not d for d, _ in got.values()) == 51
    assert got[(b"", BASE + 1, 1, 100)] == (True, BASE)


@pytest.mark.parametrize("hot", [False, True])
def test_anchors_brought_along_judge_later_and_older_rows(spark, hot):
    known = {f"k{k}".encode(): BASE + 50 * k for k in range(0, 40, 3)}
    rows = [r for r in rows_of(5) if r[0] is not None]
    frame = spark.createDataFrame(
        [(*r, known.get(r[0])) for r in rows], SCHEMA + ", enter bigint"
    )
    hashes = [r.h for r in frame.select(F.xxhash64("signature").alias("h")).distinct().collect()]
    got = judged_by(
        dedup.dedup_ttl(
            frame,
            "signature",
            "received_ms",
            60,
            hot_keys=hashes if hot else [],
            block_ms=200,
            enter="enter",
        )
    )
    assert got == fold_rows(rows, 60, known)


def test_hot_keys_are_found_by_count(spark):
    rows = rows_of(1, n=4000)
    frame = spark.createDataFrame(rows, SCHEMA)
    found = dedup.find_hot_keys(frame, "signature", min_rows=1000)
    want = spark.range(1).select(F.xxhash64(F.lit(b"k0"))).first()[0]
    assert found == [want]


def test_payload_stays_out_of_python_and_rows_shuffle_once(spark):
    frame = spark.createDataFrame(rows_of(1, 200), SCHEMA).withColumn("payload", F.lit("x"))
    plan = dedup.dedup_ttl(frame, "signature", "received_ms", 60, hot_keys=[])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1
    assert "fold(received_ms" in text


def test_occupancy_and_live_keys(spark):
    rows = [(b"a", 0, 1, 1), (b"b", 10, 1, 2), (b"a", 30, 2, 3), (b"a", 200, 1, 4)]
    frame = spark.createDataFrame([(k, BASE + t, o, s) for k, t, o, s in rows], SCHEMA)
    judged = dedup.dedup_ttl(frame, "signature", "received_ms", 60)
    sizes = {
        r.tick_ms - BASE: (r["size"], r.cap_would_act)
        for r in dedup.dedup_occupancy(judged, 60, 2, 20).collect()
    }
    assert sizes[0] == (1, False) and sizes[20] == (2, True) and sizes[60] == (2, True)
    assert sizes[80] == (0, False) and sizes[200] == (1, False) and sizes[280] == (0, False)
    live = dedup.live_keys(judged, "signature", BASE + 70, 60).collect()
    assert [(bytes(r.signature), r.first_seen_ms - BASE) for r in live] == [(b"b", 10)]


def test_rows_without_a_time_are_unique_and_judge_nothing(spark):
    rows = [(b"a", None, 1, 1), (b"a", BASE, 1, 2), (b"a", BASE + 5, 1, 3), (b"a", None, 2, 4), (None, None, 1, 5)]
    frame = spark.createDataFrame(rows, SCHEMA)
    hot = [r.h for r in frame.select(F.xxhash64("signature").alias("h")).distinct().collect()]
    for hot_keys in ([], hot):
        judged = dedup.dedup_ttl(frame, "signature", "received_ms", 60, hot_keys=hot_keys, block_ms=200)
        got = {r.seq: (r.is_duplicate, r.anchor_ms) for r in judged.collect()}
        assert got == {
            1: (False, None), 2: (False, BASE), 3: (True, BASE), 4: (False, None), 5: (False, None)
        }


def test_more_hot_keys_than_a_sketch_lists_are_found(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SKETCHES", 2)
    monkeypatch.setattr(dedup, "LISTED", 3)
    monkeypatch.setattr(dedup, "TRACKED", 100)
    frame = spark.range(4000).select((F.col("id") % 40).alias("k"))
    assert len(dedup.find_hot_keys(frame, "k", 50)) == 40


def test_a_day_long_time_to_live_of_a_dense_key_is_packed(spark):
    day = 86_400_000
    frame = spark.range(0, 3 * day, 997).select(
        F.lit(b"hot").alias("signature"), (F.col("id") + BASE * 1000).alias("received_ms"), F.lit(1).alias("ordinal"), F.col("id").alias("seq")
    )
    hot = [frame.select(F.xxhash64("signature")).first()[0]]
    judged = dedup.dedup_ttl(frame, "signature", "received_ms", day, hot_keys=hot)
    anchors = sorted(r.received_ms - BASE * 1000 for r in judged.filter("not is_duplicate").collect())
    first = 0
    want = [first]
    while (first := -(-(first + day + 1) // 997) * 997) < 3 * day:
        want.append(first)
    assert anchors == want


def test_a_hot_key_with_a_long_time_to_live_reads_a_column_a_task(spark, monkeypatch):
    """A year of one key in bursts and gaps; the fold's anchors, and no task has more than a column of the times."""
    day, draw = 86_400_000, random.Random(4)
    times, at = [], BASE * 1000
    while at < BASE * 1000 + 365 * day:
        at += draw.choice([1, 7, 40_000, 3_000_000, 9_000_000, draw.randrange(3 * day) if draw.random() < 0.01 else 50_000_000])
        times.append(at)
    rows = [(b"hot", t, 1, i) for i, t in enumerate(times)]
    frame = spark.createDataFrame(rows, SCHEMA)
    hot = [frame.select(F.xxhash64("signature")).first()[0]]
    judged = dedup.dedup_ttl(frame, "signature", "received_ms", day, hot_keys=hot)
    assert judged_by(judged) == fold_rows(rows, day)


def test_columns_of_times():
    draw = random.Random(1)
    for _ in range(400):
        ttl, width = draw.randrange(1, 60), 8
        times = sorted({draw.randrange(draw.choice([60, 400, 3000])) for _ in range(draw.randrange(1, 120))})
        period = ttl + 1
        columns = -(-period // width)
        cells = {}
        for t in times:
            cells.setdefault((t // period, t % period // width), []).append(t % period % width)
        packed = {k: anchors.pack_times(np.array(v), width) for k, v in cells.items()}
        exits = {}
        for c in range(columns):
            own = sorted(r for r, x in packed if x == c)
            left = anchors.column_exits(np.array(own, dtype=np.int64), [packed[r, c] for r in own], width)
            exits |= {(r, c): int(e) for r, e in zip(own, left, strict=True)}
        order = sorted(packed)
        batch = [pa.array([k[i] for k in order], pa.int64()) for i in (0, 1)]
        batch += [pa.array([exits[k] for k in order], pa.int64()), pa.array([i == 0 for i in range(len(order))])]
        entered = dict(zip(order, next(anchors.chain_columns([tuple(batch)], columns)).to_pylist(), strict=True))
        found = []
        for c in range(columns):
            own = sorted(r for r, x in packed if x == c)
            for i, place in anchors.column_anchors(
                np.array(own, dtype=np.int64), [packed[r, c] for r in own], [entered[r, c] for r in own], width
            ):
                found.append(own[i] * period + c * width + place)
        want = []
        for t in times:
            if not want or t > want[-1] + ttl:
                want.append(t)
        assert sorted(found) == want
