import random

import pytest
from pyspark.sql import functions as F

from streamfuse.operators import counts, ordered

SCHEMA = "client string, ts bigint, seq bigint, v bigint"
ORDER = ("ts", "seq")


def rows_of(seed, n=2000):
    """A third of the rows belongs to one client, and another third to one millisecond."""
    r = random.Random(seed)
    return [
        (
            "a" if r.random() < 0.34 else r.choice("bcde"),
            500 if r.random() < 0.34 else r.randrange(1000),
            seq,
            r.choice([None, 1, 2, 3]),
        )
        for seq in range(n)
    ]


def expected(rows, by_client):
    out, groups = {}, {}
    for row in sorted(rows, key=lambda r: r[1:3]):
        groups.setdefault(row[0] if by_client else None, []).append(row)
    for group in groups.values():
        total, latest = 0, None
        for i, (_, ts, seq, v) in enumerate(group):
            previous = latest
            total, latest = total + (v or 0), v if v is not None else latest
            later = next((g[3] for g in group[i + 1 :] if g[3] is not None), None)
            out[(ts, seq)] = (total, latest, previous, later)
    return out


@pytest.mark.parametrize("by_client", [True, False])
@pytest.mark.parametrize("target", [50, 700, None])
def test_scan_equals_the_plain_loop(spark, by_client, target):
    rows = rows_of(3)
    frame = spark.createDataFrame(rows, SCHEMA)
    points = [] if target is None else ordered.split_points(frame, ORDER, target, min_blocks=1)
    assert target is None or len(points) >= len(rows) // target - 1
    v = F.col("v")
    got = ordered.scan(
        frame,
        ORDER,
        ["client"] if by_client else [],
        points=points,
        sums={"total": v},
        latest={"latest": v},
        previous={"previous": v},
        following={"later": v},
    )
    assert got.columns == ["client", "ts", "seq", "v", "total", "latest", "previous", "later"]
    found = {(r.ts, r.seq): (r.total, r.latest, r.previous, r.later) for r in got.collect()}
    assert found == expected(rows, by_client)


def test_a_burst_at_one_millisecond_is_cut(spark):
    frame = spark.createDataFrame([("a", 7, i, 1) for i in range(5000)], SCHEMA)
    points = ordered.split_points(frame, ORDER, target_rows=500)
    sizes = ordered.with_block(frame, ORDER, points).groupBy(ordered.BLOCK).count().collect()
    assert len(sizes) >= 10 and max(r["count"] for r in sizes) < 1500


def test_numbers_and_rates(spark):
    rows = [(BASE, 1, i, i % 3 == 0) for i, BASE in enumerate(range(100, 125))]
    frame = spark.createDataFrame(rows, "received_ms bigint, ordinal int, seq bigint, is_duplicate boolean")
    order = ("received_ms", "ordinal", "seq")
    got = counts.running_rate(frame, order, 10).orderBy("n_messages").collect()
    assert [(r.n_messages, r.n_duplicates, r.unique_share) for r in got] == [
        (10, 4, 60.0),
        (20, 7, 65.0),
    ]
    numbered = counts.sequence_numbers(frame, order, ["is_duplicate"]).collect()
    for flag in (True, False):
        got = [r.number for r in sorted(numbered, key=lambda r: r.seq) if r.is_duplicate == flag]
        assert got == list(range(1, len(got) + 1))
    first = counts.first_messages(frame, order, 3).collect()
    assert [r.seq for r in first] == [0, 1, 2]


@pytest.mark.parametrize(
    ("part", "whole", "want"), [(0, 0, 0), (1, 2, 50), (1, 8, 13), (1, 3, 33), (2, 3, 67), (5, 5, 100)]
)
def test_shares_round_half_up(spark, part, whole, want):
    row = spark.range(1).select(
        counts.duplicate_pct(F.lit(part).cast("long"), F.lit(whole).cast("long")).alias("d"),
        counts.unique_pct(F.lit(part).cast("long"), F.lit(whole).cast("long")).alias("u"),
    )
    assert tuple(row.first()) == (want, want)


def test_throughput(spark):
    frame = spark.range(1000).select((F.col("id") * 10).alias("received_ms"))
    row = counts.throughput(frame, 0, 3000).first()
    assert (row.n_messages, row.messages_per_second) == (301, 100.3)
