import math
import random
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from streamfuse.llm import topk

SCHEMA = "vec_id long, embedding array<float>"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def plain(rows, k=20):
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for i, q in {(i, tuple(v)) for i, v in whole if i % 20 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in whole if j != i)
        out += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def got(spark, rows):
    return sorted(map(tuple, topk.every_twentieth(spark.createDataFrame(rows, SCHEMA)).collect()))


@pytest.mark.parametrize("block", [8, 4096])
def test_equal_to_a_plain_search(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", block // 4)
    monkeypatch.setattr(topk, "QUERY_TILE", 2)
    draw = random.Random(block)
    # Few different values, so that ties are common and many weights are zero.
    rows = [(i, [draw.choice([0.0, 0.01, 0.02, -0.02, 0.5]) for _ in range(6)]) for i in range(130)]
    draw.shuffle(rows)
    assert got(spark, rows) == plain(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, [1.0]), (20, [2.0, 1.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]),
        (4, [inf, 1.0]), (None, [1.0, 1.0]), (5, []), (6, [1.0, 1.0, 1.0]), (40, None), (7, [1.0, 1.0]), (7, [1.0, 1.0]),
    ]
    assert got(spark, rows) == plain(rows)
    assert got(spark, [(0, [1.0])]) == []
    assert topk.every_twentieth(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_weights_are_summed_in_64_bits(spark):
    rows = [(i, [1e5 + i, -1e5, 3e4]) for i in range(25)]
    assert got(spark, rows) == plain(rows)


def test_finite_vectors_all_take_part(spark):
    rows = [(0, [3e6, 1.0]), (2, [3e6, 0.0]), (20, [-2.0**21, 0.5]), (3, [1.0, 2.0])]
    rows += [(40, [2.0**20, 1.0]), (41, [2.0**26, -1.0])]
    found = got(spark, rows)
    assert found == plain(rows) and {r[0] for r in found} == {0, 20, 40} and {r[2] for r in found} == {i for i, _ in rows}
    # Sums beyond 64 bits that cancel out, and one that doesn't.
    huge = [(0, [2.0**40, 2.0**40]), (1, [2.0**30, -(2.0**30)]), (2, [2.0**29, -(2.0**29)])]
    assert got(spark, huge) == plain(huge) == [(0, 1, 1, 0), (0, 2, 2, 0)]
    with pytest.raises(Exception, match="does not fit"):
        got(spark, [(0, [2.0**40]), (1, [2.0**30])])


def test_floor_and_not_truncation(spark):
    frame = spark.createDataFrame([(1, [-0.01, 0.01, -1.0])], SCHEMA)
    (r,) = frame.select(topk.whole_numbers(F.col("embedding")).alias("v")).collect()
    assert list(r.v) == [-1.0, 0.0, -64.0]


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="test tables are not here")
def test_sql_says_the_same(spark):
    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    frame = topk.every_twentieth(spark.read.parquet(f"{sf}/embeddings.parquet"))
    result = db.execute(f"SELECT {', '.join(frame.columns)} FROM ({topk.ORACLE})").fetchall()
    assert sorted(map(tuple, frame.collect())) == sorted(result)
