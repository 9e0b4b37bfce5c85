import hashlib
import re
from collections import defaultdict
from pathlib import Path

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from streamfuse.llm import lines
from tests.llm.helpers import awkward, docs_of, empty


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\v\f\r"))


def plain(rows):
    holders = defaultdict(set)
    number = [-(2**63) if i is None else i for i, _ in rows]
    for i, (_, text) in zip(number, rows, strict=True):
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(i)
    out = []
    for i, (doc, text) in zip(number, rows, strict=True):
        every = (text or "").split("\n")
        kept = [x for x in every if len(holders[key(x)]) < 3 or max(holders[key(x)]) == i]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((doc, len(every), len(every) - len(kept), digest))
    return sorted(map(str, out))


def got_of(docs):
    return sorted(str(tuple(r)) for r in lines.line_digest(docs).collect())


LONG = ["a shared line of some length", "Éa line with capitals BEYOND ascii", "éa line with capitals beyond ascii"]
LINE = st.sampled_from([*LONG, " \t" + LONG[0].upper() + "\v ", "short", "", "x" * 19, "x" * 20])
TEXT = st.one_of(st.none(), st.lists(LINE, max_size=6).map("\n".join))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)), TEXT), min_size=1, max_size=14))
def test_equal_to_plain_rule(spark, rows):
    assert got_of(docs_of(spark, rows)) == plain(rows)


def test_awkward_rows_and_empty_table(spark):
    docs, rows = awkward(spark)
    assert got_of(docs) == plain([r[:2] for r in rows])
    assert lines.line_digest(empty(spark)).count() == 0


def test_texts_are_returned_and_other_columns_stay(spark):
    docs, rows = awkward(spark)
    assert lines.dedup_lines(docs.drop("n_lines")).columns[-2:] == ["n_lines", "n_dropped"]
    out = lines.dedup_lines(docs, counts=False)
    assert out.columns == docs.columns
    kept = {(r.doc_id, r.source): r.text for r in out.collect()}
    assert kept[5, "a"] == rows[8][1] and kept[4, "a"] == "third" and kept[2, None] is None


def test_runs_hold_every_key_once_and_are_compacted(spark):
    runs = lines.LineRuns(spark, fanout=2)
    for batch in range(5):
        rows = [(batch * 10 + d, h, 0) for d in range(3) for h in (batch, 100 + d, 500)]
        runs.add(spark.createDataFrame(rows, "doc long, h1 long, h2 int"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    held = [r.h1 for run in runs.runs() for r in run.collect()]
    assert sorted(held) == [0, 1, 2, 3, 4, 100, 101, 102, 500]
    shared = {r.h1: r.last_doc for r in runs.shared(3).collect()}
    assert shared == {0: 2, 1: 12, 2: 22, 3: 32, 4: 42, 100: 40, 101: 41, 102: 42, 500: 42}
    assert {r.h1 for r in runs.shared(6).collect()} == {500}


def test_no_python_on_the_way(spark):
    plan = lines.line_digest(docs_of(spark, [(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="test tables are not here")
def test_sql_says_the_same(spark):
    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    frame = lines.line_digest(spark.read.parquet(f"{sf}/documents.parquet"))
    result = db.execute(f"SELECT {', '.join(frame.columns)} FROM ({lines.ORACLE})").fetchall()
    assert sorted(map(tuple, frame.collect())) == sorted(result)
