import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))
import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")
NAMES = sorted(entry.QUERIES)


@pytest.fixture(scope="module")
def db():
    db = duckdb.connect()
    for t in check.TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return db


@pytest.mark.filterwarnings("ignore:.*skipped")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, db, name):
    frame = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in frame.collect()]
    assert rows
    result = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    got = check.canonical(frame.columns, rows)
    assert got == check.canonical(columns, result.fetchall())


def test_flagship(spark):
    frame = entry.entry(spark)
    assert frame.columns[0] == "window_start_ms" and frame.count() > 0


def test_rendered_texts_equal_digit_by_digit(spark):
    from tests.test_functions import plain

    rows = entry.queries()["p4_render_binary"](spark, SF).collect()
    raw = {
        (r.ordinal, r.seq): bytes.fromhex(r.signature)
        for r in entry.queries()["f1_valid_signature"](spark, SF).collect()
    }
    assert len(rows) == len([v for v in raw.values() if v is not None])
    for r in rows:
        value = raw[r.ordinal, r.seq]
        assert r.signature == plain(value) and r["head"] == plain(value[:6])
        assert r.signatures == f"{plain(value)},{plain(value[:6])}"


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.ORACLE)
