import random

import pytest
from pyspark.sql import functions as F

from streamfuse.config import PoolOptions, SubscribeRequest
from streamfuse.operators import subscriptions as subs

SCHEMA = "id int, account_keys array<string>, is_vote boolean, failed boolean"
ROWS = [
    (1, ["a", "b"], False, False),
    (2, ["b", "c"], True, False),
    (3, [], None, True),
    (4, None, None, None),
    (5, ["a", "c", None], True, True),
]


@pytest.mark.parametrize(
    ("arguments", "ids"),
    [
        ({}, [1, 2, 3, 4, 5]),
        ({"include": ["a"]}, [1, 5]),
        ({"include": ["a", "c"]}, [1, 2, 5]),
        ({"include": ["zz"]}, []),
        ({"exclude": ["a"]}, [2, 3, 4]),
        ({"required": ["a", "c"]}, [5]),
        ({"required": ["b"]}, [1, 2]),
        ({"vote": True}, [2, 5]),
        ({"vote": False}, [1, 3, 4]),
        ({"failed": False}, [1, 2, 4]),
        ({"failed": True}, [1, 2, 3, 4, 5]),
        ({"include": ["b"], "exclude": ["a"], "vote": True, "failed": False}, [2]),
    ],
)
def test_transaction_filter(spark, arguments, ids):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    predicate = subs.transaction_filter(**arguments)
    assert sorted(r.id for r in frame.filter(predicate).collect()) == ids
    # Never null, so the opposite is exactly the rest.
    assert frame.filter(~predicate).count() == len(ROWS) - len(ids)


def test_named_filters_list_what_matched(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    out = subs.named_filters(
        frame, {"votes": subs.transaction_filter(vote=True), "a": subs.transaction_filter(["a"])}
    )
    assert {r.id: r.filters for r in out.collect()} == {1: ["a"], 2: ["votes"], 5: ["votes", "a"]}


def test_account_filter_by_list_and_by_table(spark):
    frame = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, owner string")
    assert [r.id for r in frame.filter(subs.account_filter(["x"])).collect()] == [1]
    assert frame.filter(subs.account_filter([])).count() == 3
    owners = spark.createDataFrame([("y",), ("y",), (None,)], "owner string")
    assert [r.id for r in subs.accounts_of(frame, owners).collect()] == [2]


@pytest.mark.parametrize(
    ("level", "kept"),
    [("processed", 4), ("CONFIRMED", 3), ("finalized", 1), (None, 3)],
)
def test_commitment(spark, level, kept):
    frame = spark.createDataFrame(
        [("processed",), ("confirmed",), ("CONFIRMED",), ("finalized",), (None,), ("odd",)],
        "commitment string",
    )
    predicate = subs.commitment_at_least(level) if level else subs.commitment_at_least()
    assert frame.filter(predicate).count() == kept
    assert frame.filter(~predicate).count() == 6 - kept
    ranks = frame.select(subs.commitment_rank(F.col("commitment"))).collect()
    assert [r[0] for r in ranks] == [0, 1, 1, 2, None, None]


def test_subscribe_guards_each_filter_by_kind(spark):
    rows = [
        (1, "transaction", ["p"], False, False, "x", "confirmed"),
        (2, "other", ["p"], False, False, "x", "confirmed"),
        (3, "other", ["p"], False, False, "y", "confirmed"),
        (4, "transaction", ["q"], False, False, "x", "confirmed"),
        (5, "pong", ["p"], False, False, "x", "confirmed"),
        (6, "transaction", ["p"], False, False, "x", "processed"),
    ]
    frame = spark.createDataFrame(
        rows,
        "id int, kind string, account_keys array<string>, is_vote boolean, failed boolean,"
        " owner string, commitment string",
    )
    request = {
        "accounts": {"w": {"owner": ["x"], "filters": []}},
        "transactions": {"t": {"accountInclude": ["p"], "vote": False, "failed": False}},
        "blocks": None,
    }
    assert [r.id for r in subs.subscribe(frame, request).collect()] == [1, 2]
    request["commitment"] = "processed"
    assert [r.id for r in subs.subscribe(frame, request).collect()] == [1, 2, 6]
    assert subs.subscribe(frame, {}).count() == 0
    assert subs.subscribe(frame, SubscribeRequest.from_dict({"accounts": None})).count() == 0


def test_flags_reach_the_file_scan(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t")).withColumn("slot", F.lit(1))
    plan = frame.filter((F.col("id") > 2) & subs.transaction_filter(["a"], vote=False)).select("id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,2)]" in text
    assert "failed" not in text.split("ReadSchema")[1]


@pytest.mark.parametrize(
    ("stale", "interval"), [(120_000, 12_000), (5_000, 1_000), (10_000_000, 60_000), (0, 1_000)]
)
def test_check_interval_is_held_between_its_bounds(stale, interval):
    assert PoolOptions(stale_timeout_ms=stale).stale_check_interval_ms == interval


def test_defaults():
    options = PoolOptions()
    assert (options.dedup_ttl_ms, options.max_cache_size) == (60_000, 10_000)
    assert (options.initial_retry_delay_ms, options.max_retry_delay_ms) == (500, 30_000)


@pytest.mark.parametrize(
    "request_",
    [
        {"accounts": {"w": {"owner": [], "filters": [{"datasize": 165}]}}},
        {"transactions": {"t": {"signature": "abc"}}},
        {"slots": {"s": {}}},
        {"accountsDataSlice": [{"offset": 0}]},
    ],
)
def test_parts_that_nothing_evaluates_are_refused(request_):
    with pytest.raises(ValueError, match="not evaluated"):
        SubscribeRequest.from_dict(request_)


def test_empty_parts_are_no_constraint():
    empty = {"slots": {}, "blocks": None, "entry": [], "accounts": {"w": {"owner": ["x"], "filters": []}}}
    assert SubscribeRequest.from_dict(empty).accounts["w"].owner == ("x",)


def test_an_account_filter_without_owners_takes_account_updates_only(spark):
    rows = [(1, "other", "x"), (2, "other", None), (3, "transaction", "x")]
    frame = spark.createDataFrame(rows, "id int, kind string, owner string")
    assert [r.id for r in subs.subscribe(frame, {"accounts": {"w": {"owner": []}}}).collect()] == [1]


def test_a_requested_commitment_needs_its_column(spark):
    frame = spark.createDataFrame([(1, "other", "x")], "id int, kind string, owner string")
    with pytest.raises(ValueError, match="commitment"):
        subs.subscribe(frame, {"accounts": {"w": {}}, "commitment": "finalized"})


def account_table(spark, accounts):
    return spark.createDataFrame([(a,) for a in accounts], "account string")


def test_lists_as_tables_equal_lists(spark):
    draw = random.Random(5)
    rows = []
    for i in range(400):
        keys = draw.choice([None, [], [draw.choice("abcdefgh") for _ in range(draw.randrange(1, 6))]])
        rows.append((i % 7, i, keys, draw.choice([True, False, None]), draw.choice([True, False, None])))
    df = spark.createDataFrame(rows, "part int, seq long, account_keys array<string>, is_vote boolean, failed boolean")
    for _ in range(12):
        lists = {
            kind: draw.choice([None, [], draw.sample("abcdefgh", draw.randrange(1, 4))]) for kind in ("include", "exclude", "required")
        }
        flags = {"vote": draw.choice([None, True, False]), "failed": draw.choice([None, True, False])}
        want = df.filter(subs.transaction_filter(**{k: v or () for k, v in lists.items()}, **flags))
        tables = subs.AccountTables(**{k: None if v is None else account_table(spark, v + v) for k, v in lists.items()}, **flags)
        got = subs.accounts_filter(df, ["part", "seq"], tables)
        assert got.columns == df.columns
        assert sorted(r.seq for r in got.collect()) == sorted(r.seq for r in want.collect())


def test_named_tables_equal_named_lists(spark):
    rows = [(i, list(k), i % 2 == 0, i % 3 == 0) for i, k in enumerate(["ab", "bc", "a", "", "abc", "cd", "d", "bb"])]
    df = spark.createDataFrame(rows, "seq long, account_keys array<string>, is_vote boolean, failed boolean")
    lists = {"one": {"include": ["a", "d"]}, "two": {"required": ["b", "c"]}, "three": {"exclude": ["a", "b"], "failed": False}}
    want = subs.named_filters(df, {n: subs.transaction_filter(**f) for n, f in lists.items()})
    tables = {
        n: subs.AccountTables(**{k: account_table(spark, v) if isinstance(v, list) else v for k, v in f.items()})
        for n, f in lists.items()
    }
    got = subs.named_table_filters(df, ["seq"], tables)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_long_lists_are_not_in_the_plan(spark):
    df = spark.createDataFrame([(1, ["a77"], False, False)], "seq long, account_keys array<string>, is_vote boolean, failed boolean")
    long = spark.range(20_000).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("account"))
    got = subs.accounts_filter(df, ["seq"], subs.AccountTables(include=long))
    assert got.count() == 1
    assert len(got._jdf.queryExecution().optimizedPlan().toString()) < 10_000
