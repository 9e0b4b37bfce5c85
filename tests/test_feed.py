import time

import pytest

from streamfuse.config import Endpoint, PoolOptions
from streamfuse.plans.feed import Feed

SCHEMA = (
    "signature binary, received_ms bigint, seq bigint, kind string, account_keys array<string>,"
    " is_vote boolean, failed boolean, slot bigint, owner string"
)
BASE = 1_700_000_000_000
FEED = Feed(
    [Endpoint("https://a.example"), Endpoint("https://a.example")],
    PoolOptions(dedup_ttl_ms=1000, stale_timeout_ms=5000),
    {"transactions": {"p": {"accountInclude": ["p"], "vote": False, "failed": False}}},
    state_buckets=4,
)


def message(seq, ms, sig=b"s", keys=("p",), vote=False, kind="transaction"):
    return (sig, BASE + ms, seq, kind, list(keys), vote, False, seq, None)


FIRST = [message(1, 0), message(2, 1500), message(3, 10, b"t", ("q",)), message(4, 20, b"u", vote=True)]
SECOND = [message(1, 5), message(2, 1000), message(3, 30, None), message(4, 1001, kind="pong")]


def test_batch(spark):
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (FIRST, SECOND)]
    judged = FEED.judge(FEED.select(FEED.merge(frames)))
    got = {(r.client_id, r.seq): (r.is_duplicate, r.anchor_ms - BASE) for r in judged.collect()}
    assert got == {
        ("client-1", 1): (False, 0),
        ("client-2", 1): (True, 0),
        ("client-2", 2): (True, 0),
        ("client-1", 2): (False, 1500),
    }
    sent = FEED.transactions(judged, ["slot"]).collect()
    assert sorted((r.timestamp - BASE, r.data.slot) for r in sent) == [(0, 1), (1500, 2)]
    assert FEED.duplicates(judged).count() == 2
    assert {r.client_id for r in FEED.endpoints_table(spark).collect()} == {"client-1", "client-2"}
    assert FEED.cache(judged, 500).agg({"size": "max"}).first()[0] == 1


def test_stream_with_handlers(spark, tmp_path):
    frames = []
    for name, rows in (("a", FIRST), ("b", SECOND)):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / name))
        frames.append(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / name)))
    judged = FEED.judge(FEED.select(FEED.merge(frames)))
    seen = {"transaction": [], "duplicate": []}
    writer = FEED.on(
        judged,
        str(tmp_path / "cp"),
        transaction=lambda df, _: seen["transaction"].extend(r.received_ms for r in df.collect()),
        duplicate=lambda df, _: seen["duplicate"].extend(r.received_ms for r in df.collect()),
    )
    writer.trigger(availableNow=True).start().awaitTermination()
    assert sorted(t - BASE for t in seen["transaction"]) == [0, 1500]
    assert sorted(t - BASE for t in seen["duplicate"]) == [5, 1000]


LOG = "client_id string, endpoint string, ts_ms bigint, seq bigint, kind string, details string"


def log_rows():
    kinds = ["connected", "error", "connect_failed", "connected", "disconnected"]
    return [("client-1", "https://a.example", 10_000 * i, i, k, None) for i, k in enumerate(kinds)]


def test_health_of_a_stored_log(spark):
    log = spark.createDataFrame(log_rows(), LOG)
    events = FEED.endpoint_events(log).orderBy("seq").collect()
    assert [r.status for r in events] == ["connected", "connected", "disconnected"]
    assert [r.status for r in FEED.pool_events(log).orderBy("timestamp").collect()] == [
        "connected",
        "disconnected",
    ]
    assert [r.detected_ms for r in FEED.stale(log, 0, 50_000).orderBy("end_ms").collect()] == [
        6_000,
        36_000,
    ]
    assert [r.delay_ms for r in FEED.retries(log).orderBy("seq").collect()] == [500, 1000, 500]
    assert FEED.status(log, 35_000).first().time_since_last_message == 5_000


@pytest.mark.parametrize("method", ["endpoint_events", "stale"])
def test_health_of_a_stream(spark, tmp_path, method):
    spark.createDataFrame(log_rows()[:1], LOG).coalesce(1).write.parquet(str(tmp_path / "in"))
    log = spark.readStream.schema(LOG).parquet(str(tmp_path / "in"))
    out = getattr(Feed([], PoolOptions(stale_timeout_ms=200)), method)(log)
    query = (
        out.writeStream.format("memory")
        .queryName(f"feed_{method}")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .start()
    )
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.table(f"feed_{method}").count() == 0:
            time.sleep(0.2)
        assert spark.table(f"feed_{method}").count() == 1
    finally:
        query.stop()
