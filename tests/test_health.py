import random

import pytest
from pyspark.sql import functions as F

from streamfuse.config import Endpoint, PoolOptions
from streamfuse.operators import health, ordered
from streamfuse.sources.feeds import endpoints_table

SCHEMA = "client_id string, endpoint string, ts_ms bigint, seq bigint, kind string, details string"


def log_of(spark, rows):
    """rows: (client number, time, kind)"""
    full = [
        (f"client-{c}", f"https://{c}.example", t, i, kind, None) for i, (c, t, kind) in enumerate(rows)
    ]
    return spark.createDataFrame(full, SCHEMA)


def statuses(frame):
    return [r.status for r in frame.orderBy("timestamp", "seq").collect()]


def test_error_alone_leaves_the_pool_state(spark):
    log = log_of(spark, [(1, 1, "connected"), (1, 2, "error"), (1, 3, "connected")])
    assert statuses(health.endpoint_events(log)) == ["connected", "connected"]
    assert statuses(health.pool_events(log)) == ["connected"]


def test_repeated_disconnects_are_all_reported(spark):
    rows = [(1, 1, "connected"), (1, 2, "disconnected"), (1, 3, "force_reconnect"), (1, 9, "connected")]
    made = health.endpoint_events(log_of(spark, rows), recovery_details=True)
    assert statuses(made) == ["connected", "disconnected", "disconnected", "reconnected"]
    last = made.filter("status = 'reconnected'").first()
    assert last.details == "Recovered after 0.0 seconds"
    assert statuses(health.pool_events(log_of(spark, rows))) == ["connected", "disconnected", "connected"]


def test_first_event_may_be_a_disconnect(spark):
    log = log_of(spark, [(1, 1, "disconnected"), (1, 2, "connected"), (2, 3, "connected")])
    assert statuses(health.endpoint_events(log)) == ["disconnected", "reconnected", "connected"]
    active = health.active_endpoints(log).orderBy("timestamp").collect()
    assert [(r.n_active, r.n_seen) for r in active] == [(0, 1), (1, 1), (2, 2)]


def test_pool_edges_only(spark):
    rows = [(1, 1, "connected"), (2, 2, "connected"), (1, 3, "disconnected"), (2, 4, "disconnected")]
    rows += [(2, 5, "connected")]
    pool = health.pool_events(log_of(spark, rows)).orderBy("timestamp").collect()
    assert [(r.status, r.timestamp) for r in pool] == [
        ("connected", 1),
        ("disconnected", 4),
        ("connected", 5),
    ]


def test_stale_is_strict_and_pongs_do_not_count(spark):
    rows = [(1, 0, "connected"), (1, 50, "pong"), (1, 100, "transaction"), (1, 201, "transaction")]
    rows += [(1, 301, "transaction"), (1, 310, "error"), (1, 900, "transaction")]
    found = health.stale_episodes(log_of(spark, rows), 100, 2000).collect()
    # 100 after the last message is not stale, 101 is; a client that is down never is.
    assert [(r.last_message_ms, r.stale_from_ms, r.end_ms) for r in found] == [(100, 200, 201)]


def test_open_episode_ends_at_the_report_time(spark):
    log = log_of(spark, [(1, 0, "connected"), (2, 0, "connected"), (2, 5, "force_reconnect")])
    found = health.stale_episodes(log, 100, 1000).collect()
    assert [(r.client_id, r.end_ms) for r in found] == [("client-1", 1000)]


@pytest.mark.parametrize(
    ("end", "detected"), [(1000, 260), (260, None), (261, 260), (250, None)]
)
def test_detection_is_the_first_check_past_the_limit(spark, end, detected):
    log = log_of(spark, [(1, 100, "connected"), (1, end, "transaction")])
    found = health.stale_detected(health.stale_episodes(log, 100, end), 0, interval_ms=20)
    # The limit is reached at 200; the check at 200 is not past it when it falls exactly there.
    got = [r.detected_ms for r in found.collect()]
    assert got == ([220] if end > 220 else [])
    shifted = health.stale_detected(health.stale_episodes(log, 100, end), 240, interval_ms=20)
    assert [r.detected_ms for r in shifted.collect()] == ([detected] if detected else [])


def test_snapshot_honours_errors(spark):
    rows = [(1, 1, "connected"), (1, 40, "transaction"), (1, 50, "pong"), (2, 2, "connected")]
    rows += [(2, 30, "error"), (3, 5, "connect_failed"), (1, 200, "disconnected")]
    got = {r.client_id: (r.connected, r.time_since_last_message) for r in
           health.status_snapshot(log_of(spark, rows), 100).collect()}
    assert got == {"client-1": (True, 60), "client-2": (False, None), "client-3": (False, None)}


def test_retry_delays(spark):
    rows = [
        (1, 0, "connect_failed"),
        (1, 1000, "error"),
        (1, 1000, "disconnected"),  # error, then end: the counter moves twice
        (1, 1500, "connected"),
        (1, 2000, "disconnected"),  # replaces the retry due at 3000, although a success came between
        (1, 2100, "force_reconnect"),
        (1, 2200, "connect_failed"),
    ]
    got = health.retry_schedule(log_of(spark, rows), 500, 2, 30_000).orderBy("seq").collect()
    assert [(r.ts_ms, r.attempt, r.delay_ms, r.replaced) for r in got] == [
        (0, 0, 500, False),
        (1000, 1, 1000, True),
        (1000, 2, 2000, True),
        (2000, 0, 500, True),
        (2200, 0, 500, False),
    ]


def test_retry_delay_is_capped(spark):
    log = log_of(spark, [(1, i, "connect_failed") for i in range(9)])
    got = health.retry_schedule(log, 1000, 1.5, 6000).orderBy("seq").collect()
    assert [r.delay_ms for r in got] == [1000, 1500, 2250, 3375, 5062, 6000, 6000, 6000, 6000]
    many = log_of(spark, [(1, i, "connect_failed") for i in range(3000)])
    assert health.retry_schedule(many).agg(F.max("delay_ms")).first()[0] == 30_000


def test_outages(spark):
    rows = [(1, 0, "connected"), (1, 1000, "disconnected"), (1, 1500, "disconnected")]
    rows += [(1, 3250, "connected"), (1, 4000, "force_reconnect")]
    got = health.outages(log_of(spark, rows)).orderBy("start_ms").collect()
    assert [(r.start_ms, r.end_ms, r.duration_ms, r.details) for r in got] == [
        (1000, 3250, 2250, "Recovered after 2.3 seconds"),
        (4000, None, None, None),
    ]


def test_unknown_clients_and_repeated_urls(spark):
    table = endpoints_table(spark, [Endpoint("https://x.example"), Endpoint("https://x.example")])
    assert [r.client_id for r in table.orderBy("ordinal").collect()] == ["client-1", "client-2"]
    events = health.endpoint_events(log_of(spark, [(2, 1, "connected"), (9, 2, "connected")]))
    named = {r.client_id: r.endpoint for r in health.with_endpoint(events, table).collect()}
    assert named == {"client-2": "https://x.example", "client-9": "unknown"}


def test_any_split_points_give_the_same_result(spark):
    r = random.Random(4)
    kinds = ["connected", "disconnected", "error", "connect_failed", "force_reconnect", "transaction"]
    rows = [(1 if r.random() < 0.4 else r.randrange(1, 6), 500 if i % 3 else i, r.choice(kinds))
            for i in range(900)]
    log = log_of(spark, rows)
    points = ordered.split_points(log, health.ORDER, target_rows=40)
    assert len(points) > 15
    for operator in (
        health.endpoint_events,
        health.pool_events,
        health.active_endpoints,
        health.outages,
        lambda log, points: health.retry_schedule(log, points=points),
        lambda log, points: health.endpoint_events(log, points, recovery_details=True),
    ):
        plain, cut = operator(log, points=[]), operator(log, points=points)
        assert sorted(map(str, plain.collect())) == sorted(map(str, cut.collect()))


def test_options_feed_the_check_interval(spark):
    log = log_of(spark, [(1, 0, "connected")])
    episodes = health.stale_episodes(log, 30_000, 100_000)
    found = health.stale_detected(episodes, 0, PoolOptions(stale_timeout_ms=30_000)).collect()
    assert [r.detected_ms for r in found] == [33_000]
