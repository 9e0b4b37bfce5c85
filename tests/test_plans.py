"""Plans of the registered queries: no pair joins, no rows through one task, pruned scans."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")
HEALTH = ["w1_endpoint_events", "w2_pool_events", "w6_retry_schedule", "w7_outages", "w8_active_endpoints"]
STREAMS = {
    "d2_dedup_stream", "d2_dedup_micro_batches", "d3_expiry", "d3_state_entries", "d5_stream_size",
    "d6_stream_live_keys", "k1_split_sink", "k3_callbacks", "w9_status_job", "w10_endpoint_events_stream",
    "w11_open_silences", "w11_stale_stream",
}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.filterwarnings("ignore:.*skipped")
@pytest.mark.parametrize("name", sorted(set(entry.QUERIES) - STREAMS))
def test_plan(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = [re.sub(r"^[\s:+\-|!*()\d]*", "", line) for line in plan.splitlines()]
    for i, line in enumerate(lines):
        if not line.startswith("Exchange SinglePartition"):
            continue
        # Only what was aggregated before, to ticks, blocks or totals, meets in one task.
        below = []
        for later in lines[i + 1 :]:
            if not later.startswith(("Project", "Filter", "Union", "Sort", "BroadcastHashJoin")):
                below = [later.split()[0].split("(")[0]]
                break
        assert below and below[0] in {
            "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Range"
        }, plan
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert "value" not in schema or name.startswith("f4_")


def test_messages_shrink_before_they_shuffle(spark):
    plan = plan_of(entry.queries()["w3_stale_episodes"](spark, SF))
    lines = plan.splitlines()
    shuffles = [i for i, line in enumerate(lines) if "hashpartitioning(client_id" in line]
    assert shuffles
    for i in shuffles:
        assert any(a in lines[i + 1] for a in ("partial_min", "partial_max_by", "HashAggregate", "Project"))


def test_judged_rows_shuffle_once(spark):
    plan = plan_of(entry.queries()["p1_transaction_events"](spark, SF))
    assert plan.count("hashpartitioning(") == 1


@pytest.mark.parametrize("name", HEALTH)
def test_ordered_operators_read_the_log_once(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    # What is left for the query itself is the second scan of rows that the first one kept.
    assert "events.parquet" not in plan
    assert plan.count("FileScan") == 2
    assert plan.count("Exchange hashpartitioning") <= 5


@pytest.mark.parametrize("name", ["a4_running_rate", "a10_sequence_numbers", "d4_split_unique", "k2_event_log"])
def test_rows_are_judged_once(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert plan.count("fold(received_ms") == (0 if name.startswith("a") else 1)


def test_no_job_runs_before_the_query_when_points_and_hot_keys_are_given(spark):
    from streamfuse.operators import dedup, health, ordered
    from streamfuse.plans import samples

    log, feed = samples.connection_log(spark, SF), samples.deliveries(spark, SF)
    points = ordered.split_points(log, health.ORDER)
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    health.retry_schedule(log, points=points)
    health.endpoint_events(log, points, recovery_details=True)
    health.active_endpoints(log, points)
    dedup.dedup_ttl(feed, "signature", "received_ms", 60, hot_keys=[])
    assert set(tracker.getJobIdsForGroup(None)) == before
