import random
import time

import pytest
from pyspark.sql import functions as F

from streamfuse.operators import health
from streamfuse.streaming import dedup as stream
from streamfuse.streaming import health as stream_health
from streamfuse.streaming import sinks
from streamfuse.streaming import status as stream_status
from tests.folds import fold_rows

SCHEMA = "signature binary, received_ms bigint, ordinal int, seq bigint"
BASE = 1_000_000_000
TTL = 60


def rows_of(seed, n=600):
    r = random.Random(seed)
    return [
        (
            r.choice([None, b"", *[f"k{k}".encode() for k in range(25)]]),
            BASE + r.randrange(1500),
            r.randrange(1, 5),
            i,
        )
        for i in range(n)
    ]


def write_files(spark, rows, path, n):
    """Files in time order, one micro-batch each."""
    rows = sorted(rows, key=lambda r: r[1:])
    step = -(-len(rows) // n)
    for i in range(n):
        part = spark.createDataFrame(rows[i * step : (i + 1) * step], SCHEMA).coalesce(1)
        part.write.mode("append").parquet(str(path))
        time.sleep(0.02)


def read(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(path))


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def result(frame):
    return {
        (None if r.signature is None else bytes(r.signature), r.received_ms, r.ordinal, r.seq): (
            r.is_duplicate,
            r.anchor_ms,
        )
        for r in frame.collect()
    }


@pytest.mark.parametrize(("n", "lateness"), [(1, None), (2, None), (5, 0)])
def test_stream_equals_batch_in_any_number_of_micro_batches(spark, tmp_path, n, lateness):
    rows = rows_of(n)
    write_files(spark, rows, tmp_path / "in", n)
    judged = stream.dedup_ttl_stream(
        read(spark, tmp_path / "in"), "signature", "received_ms", TTL, lateness_ms=lateness, buckets=8
    )
    out = judged.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    run(out.option("checkpointLocation", str(tmp_path / "cp")))
    assert result(spark.read.parquet(str(tmp_path / "out"))) == fold_rows(rows, TTL)


def test_state_survives_a_restart_and_late_rows_repeat_their_anchor(spark, tmp_path):
    steps = [
        [(b"a", BASE, 1, 1), (b"b", BASE + 10, 1, 2)],
        [(b"a", BASE + 50, 2, 3), (b"a", BASE + 61, 1, 4)],
        [(b"a", BASE + 5, 3, 5), (b"a", BASE + 121, 1, 6), (b"b", BASE + 70, 4, 7)],
    ]
    known, want = {}, {}
    for step in steps:
        spark.createDataFrame(step, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        judged = stream.dedup_ttl_stream(
            read(spark, tmp_path / "in"), "signature", "received_ms", TTL, buckets=4
        )
        out = judged.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        run(out.option("checkpointLocation", str(tmp_path / "cp")))
        part = fold_rows(step, TTL, known)
        for (key, *_), (_, anchor) in part.items():
            known[key] = max(anchor, known.get(key, anchor))
        want |= part
    got = result(spark.read.parquet(str(tmp_path / "out")))
    assert got == want
    assert got[(b"a", BASE + 5, 3, 5)] == (True, BASE + 61)


def test_state_has_an_entry_for_each_live_key(spark, tmp_path):
    rows = [(f"k{i}".encode(), BASE + i, 1, i) for i in range(400)]
    write_files(spark, rows, tmp_path / "in", 4)
    judged = stream.dedup_ttl_stream(
        read(spark, tmp_path / "in"), "signature", "received_ms", TTL, lateness_ms=0, buckets=1
    )
    run(judged.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp")))
    keys = stream.state_anchors(spark, str(tmp_path / "cp"), "signature").collect()
    live = {f"k{i}".encode() for i in range(400 - TTL - 1, 400)}
    held = {bytes(r.signature) for r in keys}
    assert live <= held and len(held) < 200


def test_keys_leave_a_silent_bucket(spark, tmp_path):
    """Timers follow the watermark of the whole feed; a cell of state is a quarter of the time-to-live long."""
    width, lateness = TTL // 4, 30
    rows = {0: [(b"a", BASE, 1, 1)]}
    for i in range(1, 8):
        rows[i] = [(f"b{i}".encode(), BASE + 20 * i, 1, i + 1)]
    for i in range(8):
        spark.createDataFrame(rows[i], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        judged = stream.dedup_ttl_stream(
            read(spark, tmp_path / "in"), "signature", "received_ms", TTL, lateness_ms=lateness, buckets=512
        )
        run(judged.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp")))
        held = {bytes(r.signature): r.anchor_ms for r in stream.state_anchors(spark, str(tmp_path / "cp"), "signature").collect()}
        now = BASE + 20 * i
        assert {k: a for [(k, a, *_)] in rows.values() if a <= now and a + TTL + lateness >= now}.items() <= held.items()
        assert all(a + TTL + lateness + width > now for a in held.values())
        live = stream.stream_live_keys(spark, str(tmp_path / "cp"), "signature", now, TTL).collect()
        assert {bytes(r.signature) for r in live} == {k for k, a in held.items() if now - TTL <= a}
        (size,) = stream.stream_size(spark, str(tmp_path / "cp"), "signature", now, TTL, 3).collect()
        assert (size["tick_ms"], size["size"], size.cap_would_act) == (now, len(live), len(live) >= 3)


def test_pieces_cover_each_cell_once():
    for first, end, level in [(0, 1, 0), (-5, 77, 4), (3, 4, 9), (-64, 64, 6), (1, 10_000, 20)]:
        pieces = stream.cut(first, end, level)
        assert [c for n, at in pieces for c in range(at, at + (1 << n))] == list(range(first, end))
        assert all(n <= level and at % (1 << n) == 0 for n, at in pieces)
        assert len(pieces) <= 2 * level + 2 + ((end - first) >> level)


def test_a_batch_over_many_cells_makes_few_entries_and_loses_cell_by_cell(spark, tmp_path):
    width, lateness = TTL // 4, 3_000
    old = [(f"k{i}".encode(), BASE + 7 * i, 1, i) for i in range(1200)]
    # The last rows repeat keys of the end of the first batch, and move the watermark into the midst of its pieces.
    late = [(f"k{i}".encode(), BASE + 8_400, 2, i) for i in range(1195, 1200)]
    for step in (old, late):
        spark.createDataFrame(step, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        judged = stream.dedup_ttl_stream(
            read(spark, tmp_path / "in"), "signature", "received_ms", TTL, lateness_ms=lateness, buckets=1
        )
        out = judged.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        run(out.option("checkpointLocation", str(tmp_path / "cp")))
        now = max(r[1] for r in step)
        entries = spark.read.format("statestore").option("stateVarName", "cells").load(str(tmp_path / "cp"))
        assert entries.count() < 80  # one for each cell would be 204
        held = sorted((bytes(r.signature), r.anchor_ms) for r in stream.state_anchors(spark, str(tmp_path / "cp"), "signature").collect())
        assert held == sorted((k, t) for k, t, *_ in old if (t // width + 1) * width + TTL + lateness > now)
    assert result(spark.read.parquet(str(tmp_path / "out"))) == fold_rows(old + late, TTL)


def test_very_late_rows_find_their_cells(spark, tmp_path):
    """Rows come back after more cells than are looked up one by one."""
    far = TTL * 200
    steps = [
        [(b"a", BASE, 1, 1), (b"b", BASE + far, 1, 2), (b"c", BASE + far // 2, 1, 3)],
        [(b"a", BASE + TTL, 2, 4), (b"c", BASE + 5, 2, 5), (b"d", BASE + 1, 2, 6), (b"b", BASE + far + TTL + 1, 2, 7)],
    ]
    known, want = {}, {}
    for step in steps:
        spark.createDataFrame(step, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        judged = stream.dedup_ttl_stream(read(spark, tmp_path / "in"), "signature", "received_ms", TTL, buckets=2)
        out = judged.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        run(out.option("checkpointLocation", str(tmp_path / "cp")))
        part = fold_rows(step, TTL, known)
        for (key, *_), (_, anchor) in part.items():
            known[key] = max(anchor, known.get(key, anchor))
        want |= part
    assert result(spark.read.parquet(str(tmp_path / "out"))) == want


def late_rows():
    steps = [[(b"a", BASE, 1, 1)], [(b"b", BASE + 700, 1, 2)], [(b"a", BASE + 10, 1, 3)]]
    return steps, {1: False, 2: False, 3: True}


@pytest.mark.parametrize("form", ["state", "batches"])
@pytest.mark.parametrize("lateness", [None, 100])
def test_a_late_row_repeats_its_anchor_unless_bounded_state_is_asked_for(spark, tmp_path, form, lateness):
    steps, want = late_rows()
    job = stream.MicroBatchDedup(str(tmp_path / "s"), "signature", "received_ms", TTL, lateness_ms=lateness)
    out = str(tmp_path / "out")

    def write(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    for step in steps:
        frame = spark.createDataFrame(step, SCHEMA).coalesce(1)
        frame.write.mode("append").parquet(str(tmp_path / "in"))
        feed = read(spark, tmp_path / "in")
        if form == "state":
            judged = stream.dedup_ttl_stream(
                feed, "signature", "received_ms", TTL, lateness_ms=lateness, buckets=1
            )
            writer = judged.writeStream.format("parquet").option("path", out)
        else:
            writer = feed.writeStream.foreachBatch(lambda b, i: job.run(b, i, write))
        run(writer.option("checkpointLocation", str(tmp_path / "cp")))
    got = {r.seq: r for r in spark.read.parquet(out).collect()}
    if lateness is None:
        assert {i: r.is_duplicate for i, r in got.items()} == want
        assert "maybe_expired" not in got[3].asDict()
    else:
        assert not got[3].is_duplicate and got[3].maybe_expired
        assert not got[1].maybe_expired and not got[2].maybe_expired


def test_rows_without_a_time_are_unique_in_a_stream(spark, tmp_path):
    rows = [(b"a", BASE, 1, 1), (b"a", None, 1, 2), (b"a", BASE + 9, 1, 3), (None, None, 1, 4)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in"))
    judged = stream.dedup_ttl_stream(read(spark, tmp_path / "in"), "signature", "received_ms", TTL, buckets=2)
    out = judged.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    run(out.option("checkpointLocation", str(tmp_path / "cp")))
    got = {r.seq: (r.is_duplicate, r.anchor_ms) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: (False, BASE), 2: (False, None), 3: (True, BASE), 4: (False, None)}


@pytest.mark.parametrize("n", [1, 5])
def test_micro_batch_form_equals_batch_and_can_be_repeated(spark, tmp_path, n):
    rows = rows_of(10 + n)
    write_files(spark, rows, tmp_path / "in", n)
    job = stream.MicroBatchDedup(
        str(tmp_path / "state"), "signature", "received_ms", TTL, hot_rows=20, cell_ms=100
    )

    def write(frame, batch_id):
        frame.write.mode("overwrite").parquet(str(tmp_path / f"out/batch_id={batch_id}"))

    def twice(batch, batch_id):
        job.run(batch, batch_id, write)
        job.run(batch, batch_id, write)

    source = read(spark, tmp_path / "in")
    run(source.writeStream.foreachBatch(twice).option("checkpointLocation", str(tmp_path / "cp")))
    assert result(spark.read.parquet(str(tmp_path / "out"))) == fold_rows(rows, TTL)
    live = job.live(spark, source.schema["signature"].dataType, n - 1)
    assert live.count() == len({r[0] for r in rows if r[0] is not None})


def folder_bytes(path):
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def test_bytes_follow_the_batch_and_not_the_age_of_the_feed(spark, tmp_path):
    """Fifty batches of an hour's cell each; each reads the anchors near its own rows, and writes its own."""
    job = stream.MicroBatchDedup(str(tmp_path / "s"), "signature", "received_ms", TTL, cell_ms=TTL + 1)
    binary = spark.createDataFrame([], SCHEMA).schema["signature"].dataType
    read_bytes, files = [], set()
    for i in range(50):
        start = BASE + i * 200
        rows = [(f"key-{i}-{k}".encode(), start + k, 1, i * 1000 + k) for k in range(150)]
        if i == 49:
            rows = [(f"key-{j}-0".encode(), start, 1, 10**6 + j) for j in range(30)]
        known = job.known(spark, binary, i, start, job.newest_ms(spark, i - 1))
        names = [] if known is None else known.inputFiles()
        read_bytes.append(len(names))
        job.run(spark.createDataFrame(rows, SCHEMA).coalesce(1), i, lambda df, _: df.count())
        files |= {f.name for f in (tmp_path / "s").rglob("*.parquet")}
    assert max(read_bytes[1:]) <= 4 and len(files) >= 100
    # A row that comes very late reads from its own time on.
    late = job.known(spark, binary, 50, BASE + 10, job.newest_ms(spark, 49))
    assert {bytes(r.signature) for r in late.collect()} >= {f"key-{i}-0".encode() for i in range(49)}


def test_a_late_row_is_judged_by_the_anchors_of_its_time(spark, tmp_path):
    job = stream.MicroBatchDedup(str(tmp_path / "s"), "signature", "received_ms", TTL, cell_ms=TTL + 1)
    steps = [[(b"a", BASE, 1, 1)], [(b"b", BASE + 100_000, 1, 2)], [(b"a", BASE + TTL, 1, 3), (b"b", BASE + 7, 1, 4), (None, BASE, 1, 5)]]
    seen = {}

    def keep(df, _):
        seen.update({r.seq: (r.is_duplicate, r.anchor_ms) for r in df.collect()})

    for i, step in enumerate(steps):
        job.run(spark.createDataFrame(step, SCHEMA), i, keep)
    assert seen == {1: (False, BASE), 2: (False, BASE + 100_000), 3: (True, BASE), 4: (True, BASE + 100_000), 5: (False, None)}


def test_keys_expire_though_they_send_nothing_any_more(spark, tmp_path):
    job = stream.MicroBatchDedup(
        str(tmp_path / "s"), "signature", "received_ms", TTL, lateness_ms=10, cell_ms=70
    )
    for i, (key, at) in enumerate([(b"a", 0), (b"b", 60), (b"c", 75), (b"d", 500)]):
        frame = spark.createDataFrame([(key, BASE + at, 1, i)], SCHEMA)
        job.run(frame, i, lambda df, _: df.count())
        kind = frame.schema["signature"].dataType
        live = sorted(bytes(r.signature).decode() for r in job.live(spark, kind, i).collect())
        assert live == {0: ["a"], 1: ["a", "b"], 2: ["b", "c"], 3: ["d"]}[i]


def test_builtin_form_is_a_different_rule(spark, tmp_path):
    rows = [(b"a", BASE * 1000 + t * 1000, 1, t) for t in (0, 50, 61, 100, 200)]
    for row in rows:
        spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.02)
    kept = stream.drop_repeats_builtin(
        read(spark, tmp_path / "in"), "signature", "received_ms", "60 seconds"
    )
    out = kept.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    run(out.option("checkpointLocation", str(tmp_path / "cp")))
    assert spark.read.parquet(str(tmp_path / "out")).count() < 3


def judged_stream(spark, tmp_path, rows, n=2):
    write_files(spark, rows, tmp_path / "in", n)
    return stream_of(spark, tmp_path)


def stream_of(spark, tmp_path):
    return stream.dedup_ttl_stream(
        read(spark, tmp_path / "in"), "signature", "received_ms", TTL, buckets=4
    )


def test_split_sink_writes_each_batch_once(spark, tmp_path):
    rows = rows_of(3)
    judged = judged_stream(spark, tmp_path, rows)
    path = str(tmp_path / "t")
    want = fold_rows(rows, TTL)
    n_dup = sum(d for d, _ in want.values())
    run(sinks.split_sink(judged, path, str(tmp_path / "cp")))
    # The last micro-batch again, as after a failure before it was committed.
    (tmp_path / "cp" / "commits" / "1").unlink()
    (tmp_path / "cp" / "commits" / ".1.crc").unlink(missing_ok=True)
    run(sinks.split_sink(stream_of(spark, tmp_path), path, str(tmp_path / "cp")))
    duplicates, unique = sinks.read_part(spark, path, True), sinks.read_part(spark, path, False)
    assert (duplicates.count(), unique.count()) == (n_dup, len(rows) - n_dup)
    assert "is_duplicate" in duplicates._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]


def test_one_table_by_flag(spark, tmp_path):
    rows = rows_of(4)
    judged = judged_stream(spark, tmp_path, rows)
    run(sinks.flagged_sink(judged, str(tmp_path / "t"), str(tmp_path / "cp")))
    table = sinks.read_flagged(spark, str(tmp_path / "t"))
    n_dup = sum(d for d, _ in fold_rows(rows, TTL).values())
    assert table.filter("is_duplicate").count() == n_dup and table.count() == len(rows)
    sinks.split_write(table, str(tmp_path / "stored"))
    stored = sinks.read_flagged(spark, str(tmp_path / "stored")).filter("is_duplicate")
    assert stored.count() == n_dup
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_duplicate" in plan


def test_handlers_get_their_family(spark, tmp_path):
    rows = rows_of(5)
    judged = judged_stream(spark, tmp_path, rows)
    kind = F.when(F.col("is_duplicate"), "duplicate").otherwise("transaction")
    seen = {"duplicate": 0, "transaction": 0}

    def count_as(name):
        def handler(frame, _batch_id):
            seen[name] += frame.count()

        return handler

    handlers = {name: count_as(name) for name in seen}
    run(sinks.on_events(judged.withColumn("type", kind), handlers, str(tmp_path / "cp")))
    n_dup = sum(d for d, _ in fold_rows(rows, TTL).values())
    assert seen == {"duplicate": n_dup, "transaction": len(rows) - n_dup}


LOG = "client_id string, endpoint string, ts_ms bigint, seq bigint, kind string, details string"


def test_endpoint_events_stream_equals_batch(spark, tmp_path):
    r = random.Random(8)
    kinds = ["connected", "disconnected", "force_reconnect", "error", "transaction", "pong"]
    rows = [
        (f"client-{r.randrange(1, 4)}", "https://x.example", i // 2, i, r.choice(kinds), None)
        for i in range(300)
    ]
    for i in range(3):
        part = spark.createDataFrame(rows[i * 100 : (i + 1) * 100], LOG).coalesce(1)
        part.write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.02)
    source = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = stream_health.endpoint_events_stream(source).writeStream.format("parquet")
    out = out.option("path", str(tmp_path / "out"))
    run(out.option("checkpointLocation", str(tmp_path / "cp")))
    got = spark.read.parquet(str(tmp_path / "out"))
    want = health.endpoint_events(spark.createDataFrame(rows, LOG))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def random_log(seed, n, steps=(0, 1, 5, 9, 30)):
    r = random.Random(seed)
    kinds = ["connected", "disconnected", "error", "transaction", "transaction", "pong"]
    at, rows = BASE, []
    for i in range(n):
        at += r.choice(steps)
        rows.append((f"client-{r.randrange(1, 4)}", "https://x.example", at, i, r.choice(kinds), None))
    return rows


def test_episodes_of_a_stream_equal_those_of_the_stored_log_after_every_batch(spark, tmp_path):
    """Also those that still last: each time the stream knows what the batch form finds with its end at the watermark."""
    rows = random_log(4, 240)
    # The second client is gone for good; only other clients move the clock on, in the end by a pong.
    rows = [r for r in rows if r[0] != "client-2" or r[3] < 100]
    rows += [("client-2", "https://x.example", rows[90][2], 1000, "connected", None)]
    rows = sorted(rows, key=lambda r: (r[2], r[3]))
    rows.append(("client-3", "https://x.example", rows[-1][2] + 500, 2000, "pong", None))
    step = -(-len(rows) // 4)
    for i in range(4):
        part = rows[i * step : (i + 1) * step]
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(LOG).parquet(str(tmp_path / "in"))
        out = stream_health.stale_episodes_stream(source, 20).writeStream.format("parquet")
        out = out.option("path", str(tmp_path / "out"))
        query = run(out.option("checkpointLocation", str(tmp_path / "cp")))
        told = spark.read.parquet(str(tmp_path / "out"))
        now = part[-1][2]
        assert stream_health.newest_of(query) == now
        stored = health.stale_episodes(spark.createDataFrame(rows[: (i + 1) * step], LOG), 20, now)
        got = stream_health.episodes_at(told, now)
        assert sorted(map(str, got.collect())) == sorted(map(str, stored.collect()))
    ended = told.filter(F.col("end_ms").isNotNull())
    assert ended.count() > 5 and got.filter(F.col("end_ms") == now).count() >= 1
    assert told.count() == told.distinct().count()


def test_stale_stream_reports_silent_clients_once(spark, tmp_path):
    def add(rows):
        full = [(f"client-{c}", "https://x.example", t, t, kind, None) for c, t, kind in rows]
        spark.createDataFrame(full, LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    busy = [(1, t, "transaction") for t in range(1, 500)]
    add([(1, 0, "connected"), *busy, (2, 0, "connected"), (2, 5, "error"), (3, 9, "transaction")])
    source = spark.readStream.schema(LOG).parquet(str(tmp_path / "in"))
    found = stream_health.stale_stream(source, 1500)
    query = (
        found.writeStream.format("memory")
        .queryName("stale")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(processingTime="300 milliseconds")
        .start()
    )
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.table("stale").count() == 0:
            time.sleep(0.2)
        time.sleep(3)
        got = [(r.client_id, r.last_message_ms) for r in spark.table("stale").collect()]
        # Only the connected client; down and never connected ones are not stale.
        assert got == [("client-1", 499)]
    finally:
        query.stop()


def test_status_rows_are_written_once_for_each_tick(spark, tmp_path):
    log = stream_status.StatusLog(spark, str(tmp_path / "s"), start_ms=1000, tick_ms=100, size=lambda tick: tick % 7)
    feed, clients = stream_status.FEED, stream_status.CLIENTS
    log.add(feed, 0, {"transactions": 3, "duplicates": 1, "newest_ms": 1050})
    log.add(clients, 0, {"active": 2, "seen": 2, "newest_ms": 1100})
    log.add(feed, 0, {"transactions": 3, "duplicates": 1, "newest_ms": 1050})  # told twice
    log.add(feed, 1, {"transactions": 2, "duplicates": None, "newest_ms": 1101})
    log.add(clients, 1, {"active": -1, "seen": 0, "newest_ms": 1150})
    log.add(clients, 2, {"active": 1, "seen": 0, "newest_ms": None})
    got = sorted(tuple(r) for r in stream_status.read_status(spark, str(tmp_path / "s")).collect())
    assert got == [
        (1100, 0, 2, 2, 3, 1, 1100 % 7, 10_000, 60_000),
        (1200, 0, 2, 2, 5, 1, 1200 % 7, 10_000, 60_000),
    ]
