"""One query per operator, each over the whole of the test tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamfuse import schemas
from streamfuse.functions import payload, text
from streamfuse.functions.base58 import base58
from streamfuse.functions.render import preview, render_binary
from streamfuse.operators import counts, dedup, events, health, subscriptions
from streamfuse.operators.ordered import prefix_sum, split_points
from streamfuse.plans import reports, samples
from streamfuse.plans.feed import Feed
from streamfuse.session import kept, new_work_dir
from streamfuse.sources import feeds, routing
from streamfuse.streaming import dedup as stream_dedup
from streamfuse.streaming import health as stream_health
from streamfuse.streaming import sinks, status

Query = Callable[[SparkSession, str], DataFrame]

TTL_MS = 60_000
HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS
STALE_MS = HOUR_MS
START_MS = 1_704_067_200_000  # 2024-01-01
NOW_MS = START_MS + 15 * DAY_MS
END_MS = 1_706_745_600_000  # 2024-02-01
RETRY = {"initial_ms": 600_000, "factor": 2.0, "cap_ms": 3_600_000}

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def hex_text(column: Column) -> Column:
    return F.lower(F.hex(column))


def configured(spark: SparkSession) -> DataFrame:
    return feeds.endpoints_table(spark, samples.CONFIGURED)


def signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = routing.transactions_only(samples.deliveries(spark, sf_dir))
    return routing.valid_signature(feed)


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_ttl(signed(spark, sf_dir), "signature", "received_ms", TTL_MS)


# Sources and routing


@query
def s1_fan_in(spark, sf_dir):
    source = samples.read_events(spark, sf_dir)
    feed = feeds.fan_in(
        [
            (endpoint, samples.endpoint_deliveries(source, i))
            for i, endpoint in enumerate(samples.ENDPOINTS, start=1)
        ]
    )
    return feed.select("client_id", "endpoint", "ordinal", "seq", "received_ms", "kind")


@query
def s2_fan_in_available(spark, sf_dir):
    here, missing = f"{sf_dir}/events.parquet", f"{sf_dir}/no_such_table.parquet"
    a, b, c, _ = samples.ENDPOINTS
    feed = feeds.fan_in([(a, here), (b, missing), (c, here)], spark, require_any=True)
    return feed.select("client_id", "endpoint", "event_id")


@query
def s2_broken_source(spark, sf_dir):
    """Three sources, of which the second has a file that is no Parquet: rows that came through and files that did not."""
    table = samples.read_events(spark, sf_dir)
    paths = [new_work_dir(spark, f"s2-source-{i}") for i in range(3)]
    for i, path in enumerate(paths):
        table.filter(F.col("event_id") % 3 == i).write.parquet(path)
    # As many lines of text as a source has events, in one file, as a write that broke leaves them.
    table.filter(F.col("event_id") % 3 == 1).select("props").coalesce(1).write.mode("append").text(paths[1])
    sources = list(zip(samples.ENDPOINTS, paths, strict=False))
    rows = feeds.fan_in(sources, spark, require_any=True, skip_broken=True)
    came = rows.groupBy("client_id").agg(F.count("*").alias("n_rows"), F.sum("event_id").alias("sum_ids"))
    lost = feeds.lost_files(sources, spark).groupBy("client_id").agg(F.count("*").alias("n_lost"))
    return came.join(lost, "client_id", "left").withColumn("n_lost", F.coalesce("n_lost", F.lit(0).cast("bigint")))


@query
def s3_endpoints(spark, sf_dir):
    table = feeds.endpoints_table(spark, samples.ENDPOINTS)
    delivered = samples.deliveries(spark, sf_dir).groupBy("client_id").agg(
        F.count("*").alias("n_delivered")
    )
    return table.join(delivered, "client_id", "left")


@query
def r1_route(spark, sf_dir):
    feed = samples.deliveries(spark, sf_dir).withColumnRenamed("kind", "sent")
    n = F.col("seq")
    body = F.when(F.col("sent") == schemas.TRANSACTION, F.struct("signature", "slot"))
    pong = F.when((F.col("sent") == schemas.PONG) | (n % 90 == 0), F.struct(n.alias("id")))
    return routing.route(feed.withColumns({"transaction": body, "pong": pong})).select(
        "ordinal", "seq", "kind"
    )


@query
def feed_end_to_end(spark, sf_dir):
    feed = Feed(samples.ENDPOINTS, request=REQUEST)
    source = samples.read_events(spark, sf_dir)
    merged = feed.merge(
        [samples.endpoint_deliveries(source, i) for i in range(1, len(samples.ENDPOINTS) + 1)]
    )
    with_owner = merged.withColumn("owner", F.get("account_keys", F.lit(0)))
    return counts.dedup_counts(feed.judge(feed.select(with_owner)), by=["client_id", "endpoint"])


@query
def s4_stored_deliveries(spark, sf_dir):
    """Nested records with variants through a stored table, subscribed, judged and split by kind."""
    path = new_work_dir(spark, "s4-deliveries")
    nested = samples.stored_deliveries(samples.deliveries(spark, sf_dir))
    routing.with_variants(nested).write.parquet(path)
    read = feeds.read_deliveries(spark, path, schema=schemas.STORED_DELIVERY)
    flat = routing.flatten_transactions(routing.route(read))
    feed = Feed(samples.ENDPOINTS, request=REQUEST)
    wanted = subscriptions.subscribe(flat, REQUEST)
    accounts = wanted.filter(F.col("kind") == schemas.OTHER).withColumn(
        "is_duplicate", F.lit(None).cast("boolean")
    )
    columns = ["ordinal", "seq", "kind", "slot", "is_duplicate"]
    found = feed.judge(feed.select(flat))
    return found.select(*columns).unionByName(accounts.select(*columns))


# Filters


@query
def f1_valid_signature(spark, sf_dir):
    feed = routing.valid_signature(samples.deliveries(spark, sf_dir))
    return feed.select("ordinal", "seq", hex_text(F.col("signature")).alias("signature"))


@query
def f2_transaction_filter(spark, sf_dir):
    wanted = subscriptions.transaction_filter(
        include=["tclick", "tview", "terror", "u7"],
        exclude=["m3", "u1"],
        required=["m1"],
        vote=False,
        failed=False,
    )
    return samples.deliveries(spark, sf_dir).filter(wanted).select("ordinal", "seq")


@query
def f3_named_filters(spark, sf_dir):
    each = subscriptions.transaction_filter
    named = subscriptions.named_filters(
        samples.deliveries(spark, sf_dir),
        {
            "votes": each(vote=True),
            "clicks": each(include=["tclick"], failed=False),
            "third": each(required=["m3"], exclude=["tsignup"]),
        },
    )
    return named.select("ordinal", "seq", F.concat_ws(",", "filters").alias("filters"))


def _accounts(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "account string")


def _users(spark, sf_dir, wanted):
    """Accounts out of the events themselves, so the list grows with the table."""
    return samples.read_events(spark, sf_dir).filter(wanted).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("account")
    )


@query
def f2_account_tables(spark, sf_dir):
    """The filter of ``f2_transaction_filter`` with its lists held in tables."""
    tables = subscriptions.AccountTables(
        include=_accounts(spark, "tclick", "tview", "terror", "u7"),
        exclude=_accounts(spark, "m3", "u1"),
        required=_accounts(spark, "m1"),
        vote=False,
        failed=False,
    )
    feed = samples.deliveries(spark, sf_dir)
    return subscriptions.accounts_filter(feed, ["ordinal", "seq"], tables).select("ordinal", "seq")


@query
def f3_account_tables(spark, sf_dir):
    """Named filters whose lists come out of the events."""
    listed = _users(spark, sf_dir, F.col("user_id") % 7 < 3)
    filters = {
        "votes": subscriptions.AccountTables(vote=True),
        "listed": subscriptions.AccountTables(include=listed, failed=False),
        "other_third": subscriptions.AccountTables(exclude=listed, required=_accounts(spark, "m3")),
    }
    named = subscriptions.named_table_filters(samples.deliveries(spark, sf_dir), ["ordinal", "seq"], filters)
    return named.select("ordinal", "seq", F.concat_ws(",", "filters").alias("filters"))


def _account_updates(spark, sf_dir):
    """Every event as an update of the account of its user."""
    return samples.read_events(spark, sf_dir).select(
        "event_id", F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("owner"), "value"
    )


@query
def f4_account_filter(spark, sf_dir):
    wanted = subscriptions.account_filter([f"u{i}" for i in range(0, 50, 7)])
    return _account_updates(spark, sf_dir).filter(wanted).select("event_id", "owner")


@query
def f4_accounts_of_table(spark, sf_dir):
    updates = _account_updates(spark, sf_dir)
    owners = updates.filter(F.col("value") > 150)
    return subscriptions.accounts_of(updates, owners).select("event_id", "owner")


REQUEST = {
    "accounts": {"wallets": {"owner": ["u3", "u5", "u8", "u13"], "filters": []}},
    "transactions": {
        "program": {
            "accountInclude": ["tclick", "tpurchase"],
            "accountExclude": ["m2"],
            "accountRequired": [],
            "vote": False,
            "failed": False,
        },
        "failures": {"accountInclude": ["terror"], "failed": True},
    },
    "slots": {},
    "commitment": "CONFIRMED",
}


@query
def f5_subscribe(spark, sf_dir):
    feed = samples.deliveries(spark, sf_dir).withColumn("owner", F.get("account_keys", F.lit(0)))
    return subscriptions.subscribe(feed, REQUEST).select("ordinal", "seq", "kind")


@query
def f6_commitment(spark, sf_dir):
    # Levels in either letter case, and one that does not exist.
    n, level = F.col("seq"), F.col("commitment")
    told = F.when(n % 17 == 0, F.lit("rooted")).when(n % 5 == 0, F.upper(level)).otherwise(level)
    feed = samples.deliveries(spark, sf_dir).withColumn("commitment", told)
    feed = feed.filter(subscriptions.commitment_at_least())
    rank = subscriptions.commitment_rank(F.col("commitment"))
    return feed.select("ordinal", "seq", "commitment", rank.alias("commitment_rank"))


# Projections


@query
def p1_transaction_events(spark, sf_dir):
    unique, _ = dedup.split_unique(judged(spark, sf_dir))
    made = events.transaction_events(
        unique, ["slot", "fee", "meta_json"], fallback_ms=F.lit(NOW_MS)
    )
    return made.select(
        "signature", "data.slot", "data.fee", "data.meta_json", "source", "timestamp"
    )


@query
def p2_duplicate_events(spark, sf_dir):
    _, duplicates = dedup.split_unique(judged(spark, sf_dir))
    return events.duplicate_events(duplicates, fallback_ms=F.lit(NOW_MS))


@query
def p3_received_time(spark, sf_dir):
    feed = samples.deliveries(spark, sf_dir)
    zero = F.lit(0).cast("bigint")
    given = F.when(F.col("seq") % 7 == 0, zero).when(F.col("seq") % 11 != 0, F.col("received_ms"))
    return feed.select(
        "ordinal", "seq", text.received_time(given, F.lit(NOW_MS)).alias("timestamp")
    )


@query
def p4_render_binary(spark, sf_dir):
    feed = signed(spark, sf_dir)
    part = F.substring("signature", 1, 6)
    record = feed.select(
        "ordinal",
        "seq",
        F.struct(
            "signature",
            F.struct(F.array("signature", part).alias("signatures"), "slot").alias("body"),
            F.create_map(F.lit("head"), part).alias("parts"),
        ).alias("transaction"),
    )
    return render_binary(record).select(
        "ordinal",
        "seq",
        "transaction.signature",
        F.concat_ws(",", "transaction.body.signatures").alias("signatures"),
        F.col("transaction.parts")["head"].alias("head"),
        "transaction.body.slot",
    )


@query
def p5_preview(spark, sf_dir):
    record = samples.deliveries(spark, sf_dir).select(
        "ordinal", "seq", "received_ms", "kind", "slot", "failed", "commitment", "fee"
    )
    shown = preview(record, 6)
    return shown.select(
        "ordinal", "seq", F.array_join("preview", "\n").alias("preview"), "more_lines"
    )


@query
def p6_tx_status(spark, sf_dir):
    feed = samples.deliveries(spark, sf_dir)
    # One of each: unset, the falsy values, and three that count as an error.
    errors = ["null", "false", "0", '""', "0.0", '{"code":1}', '"boom"', "true", "7"]
    err = F.element_at(F.array(*[F.lit(e) for e in errors]), (F.col("seq") % 9 + 1).cast("int"))
    meta = F.when(F.col("seq") % 41 == 0, F.lit(None)).when(F.col("seq") % 43 == 0, F.lit("{}"))
    meta = meta.otherwise(F.concat(F.lit('{"err":'), err, F.lit("}")))
    stored = kept(feed.select("ordinal", "seq", F.parse_json(meta).alias("meta")), "p6-variants")
    return stored.select("ordinal", "seq", payload.tx_status(F.col("meta")).alias("status"))


@query
def p7_tx_meta(spark, sf_dir):
    n = F.col("seq")
    balances = F.to_json(F.transform(F.sequence(F.lit(1), n % 6 + 1), lambda i: i * 1000))
    meta = F.concat(
        F.lit('{"err":'),
        F.when(F.col("failed"), '{"code":1}').otherwise("null"),
        F.when(n % 4 != 0, F.concat(F.lit(',"fee":'), F.col("fee").cast("string"))).otherwise(""),
        F.when(n % 3 != 0, F.concat(F.lit(',"preBalances":'), balances)).otherwise(""),
        F.concat(F.lit(',"postBalances":'), balances),
        F.lit("}"),
    )
    feed = samples.deliveries(spark, sf_dir).select(
        "ordinal", "seq", "slot", F.parse_json(F.when(n % 41 != 0, meta)).alias("meta")
    )
    return payload.tx_meta(kept(feed, "p7-variants")).select(
        "ordinal", "seq", "status", "slot_text", "tx_fee", "accounts_affected"
    )


@query
def p8_matching_logs(spark, sf_dir):
    key = F.col("account_keys")
    logs = F.array(
        F.concat(F.lit("call "), key[0]),
        F.concat(F.lit("log "), key[1], F.lit(" by "), key[0]),
        F.concat(F.lit("end "), key[2]),
    )
    found = payload.matching_logs(logs, ["tclick", "tview", "m4"])
    return samples.deliveries(spark, sf_dir).select(
        "ordinal",
        "seq",
        payload.first_of(found).alias("first_log"),
        F.size(found).alias("n_logs"),
        payload.has_any(found).alias("has_logs"),
    )


@query
def p9_short_signature(spark, sf_dir):
    shown = signed(spark, sf_dir).select("ordinal", "seq", base58("signature").alias("text"))
    return shown.select(
        "ordinal",
        "seq",
        text.short_signature(F.col("text")).alias("short8"),
        text.short_signature(F.col("text"), 12).alias("short12"),
    )


@query
def p10_endpoint_label(spark, sf_dir):
    url = F.col("endpoint")
    return samples.deliveries(spark, sf_dir).select(
        "ordinal",
        "seq",
        text.endpoint_label(url).alias("label"),
        text.endpoint_label(url, drop_scheme=False).alias("url_head"),
    )


@query
def p11_iso_time(spark, sf_dir):
    shown = text.iso_time(F.col("received_ms"))
    return samples.deliveries(spark, sf_dir).select("ordinal", "seq", shown.alias("received_at"))


@query
def p12_status_label(spark, sf_dir):
    made = health.endpoint_events(samples.connection_log(spark, sf_dir))
    status = F.col("status")
    return made.select(
        "seq",
        text.status_label(status).alias("label"),
        text.status_marker(status).alias("marker"),
    )


@query
def p13_error_fields(spark, sf_dir):
    log = samples.connection_log(spark, sf_dir).filter(F.col("details").isNotNull())
    where = F.concat(F.lit("\n    at connect:"), F.col("seq").cast("string"), F.lit("\n  at x"))
    stack = F.when(F.col("seq") % 3 != 0, F.concat("details", where)).otherwise(F.col("details"))
    message = F.col("details")
    return log.select(
        "seq",
        message.alias("message"),
        text.error_code(message).alias("code"),
        text.is_known_error(message).alias("is_known"),
        text.first_frame(stack).alias("frame"),
    )


# Deduplication


@query
def d1_dedup_ttl(spark, sf_dir):
    return judged(spark, sf_dir).select("ordinal", "seq", "is_duplicate", "anchor_ms")


def _keyed_events(spark, sf_dir):
    source = samples.read_events(spark, sf_dir)
    return source.select("user_id", "event_type", samples.event_ms().alias("ts_ms"), "event_id")


@query
def d1_dedup_long_chains(spark, sf_dir):
    keyed = _keyed_events(spark, sf_dir)
    return dedup.dedup_ttl(keyed, ["user_id", "event_type"], "ts_ms", DAY_MS, ["event_id"]).select(
        "event_id", "is_duplicate", "anchor_ms"
    )


@query
def d1_dedup_hot_keys(spark, sf_dir):
    keyed = _keyed_events(spark, sf_dir)
    return dedup.dedup_ttl(
        keyed, "event_type", "ts_ms", HOUR_MS, ["event_id"], hot_rows=100, block_ms=6 * HOUR_MS
    ).select("event_id", "is_duplicate", "anchor_ms")


@query
def d1_missing_times(spark, sf_dir):
    """Every seventh time is 0, every eleventh is missing; the time of reading stands in for them."""
    n = F.col("seq")
    zero = F.lit(0).cast("bigint")
    given = F.when(n % 7 == 0, zero).when(n % 11 != 0, F.col("received_ms"))
    rows = signed(spark, sf_dir).withColumn("received_ms", given)
    found = Feed(samples.ENDPOINTS).judge(rows, fallback_ms=F.lit(NOW_MS))
    return found.select("ordinal", "seq", "received_ms", "is_duplicate", "anchor_ms")


STEPS = 4


def _in_steps(rows: DataFrame, ts: str, work: str, start, after=None) -> None:
    """Deliver rows in slices of equal time to a folder and run a stream query after each of them.

    The query ends after each slice and goes on from its checkpoint: as many micro-batches and one
    restart fewer.
    """
    spark = rows.sparkSession
    first, last = rows.agg(F.min(ts), F.max(ts)).first()
    for i in range(STEPS):
        low, high = (first + (last - first + 1) * k // STEPS for k in (i, i + 1))
        rows.filter((F.col(ts) >= low) & (F.col(ts) < high)).write.mode("append").parquet(f"{work}/in")
        source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 100_000)
        writer = start(source.parquet(f"{work}/in"))
        writer.trigger(availableNow=True).start().awaitTermination()
        if after:
            after(i)


def _slim(spark, sf_dir):
    return signed(spark, sf_dir).select("signature", "received_ms", "ordinal", "seq", "endpoint")


def _table(stream: DataFrame, work: str):
    out = stream.writeStream.format("parquet").option("path", f"{work}/out")
    return out.option("checkpointLocation", f"{work}/checkpoint")


@query
def d2_dedup_stream(spark, sf_dir):
    work = new_work_dir(spark, "d2-stream")

    def start(feed):
        found = stream_dedup.dedup_ttl_stream(feed, "signature", "received_ms", TTL_MS, buckets=64)
        return _table(found.select("ordinal", "seq", "is_duplicate", "anchor_ms"), work)

    _in_steps(_slim(spark, sf_dir), "received_ms", work, start)
    return spark.read.parquet(f"{work}/out")


def _micro_batches(spark, sf_dir, work, after=None, **options):
    job = stream_dedup.MicroBatchDedup(f"{work}/state", "signature", "received_ms", TTL_MS, **options)

    def write(rows: DataFrame, batch_id: int) -> None:
        found = rows.select("ordinal", "seq", "is_duplicate", "anchor_ms")
        found.write.mode("overwrite").parquet(f"{work}/out/batch_id={batch_id}")

    def start(feed):
        each = feed.writeStream.foreachBatch(lambda b, i: job.run(b, i, write))
        return each.option("checkpointLocation", f"{work}/checkpoint")

    _in_steps(_slim(spark, sf_dir), "received_ms", work, start, after and (lambda i: after(job, i)))
    return spark.read.parquet(f"{work}/out").drop("batch_id")


@query
def d2_dedup_micro_batches(spark, sf_dir):
    return _micro_batches(spark, sf_dir, new_work_dir(spark, "d2-batches"))


@query
def d3_expiry(spark, sf_dir):
    """Keys still alive after each micro-batch, when rows may be a day late."""
    found = []

    def count(job, i):
        key_type = signed(spark, sf_dir).schema["signature"].dataType
        live = job.live(spark, key_type, i)
        found.append(live.agg(F.lit(i).alias("batch_id"), F.count("*").alias("n_live")))

    _micro_batches(spark, sf_dir, new_work_dir(spark, "d3-expiry"), count, lateness_ms=DAY_MS)
    return reduce(DataFrame.unionByName, found)


def _bounded_stream(spark, sf_dir, label, look):
    """Run the stateful form with rows up to a day late; ``look`` reads its checkpoint after each step."""
    work = new_work_dir(spark, label)

    def start(feed):
        found = stream_dedup.dedup_ttl_stream(
            feed, "signature", "received_ms", TTL_MS, lateness_ms=DAY_MS, buckets=64
        )
        return _table(found.select("ordinal", "seq", "is_duplicate", "anchor_ms"), work)

    rows, seen = _slim(spark, sf_dir), []

    def after(i):
        # Kept, because later micro-batches change the state that is read.
        seen.append(kept(look(f"{work}/checkpoint", i), label))

    _in_steps(rows, "received_ms", work, start, after)
    return reduce(DataFrame.unionByName, seen)


@query
def d3_state_entries(spark, sf_dir):
    """Keys in the state after each step: timers have let go of those that are too old, in silent buckets too."""

    def look(checkpoint, i):
        held = stream_dedup.state_anchors(spark, checkpoint, "signature")
        return held.agg(
            F.lit(i).alias("step"),
            F.count("*").alias("n_entries"),
            F.count_distinct("signature").alias("n_keys"),
        )

    return _bounded_stream(spark, sf_dir, "d3-state", look)


def _newest_of_steps(spark, sf_dir):
    """The newest time after each step of ``_in_steps``."""
    ts = F.col("received_ms")
    ends = _slim(spark, sf_dir).agg(F.min(ts).alias("first"), F.max(ts).alias("last"))
    first, last = ends.first()
    until = [first + (last - first + 1) * (i + 1) // STEPS for i in range(STEPS)]
    newest = _slim(spark, sf_dir).agg(*[F.max(F.when(ts < u, ts)).alias(f"s{i}") for i, u in enumerate(until)])
    return list(newest.first())


@query
def d5_stream_size(spark, sf_dir):
    """Size of the live keys of a running stream after each step, an hour counting as alive."""
    newest = _newest_of_steps(spark, sf_dir)

    def look(checkpoint, i):
        return stream_dedup.stream_size(spark, checkpoint, "signature", newest[i], HOUR_MS, 16)

    return _bounded_stream(spark, sf_dir, "d5-stream", look)


@query
def d6_stream_live_keys(spark, sf_dir):
    """Live keys of a running stream after each step, read out of its checkpoint."""
    newest = _newest_of_steps(spark, sf_dir)

    def look(checkpoint, i):
        live = stream_dedup.stream_live_keys(spark, checkpoint, "signature", newest[i], HOUR_MS)
        return live.select(F.lit(i).alias("step"), F.lower(F.hex("signature")).alias("signature"), "first_seen_ms")

    return _bounded_stream(spark, sf_dir, "d6-stream", look)


def _judged_stream(feed):
    return stream_dedup.dedup_ttl_stream(feed, "signature", "received_ms", TTL_MS, buckets=64)


@query
def k1_split_sink(spark, sf_dir):
    work = new_work_dir(spark, "k1-split")

    def start(feed):
        return sinks.split_sink(_judged_stream(feed), f"{work}/out", f"{work}/checkpoint")

    _in_steps(_slim(spark, sf_dir), "received_ms", work, start)
    parts = [
        sinks.read_part(spark, f"{work}/out", flag).select(F.lit(part).alias("part"), "ordinal", "seq")
        for part, flag in (("unique", False), ("duplicate", True))
    ]
    return parts[0].unionByName(parts[1])


@query
def k3_callbacks(spark, sf_dir):
    work = new_work_dir(spark, "k3-callbacks")

    def handler(part):
        def store(rows: DataFrame, batch_id: int) -> None:
            rows.write.mode("overwrite").parquet(f"{work}/{part}/batch_id={batch_id}")

        return store

    handlers = {part: handler(part) for part in ("unique", "duplicate")}
    kind = F.when(F.col("is_duplicate"), "duplicate").otherwise("unique")

    def start(feed):
        typed = _judged_stream(feed).withColumn("type", kind)
        return sinks.on_events(typed, handlers, f"{work}/checkpoint")

    _in_steps(_slim(spark, sf_dir), "received_ms", work, start)
    parts = [
        spark.read.parquet(f"{work}/{part}").select(F.lit(part).alias("part"), "ordinal", "seq")
        for part in ("unique", "duplicate")
    ]
    return parts[0].unionByName(parts[1])


@query
def d4_split_unique(spark, sf_dir):
    # Both parts are counted in one pass; the parts themselves are what the sinks write.
    part = F.when(F.col("is_duplicate"), "duplicate").otherwise("unique").alias("part")
    return (
        judged(spark, sf_dir)
        .groupBy("client_id", F.col("endpoint").alias("source"), part)
        .agg(F.count("*").alias("n_rows"))
    )


@query
def d5_occupancy(spark, sf_dir):
    rows = dedup.dedup_ttl(signed(spark, sf_dir), "signature", "received_ms", HOUR_MS)
    return dedup.dedup_occupancy(rows, HOUR_MS, max_size=16, tick_ms=600_000)


@query
def d6_live_signatures(spark, sf_dir):
    rows = dedup.dedup_ttl(signed(spark, sf_dir), "signature", "received_ms", DAY_MS)
    live = dedup.live_keys(rows, "signature", NOW_MS, DAY_MS)
    return live.select(base58("signature").alias("signature"), "first_seen_ms")


# Counts and rates


@query
def a1_dedup_counts(spark, sf_dir):
    return counts.dedup_counts(judged(spark, sf_dir), window_ms=HOUR_MS)


@query
def a2_duplicate_pct(spark, sf_dir):
    by_client = counts.dedup_counts(judged(spark, sf_dir), by=["client_id"])
    return by_client.select("client_id", "n_duplicate", "n_total", "duplicate_pct")


@query
def a3_unique_pct(spark, sf_dir):
    by_level = counts.dedup_counts(judged(spark, sf_dir), by=["commitment"])
    return by_level.select("commitment", "n_unique", "n_total", "unique_pct")


@query
def a4_running_rate(spark, sf_dir):
    rows = kept(judged(spark, sf_dir).select(*samples.ORDER, "is_duplicate"), "a4-judged")
    return counts.running_rate(rows, samples.ORDER, every=10)


@query
def a5_throughput(spark, sf_dir):
    return counts.throughput(samples.deliveries(spark, sf_dir), START_MS, START_MS + 20 * DAY_MS)


@query
def a6_status_counts(spark, sf_dir):
    return counts.status_counts(health.endpoint_events(samples.connection_log(spark, sf_dir)))


@query
def a6_status_counts_wide(spark, sf_dir):
    made = health.endpoint_events(samples.connection_log(spark, sf_dir))
    return counts.status_counts(made, pivot=True)


@query
def a7_connected_summary(spark, sf_dir):
    log = samples.connection_log(spark, sf_dir)
    return counts.connected_summary(health.status_snapshot(log, NOW_MS, configured(spark)))


@query
def a8_run_summary(spark, sf_dir):
    log = samples.connection_log(spark, sf_dir)
    return reports.run_summary(
        judged(spark, sf_dir),
        health.status_snapshot(log, END_MS, configured(spark)),
        health.endpoint_events(log),
        START_MS,
        END_MS,
    )


@query
def a9_first_messages(spark, sf_dir):
    first = counts.first_messages(signed(spark, sf_dir), samples.ORDER, 5)
    status = payload.tx_status(F.parse_json("meta_json"))
    return first.select(
        base58("signature").alias("signature"),
        "ordinal",
        "seq",
        "slot",
        status.alias("status"),
    )


@query
def a10_sequence_numbers(spark, sf_dir):
    rows = kept(judged(spark, sf_dir).select(*samples.ORDER, "is_duplicate"), "a10-judged")
    numbered = counts.sequence_numbers(rows, samples.ORDER, ["is_duplicate"])
    return numbered.select("ordinal", "seq", "is_duplicate", "number")


@query
def prefix_sum_fees(spark, sf_dir):
    feed = samples.deliveries(spark, sf_dir).select(*samples.ORDER, "fee")
    total = prefix_sum(feed, F.col("fee"), samples.ORDER, "fees_so_far")
    return total.select("ordinal", "seq", "fees_so_far")


# Health


@query
def w1_endpoint_events(spark, sf_dir):
    made = health.endpoint_events(samples.connection_log(spark, sf_dir), recovery_details=True)
    return made


@query
def w2_pool_events(spark, sf_dir):
    return health.pool_events(samples.connection_log(spark, sf_dir))


@query
def w3_stale_episodes(spark, sf_dir):
    return health.stale_episodes(samples.connection_log(spark, sf_dir), STALE_MS, END_MS)


@query
def w3_stale_episodes_short(spark, sf_dir):
    return health.stale_episodes(samples.connection_log(spark, sf_dir), 600_000, END_MS)


@query
def w4_stale_detected(spark, sf_dir):
    found = w3_stale_episodes(spark, sf_dir)
    return health.stale_detected(found, START_MS, interval_ms=60_000)


@query
def w5_status_snapshot(spark, sf_dir):
    log = samples.connection_log(spark, sf_dir)
    return health.status_snapshot(log, NOW_MS, configured(spark))


@query
def w6_retry_schedule(spark, sf_dir):
    return health.retry_schedule(samples.connection_log(spark, sf_dir), **RETRY)


@query
def w7_outages(spark, sf_dir):
    return health.outages(samples.connection_log(spark, sf_dir))


@query
def w8_active_endpoints(spark, sf_dir):
    return health.active_endpoints(samples.connection_log(spark, sf_dir))


@query
def w9_status_report(spark, sf_dir):
    return reports.status_report(
        judged(spark, sf_dir),
        samples.connection_log(spark, sf_dir),
        start_ms=START_MS + DAY_MS,
        end_ms=END_MS,
        tick_ms=HOUR_MS,
        ttl_ms=TTL_MS,
    )


STATUS_TICKS = 4


@query
def w9_status_job(spark, sf_dir):
    """The report of two running queries, written by their listener at four ticks."""
    work = new_work_dir(spark, "w9-status")
    tick_ms = (END_MS - START_MS) // STATUS_TICKS
    feed, log = _slim(spark, sf_dir), samples.connection_log(spark, sf_dir)

    def size(tick: int) -> int:
        checkpoint = f"{work}/feed-checkpoint"
        return stream_dedup.stream_size(spark, checkpoint, "signature", tick, TTL_MS, 10_000).first()["size"]

    listener = status.StatusLog(
        spark, f"{work}/status", start_ms=START_MS, tick_ms=tick_ms, ttl_ms=TTL_MS, size=size
    )

    def run(name: str, rows: DataFrame, ts: str, until: int, made) -> int:
        """Deliver the rows up to a tick and run a query over them; gives the number of its last micro-batch."""
        part = rows.filter(F.col(ts) <= until)
        if until - tick_ms > START_MS:  # what came before the start belongs to the first tick
            part = part.filter(F.col(ts) > until - tick_ms)
        part.write.mode("append").parquet(f"{work}/{name}-in")
        source = spark.readStream.schema(rows.schema).parquet(f"{work}/{name}-in")
        out = made(source).writeStream.format("noop").option("checkpointLocation", f"{work}/{name}-checkpoint")
        started = out.trigger(availableNow=True).start()
        started.awaitTermination()
        return started.lastProgress["batchId"]

    def judge(rows):
        found = stream_dedup.dedup_ttl_stream(rows, "signature", "received_ms", TTL_MS, buckets=64)
        return status.observed_feed(found)

    def watch(rows):
        return status.observed_clients(stream_health.endpoint_events_stream(rows, changes=True))

    spark.streams.addListener(listener)
    try:
        for i in range(1, STATUS_TICKS + 1):
            tick = START_MS + i * tick_ms
            last = {
                status.FEED: run("feed", feed, "received_ms", tick, judge),
                status.CLIENTS: run("log", log, "ts_ms", tick, watch),
            }
            # Listeners are told a little later than the query ends.
            deadline = time.monotonic() + 60
            while any(listener.batches.get(n, -1) < b for n, b in last.items()) and time.monotonic() < deadline:
                time.sleep(0.05)
            listener.reached(tick)
    finally:
        spark.streams.removeListener(listener)
    return status.read_status(spark, f"{work}/status")


@query
def w10_endpoint_events_stream(spark, sf_dir):
    work = new_work_dir(spark, "w10-events")
    log = samples.connection_log(spark, sf_dir)
    _in_steps(
        log, "ts_ms", work, lambda rows: _table(stream_health.endpoint_events_stream(rows), work)
    )
    return spark.read.parquet(f"{work}/out")


def _stale_told(spark, sf_dir, label):
    work = new_work_dir(spark, label)
    log = samples.connection_log(spark, sf_dir).filter(F.col("ts_ms") <= END_MS)

    def start(rows):
        return _table(stream_health.stale_episodes_stream(rows, STALE_MS), work)

    _in_steps(log, "ts_ms", work, start)
    return log, spark.read.parquet(f"{work}/out")


@query
def w11_stale_stream(spark, sf_dir):
    """Episodes that a later row has ended."""
    return _stale_told(spark, sf_dir, "w11-stale")[1].filter(F.col("end_ms").isNotNull())


@query
def w11_open_silences(spark, sf_dir):
    """All episodes as the stream knows them at its last watermark, those that still last among them."""
    log, told = _stale_told(spark, sf_dir, "w11-open")
    return stream_health.episodes_at(told, log.agg(F.max("ts_ms")).first()[0])


@query
def j1_endpoint_lookup(spark, sf_dir):
    # The fourth client is not in the list.
    table = feeds.endpoints_table(spark, samples.ENDPOINTS[:3])
    made = health.endpoint_events(samples.connection_log(spark, sf_dir))
    named = health.with_endpoint(counts.status_counts(made), table)
    return named.select("client_id", "endpoint", "status", "n_events")


@query
def k2_event_log(spark, sf_dir):
    log = samples.connection_log(spark, sf_dir)
    rows = judged(spark, sf_dir).withColumn("_text", base58("signature"))
    messages = rows.select(
        F.when(F.col("is_duplicate"), "DUPLICATE").otherwise("TRANSACTION").alias("type"),
        F.col("received_ms").alias("timestamp"),
        text.short_signature(F.col("_text")).alias("sig"),
        text.endpoint_label(F.col("endpoint"), drop_scheme=False).alias("source"),
    )

    reported = kept(log.filter(F.col("kind").isin(*schemas.REPORTED)), "k2-reported")
    points = split_points(reported, health.ORDER)
    pool = health.pool_events(reported, points)
    endpoint = health.endpoint_events(reported, points)
    errors = log.filter(F.col("kind") == schemas.ERROR)
    # The pool's edges are named after what the pool became.
    edges = pool.select(text.status_label(F.col("status")).alias("type"), "timestamp", "status")
    return events.event_log(
        {
            "ENDPOINT": endpoint.select("timestamp", "client_id", "endpoint", "status"),
            "ERROR": errors.select(
                F.col("ts_ms").alias("timestamp"), F.col("details").alias("message")
            ),
        },
        typed=[messages, edges],
    )
