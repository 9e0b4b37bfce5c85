"""Endpoint health over the connection log ``(client_id, endpoint, ts_ms, seq, kind, details)``.

Two notions of "up" are kept apart: what the pool hears (connects and disconnects; an error says
nothing) and the client's own flag (an error clears it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamfuse import schemas
from streamfuse.config import PoolOptions
from streamfuse.functions.text import recovered_text
from streamfuse.operators.ordered import scan, split_points
from streamfuse.operators.ticks import next_tick
from streamfuse.session import kept

ORDER = ("ts_ms", "seq")
CLIENT = ("client_id",)


def _kind_in(kinds: Sequence[str]) -> Column:
    return F.col("kind").isin(list(kinds))


def _placed(
    rows: DataFrame, points: Sequence[Row] | None, label: str
) -> tuple[DataFrame, Sequence[Row]]:
    """Rows to scan in order and the points to cut them at.

    Without points, the few rows that matter are kept in the shared folder first: the points and every
    scan read them there, and the log is read once. With points nothing runs before the query does.
    """
    if points is None:
        rows = kept(rows, label)
        points = split_points(rows, ORDER)
    return rows, points


def _between_scans(scanned: DataFrame, points: Sequence[Row] | None, label: str) -> DataFrame:
    """A scan reads its input twice; what a scan made is kept for the next one, under the same condition."""
    return kept(scanned, label) if points is None else scanned


def _reported(log: DataFrame, points: Sequence[Row] | None) -> tuple[DataFrame, Sequence[Row]]:
    """Connects and disconnects with the state the pool had for the client before each of them."""
    given = points
    rows, points = _placed(log.filter(_kind_in(schemas.REPORTED)), points, "reported")
    up = F.col("kind") == schemas.CONNECTED
    known = scan(
        rows.withColumn("_up", up),
        ORDER,
        CLIENT,
        points=points,
        previous={"_was_up": F.col("_up")},
        keep_blocks=True,
    )
    return _between_scans(known, given, "reported-known"), points


def _changes(known: DataFrame) -> DataFrame:
    """Effect of each reported row on the number of clients up, and of clients seen."""
    up, was_up = F.col("_up"), F.coalesce("_was_up", F.lit(False))
    return known.withColumns(
        {
            "_change": up.cast("int") - was_up.cast("int"),
            "_new": F.col("_was_up").isNull().cast("int"),
        }
    )


def endpoint_events(
    log: DataFrame, points: Sequence[Row] | None = None, recovery_details: bool = False
) -> DataFrame:
    """``connected``, ``reconnected`` (after a disconnect) and ``disconnected`` (even if repeated).

    With ``recovery_details`` a reconnect says how long the outage was.
    """
    known, points = _reported(log, points)
    up, was_up = F.col("_up"), F.col("_was_up")
    status = (
        F.when(up & (was_up == F.lit(False)), "reconnected")
        .when(up, "connected")
        .otherwise("disconnected")
    )
    events = known.withColumn("status", status)
    details = F.col("details")
    if recovery_details:
        opens = ~up & F.coalesce(was_up, F.lit(True))
        events = scan(
            events,
            ORDER,
            CLIENT,
            points=points,
            latest={"_down_since": F.when(opens, F.col("ts_ms"))},
        )
        lasted = F.col("ts_ms") - F.col("_down_since")
        details = F.when(F.col("status") == "reconnected", recovered_text(lasted)).otherwise(
            details
        )
    return events.select(
        "client_id",
        "endpoint",
        "status",
        F.col("ts_ms").alias("timestamp"),
        "seq",
        details.alias("details"),
    )


def pool_events(log: DataFrame, points: Sequence[Row] | None = None) -> DataFrame:
    """``connected`` when the first client comes up, ``disconnected`` when the last one goes."""
    known, points = _reported(log, points)
    moves = _changes(known).filter(F.col("_change") != 0).select(*ORDER, "_change")
    running = scan(moves, ORDER, points=points, sums={"n_up": F.col("_change")})
    leaves = (F.col("_change") == 1) & (F.col("n_up") == 1)
    returns = F.col("n_up") == 0
    return running.filter(leaves | returns).select(
        F.when(leaves, "connected").otherwise("disconnected").alias("status"),
        F.col("ts_ms").alias("timestamp"),
        "seq",
    )


def active_endpoints(log: DataFrame, points: Sequence[Row] | None = None) -> DataFrame:
    """After each endpoint event: clients up, of the clients seen so far."""
    known, points = _reported(log, points)
    moves = _changes(known).select("client_id", *ORDER, "_change", "_new")
    running = scan(
        moves, ORDER, points=points, sums={"n_active": F.col("_change"), "n_seen": F.col("_new")}
    )
    return running.select(
        "client_id", F.col("ts_ms").alias("timestamp"), "seq", "n_active", "n_seen"
    )


def stale_episodes(log: DataFrame, stale_ms: int, end_ms: int) -> DataFrame:
    """Times a connected client heard nothing for longer than ``stale_ms``; pongs do not count.

    Within a cell of ``stale_ms + 1`` no such gap fits, so each client's rows shrink to one per cell
    before they shuffle: first and last time, and the flag the cell ends with.
    """
    cell = (F.col("ts_ms") - F.pmod(F.col("ts_ms"), F.lit(stale_ms + 1))).alias("_cell")
    rows = log.filter(
        _kind_in((schemas.TRANSACTION, *schemas.OWN_FLAG)) & (F.col("ts_ms") <= end_ms)
    )
    spans = rows.groupBy("client_id", cell).agg(
        F.min("ts_ms").alias("_first_ms"), F.max("ts_ms").alias("last_message_ms")
    )
    # The few flag rows apart, so that the many message rows aggregate on plain numbers.
    flags = (
        rows.filter(_kind_in(schemas.OWN_FLAG))
        .groupBy("client_id", cell)
        .agg(F.max_by(F.col("kind") == schemas.CONNECTED, F.struct(*ORDER)).alias("_flag"))
    )
    per_client = Window.partitionBy("client_id").orderBy("_cell")
    upto = per_client.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    quiet_until = F.coalesce(F.lead("_first_ms").over(per_client), F.lit(end_ms).cast("bigint"))
    return (
        spans.join(flags, ["client_id", "_cell"], "left")
        .withColumns(
            {"_up": F.last("_flag", ignorenulls=True).over(upto), "end_ms": quiet_until}
        )
        .filter(F.col("_up") & (F.col("end_ms") - F.col("last_message_ms") > stale_ms))
        .select(
            "client_id",
            "last_message_ms",
            (F.col("last_message_ms") + stale_ms).alias("stale_from_ms"),
            "end_ms",
        )
    )


def stale_detected(
    episodes: DataFrame, t0_ms: int, options: PoolOptions | None = None, interval_ms: int = 0
) -> DataFrame:
    """First check past the limit, for episodes a check falls into; checks run from ``t0_ms`` on."""
    interval = interval_ms or (options or PoolOptions()).stale_check_interval_ms
    limit = F.col("stale_from_ms")
    tick = limit - F.pmod(limit - t0_ms, F.lit(interval)) + interval
    detected = F.greatest(tick, F.lit(t0_ms + interval).cast("bigint"))
    return episodes.withColumn("detected_ms", detected).filter(
        F.col("detected_ms") < F.col("end_ms")
    )


def status_snapshot(
    log: DataFrame, now_ms: int, endpoints: DataFrame | None = None
) -> DataFrame:
    """Every client's flag at ``now_ms`` and, when it is up, the time since its last message.

    With the configured ``endpoints`` every one of them has a row: a client that never came up has
    nothing in the log and is not connected. Without them, clients are those of the log.
    """
    past = log.filter(F.col("ts_ms") <= now_ms)
    heard = past.groupBy("client_id", "endpoint").agg(
        F.max(F.when(_kind_in(schemas.REFRESH), F.col("ts_ms"))).alias("_heard_ms")
    )
    flags = (
        past.filter(_kind_in(schemas.OWN_FLAG))
        .groupBy("client_id")
        .agg(F.max_by(F.col("kind") == schemas.CONNECTED, F.struct(*ORDER)).alias("_flag"))
    )
    connected = F.coalesce("_flag", F.lit(False))
    if endpoints is not None:
        # The endpoints are a local table of known size.
        listed = endpoints.select("client_id", "endpoint")
        heard = listed.join(heard.drop("endpoint"), "client_id", "left")
    return heard.join(flags, "client_id", "left").select(
        "client_id",
        "endpoint",
        connected.alias("connected"),
        F.when(connected, F.lit(now_ms) - F.col("_heard_ms")).alias("time_since_last_message"),
    )


def retry_schedule(
    log: DataFrame,
    initial_ms: int = PoolOptions.initial_retry_delay_ms,
    factor: float = PoolOptions.retry_backoff_factor,
    cap_ms: int = PoolOptions.max_retry_delay_ms,
    points: Sequence[Row] | None = None,
) -> DataFrame:
    """Delay after each failure; the attempt counts failures since the last success or forced
    reconnect, from 0. A later failure of the client replaces a retry that has not run yet.
    """
    counted = log.filter(_kind_in((*schemas.RETRY_FAILURE, *schemas.RETRY_RESET)))
    given = points
    rows, points = _placed(counted, points, "failures")
    failure = _kind_in(schemas.RETRY_FAILURE)
    counted = scan(
        rows.withColumn("_failure", failure),
        ORDER,
        CLIENT,
        points=points,
        sums={"_failures": F.col("_failure").cast("bigint")},
        following={"_next_ms": F.when(F.col("_failure"), F.col("ts_ms"))},
        keep_blocks=True,
    )
    based = scan(
        _between_scans(counted, given, "failures-counted"),
        ORDER,
        CLIENT,
        points=points,
        latest={"_base": F.when(~F.col("_failure"), F.col("_failures"))},
    )
    attempt = F.col("_failures") - F.coalesce("_base", F.lit(0)) - 1
    grown = F.lit(float(initial_ms)) * F.pow(F.lit(float(factor)), F.col("attempt"))
    delay = F.least(grown, F.lit(float(cap_ms))).cast("bigint")
    return (
        based.filter("_failure")
        .withColumn("attempt", attempt)
        .withColumn("delay_ms", delay)
        .select(
            "client_id",
            "ts_ms",
            "seq",
            "kind",
            "attempt",
            "delay_ms",
            (F.col("ts_ms") + F.col("delay_ms")).alias("retry_at_ms"),
            F.coalesce(
                F.col("_next_ms") < F.col("ts_ms") + F.col("delay_ms"), F.lit(False)
            ).alias("replaced"),
        )
    )


def outages(log: DataFrame, points: Sequence[Row] | None = None) -> DataFrame:
    """Each down period of a client: first disconnect to next connect, open ones without an end."""
    known, points = _reported(log, points)
    up = F.col("_up")
    edges = known.filter(up | F.coalesce("_was_up", F.lit(True)))
    ended = scan(
        edges, ORDER, CLIENT, points=points, following={"end_ms": F.when(up, F.col("ts_ms"))}
    )
    lasted = F.col("end_ms") - F.col("start_ms")
    return (
        ended.filter(~up)
        .select("client_id", F.col("ts_ms").alias("start_ms"), "seq", "end_ms")
        .withColumns({"duration_ms": lasted, "details": recovered_text(lasted)})
    )


def with_endpoint(df: DataFrame, endpoints: DataFrame, default: str = "unknown") -> DataFrame:
    """Look up the endpoint of each client. The configured list is a local table of known size."""
    named = endpoints.select("client_id", F.col("endpoint").alias("_endpoint"))
    return (
        df.drop("endpoint")
        .join(named, "client_id", "left")
        .withColumn("endpoint", F.coalesce("_endpoint", F.lit(default)))
        .drop("_endpoint")
    )


def client_changes_per_tick(
    log: DataFrame, tick_ms: int, start_ms: int, points: Sequence[Row] | None = None
) -> DataFrame:
    """Change of the clients up and seen per report tick; totals at ticks need no global order."""
    known, _ = _reported(log, points)
    return (
        _changes(known)
        .select((F.col("ts_ms") - start_ms).alias("_at"), "_change", "_new")
        .groupBy((next_tick("_at", tick_ms) + start_ms).alias("tick_ms"))
        .agg(F.sum("_change").alias("active"), F.sum("_new").alias("seen"))
    )
