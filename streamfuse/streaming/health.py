"""Endpoint events and staleness of an unbounded connection log."""

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from streamfuse import schemas
from streamfuse.session import use_keyed_state
from streamfuse.streaming.clock import with_clock


class _Client(StatefulProcessor):
    """One value of state per client."""

    schema = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.client = handle.getValueState("client", self.schema)

    def sorted(self, chunks: Iterator[pd.DataFrame]) -> pd.DataFrame:
        return pd.concat(list(chunks), ignore_index=True).sort_values(["ts_ms", "seq"])

    def close(self) -> None:
        pass


class _Transitions(_Client):
    schema = "up boolean"

    def handleInputRows(self, _key, chunks, _timers) -> Iterator[pd.DataFrame]:
        rows = self.sorted(chunks)
        up = rows["kind"] == schemas.CONNECTED
        was_up = up.astype("object").shift(1)
        known = self.client.exists()
        if known:
            was_up.iloc[0] = bool(self.client.get()[0])
        status = up.map({True: "connected", False: "disconnected"})
        status[up & (was_up == False)] = "reconnected"  # noqa: E712 - a missing flag is not False
        self.client.update((bool(up.iloc[-1]),))
        first = pd.Series(False, index=rows.index)
        first.iloc[0] = not known
        yield pd.DataFrame(
            {
                "client_id": rows["client_id"],
                "endpoint": rows["endpoint"],
                "_status": status,
                "timestamp": rows["ts_ms"],
                "seq": rows["seq"],
                "details": rows["details"],
                # A client nobody has heard of is not up.
                "change": up.astype("int64") - (was_up == True).astype("int64"),  # noqa: E712
                "first": first,
            }
        )


def endpoint_events_stream(log: DataFrame, changes: bool = False) -> DataFrame:
    """Endpoint events of a stream; the state is one flag per client.

    Only connects and disconnects are shuffled; messages, the bulk of a log, are filtered before. With ``changes`` each
    event also tells by how many it changes the clients that are up, and whether it is its client's first.
    """
    use_keyed_state(log.sparkSession)
    made = (
        log.filter(F.col("kind").isin(list(schemas.REPORTED)))
        .groupBy("client_id")
        .transformWithStateInPandas(
            _Transitions(),
            "client_id string, endpoint string, _status string, timestamp bigint, seq bigint,"
            " details string, change bigint, first boolean",
            "append",
            "none",
        )
    )
    # Renaming makes plain rows of the Arrow ones, which a sink that sorts cannot take.
    made = made.withColumnRenamed("_status", "status")
    return made if changes else made.drop("change", "first")


def _latest_messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the messages in each Arrow batch only the latest per client; all flag rows."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        messages = pc.equal(table["kind"], schemas.TRANSACTION)
        latest = table.filter(messages).group_by("client_id").aggregate(
            [("ts_ms", "max"), ("seq", "max")]
        )
        latest = latest.rename_columns(["client_id", "ts_ms", "seq"]).append_column(
            "kind", pa.array([schemas.TRANSACTION] * latest.num_rows, pa.string())
        )
        kept = pa.concat_tables(
            [table.filter(pc.invert(messages)), latest.select(table.column_names)]
        )
        yield from kept.combine_chunks().to_batches()


def _slim(log: DataFrame) -> DataFrame:
    kinds = F.col("kind").isin(schemas.TRANSACTION, *schemas.OWN_FLAG)
    return log.filter(kinds).select("client_id", "ts_ms", "seq", "kind")


def stale_stream(log: DataFrame, stale_ms: int) -> DataFrame:
    """One row whenever a connected client was silent for ``stale_ms`` of wall-clock time.

    Every message or connect restarts the client's timer, going down stops it. Messages are combined
    to the latest per client before the shuffle, so a busy client does not load one task.
    """

    class Silent(_Client):
        schema = "up boolean, heard_ms bigint, timer_ms bigint"

        def handleInputRows(self, _key, chunks, timers) -> Iterator[pd.DataFrame]:
            up, heard, timer = self.client.get() if self.client.exists() else (False, None, None)
            rows = self.sorted(chunks)
            flags = rows[rows["kind"].isin(schemas.OWN_FLAG)]
            if len(flags):
                up = bool(flags["kind"].iloc[-1] == schemas.CONNECTED)
            refreshed = rows[rows["kind"].isin(schemas.REFRESH)]
            if len(refreshed):
                latest = int(refreshed["ts_ms"].max())
                heard = latest if heard is None else max(heard, latest)
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = timers.getCurrentProcessingTimeInMs() + stale_ms if up else None
            if timer is not None:
                self.handle.registerTimer(timer)
            self.client.update((up, heard, timer))
            yield pd.DataFrame({"client_id": pd.Series(dtype=str), "_heard_ms": pd.Series(dtype="int64")})

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            up, heard, _ = self.client.get()
            self.client.update((up, heard, None))  # no timer until the next message or connect
            yield pd.DataFrame({"client_id": [key[0]], "_heard_ms": [heard]})

    use_keyed_state(log.sparkSession)
    slim = _slim(log)
    found = (
        slim.mapInArrow(_latest_messages, slim.schema)
        .groupBy("client_id")
        .transformWithStateInPandas(
            Silent(), "client_id string, _heard_ms bigint", "append", "ProcessingTime"
        )
    )
    return found.withColumnRenamed("_heard_ms", "last_message_ms")


def _cell_ends(stale_ms: int):
    """Of the rows of one client and cell of ``stale_ms + 1`` only the first, the last and the last flag."""

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pandas().sort_values(["client_id", "ts_ms", "seq"])
            cell = [rows["client_id"], rows["ts_ms"] // (stale_ms + 1)]
            flag = rows["kind"].isin(schemas.OWN_FLAG)
            ends = pd.concat(
                [rows.groupby(cell).head(1), rows.groupby(cell).tail(1), rows[flag].groupby([c[flag] for c in cell]).tail(1)]
            )
            ends = ends[~ends.index.duplicated()]
            yield pa.RecordBatch.from_pandas(ends, schema=batch.schema, preserve_index=False)

    return shrink


def stale_episodes_stream(log: DataFrame, stale_ms: int) -> DataFrame:
    """The episodes of ``health.stale_episodes`` by the log's own clock, the newest time of its rows, of whatever kind and client.

    A silence is told twice: with a null ``end_ms`` as soon as the clock is past its limit, by an event-time timer of the client,
    and with its end when a later row ends it. One that starts and ends inside a micro-batch is told once, with its end.
    ``episodes_at`` makes episodes of both. Rows of a client must not come in an earlier micro-batch than rows before them.
    No gap longer than ``stale_ms`` fits into a cell of one millisecond more, so each task keeps the ends of its cells only.
    """

    class Gaps(_Client):
        schema = "up boolean, last_ms bigint, timer_ms bigint"

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            if key[0] is None:
                return
            up, last, timer = self.client.get() if self.client.exists() else (False, None, None)
            found = self.sorted(rows)
            flag = found["kind"].isin(schemas.OWN_FLAG)
            state = (found["kind"] == schemas.CONNECTED).astype(float).where(flag).ffill()
            state = state.fillna(float(up)) == 1.0
            times = found["ts_ms"].astype("int64")
            before = times.shift(1)
            was_up = state.shift(1, fill_value=False)
            if last is not None:
                before.iloc[0], was_up.iloc[0] = last, up
            quiet = was_up & (times - before > stale_ms)
            if timer is not None:
                self.handle.deleteTimer(timer)
            up, last = bool(state.iloc[-1]), int(times.iloc[-1])
            # A timer is due when the clock is at it, a silence lasts longer than its limit.
            timer = last + stale_ms + 1 if up else None
            if timer is not None:
                self.handle.registerTimer(timer)
            self.client.update((up, last, timer))
            yield pd.DataFrame(
                {
                    "client_id": key[0],
                    "_last_ms": before[quiet].astype("int64"),
                    "_end_ms": times[quiet].astype("Int64"),
                }
            )

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            up, last, timer = self.client.get()
            if timer != expiredTimerInfo.getExpiryTimeInMs():
                return
            self.client.update((up, last, None))
            yield pd.DataFrame({"client_id": [key[0]], "_last_ms": [last], "_end_ms": pd.array([pd.NA], dtype="Int64")})

    use_keyed_state(log.sparkSession)
    slim = _slim(log)
    clocked = with_clock(slim.mapInArrow(_cell_ends(stale_ms), slim.schema), "ts_ms", {}, whole=log)
    found = clocked.groupBy("client_id").transformWithStateInPandas(
        Gaps(), "client_id string, _last_ms bigint, _end_ms bigint", "append", "EventTime"
    )
    return found.select(
        "client_id",
        F.col("_last_ms").alias("last_message_ms"),
        (F.col("_last_ms") + stale_ms).alias("stale_from_ms"),
        F.col("_end_ms").alias("end_ms"),
    )


def episodes_at(told: DataFrame, now_ms: int) -> DataFrame:
    """Episodes from what ``stale_episodes_stream`` has told so far; one that still lasts ends at ``now_ms``."""
    known = told.groupBy("client_id", "last_message_ms", "stale_from_ms").agg(F.max("end_ms").alias("end_ms"))
    return known.withColumn("end_ms", F.coalesce("end_ms", F.lit(now_ms).cast("bigint")))


def newest_of(query) -> int | None:
    """The clock of a query of ``stale_episodes_stream``, in milliseconds: the watermark of its last micro-batch."""
    marks = [p["eventTime"].get("watermark") for p in query.recentProgress if p.get("eventTime")]
    marks = [m for m in marks if m and not m.startswith("1970-01-01T00:00:00")]
    if not marks:
        return None
    return round(datetime.fromisoformat(marks[-1].replace("Z", "+00:00")).timestamp() * 1000)
