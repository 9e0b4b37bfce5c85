"""Deliveries and a connection log derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamfuse import schemas
from streamfuse.config import Endpoint
from streamfuse.session import use_utc

# The four endpoints; the third URL is used twice.
ENDPOINTS = (
    Endpoint("https://a.feed.example", ping=True),
    Endpoint("https://b.feed.example", ping=True),
    Endpoint("https://c.feed.example", ping=False),
    Endpoint("https://c.feed.example", ping=False),
)

# The configured endpoints: a fifth one that never came up has no row in the log.
CONFIGURED = (*ENDPOINTS, Endpoint("https://d.feed.example", ping=True))

ORDER = ("received_ms", "ordinal", "seq")
LOG_ORDER = ("ts_ms", "seq")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_ms() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def _message(events: DataFrame) -> DataFrame:
    """The columns of one delivery; needs ``ordinal`` beside the columns of ``events``."""
    n, i, kind = F.col("event_id"), F.col("ordinal"), F.col("event_type")
    message_kind = (
        F.when((n % 50 == 0) & (i == 1), schemas.PONG)
        .when((n % 50 == 1) & (i == 2), schemas.OTHER)
        .otherwise(schemas.TRANSACTION)
    )
    has_signature = (message_kind == schemas.TRANSACTION) & ~((i == 2) & (n % 97 == 0))
    text = n.cast("string")
    digest = F.unhex(F.concat(F.sha2(text, 256), F.sha2(F.concat(F.lit("x"), text), 256)))
    # Never null as a whole, so a test for a missing signature need not compute it.
    signature = F.coalesce(digest, F.lit(b""))
    failed = kind == "error"
    meta = F.when(n % 41 == 0, F.lit(None)).otherwise(
        F.when(failed, F.lit('{"err":{"code":1}}')).otherwise(F.lit('{"err":null}'))
    )
    return events.filter((n * 7 + i * 3) % 10 < 8).select(
        "ordinal",
        n.alias("seq"),
        (event_ms() + ((n * 13 + i * 37) % 95) * 1000).alias("received_ms"),
        message_kind.alias("kind"),
        F.when(has_signature, signature).alias("signature"),
        F.floor(n / 10).alias("slot"),
        F.when(n % 31 != 0, kind == "view").alias("is_vote"),
        failed.alias("failed"),
        F.array(
            F.concat(F.lit("u"), F.col("user_id").cast("string")),
            F.concat(F.lit("t"), kind),
            F.concat(F.lit("m"), (n % 5).cast("string")),
        ).alias("account_keys"),
        F.element_at(
            F.array(F.lit("processed"), F.lit("confirmed"), F.lit("finalized")),
            (n % 3 + 1).cast("int"),
        ).alias("commitment"),
        (5000 + n % 7).alias("fee"),
        meta.alias("meta_json"),
    )


def endpoint_deliveries(events: DataFrame, ordinal: int) -> DataFrame:
    """What one endpoint delivers, before it is tagged by the merge."""
    return _message(events.withColumn("ordinal", F.lit(ordinal)))


def deliveries_of(events: DataFrame) -> DataFrame:
    """All endpoints at once, from one pass over the events; also for a streaming source."""
    ordinals = F.array(*[F.lit(i) for i in range(1, len(ENDPOINTS) + 1)])
    urls = F.array(*[F.lit(e.url) for e in ENDPOINTS])
    every = _message(events.withColumn("ordinal", F.explode(ordinals)))
    return every.withColumns(
        {
            "client_id": F.concat(F.lit("client-"), F.col("ordinal").cast("string")),
            "endpoint": F.element_at(urls, F.col("ordinal")),
        }
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deliveries_of(read_events(spark, sf_dir))


def stored_deliveries(rows: DataFrame) -> DataFrame:
    """The same deliveries as nested records, the way a client stores them."""
    n, kind = F.col("seq"), F.col("kind")
    message = F.to_json(F.struct(F.col("account_keys").alias("accountKeys")))
    inner = F.struct(F.array("signature").alias("signatures"), message.alias("message"))
    body = F.struct("signature", F.col("is_vote").alias("isVote"), inner.alias("transaction"))
    nothing = F.lit(None).cast("array<string>")
    transaction = F.struct(
        body.alias("transaction"),
        "slot",
        F.col("meta_json").alias("meta"),
        nothing.alias("filters"),
        F.lit(None).cast("map<string,string>").alias("extra"),
    )
    # Not every other message is an account update.
    is_account = (kind == schemas.OTHER) & (n % 3 != 0)
    return rows.select(
        "client_id",
        "endpoint",
        "ordinal",
        "seq",
        "received_ms",
        F.when(kind == schemas.TRANSACTION, transaction).alias("transaction"),
        F.when(kind == schemas.PONG, F.struct(n.alias("id"))).alias("pong"),
        F.when(is_account, F.struct(F.get("account_keys", F.lit(0)).alias("owner"))).alias("account"),
        "commitment",
    )


def connection_log_of(events: DataFrame) -> DataFrame:
    n, kind = F.col("event_id"), F.col("event_type")
    client = F.pmod(F.col("user_id"), F.lit(4)) + 1
    log_kind = (
        F.when(kind == "signup", schemas.CONNECTED)
        .when((kind == "view") & (n % 4 == 0), schemas.FORCE_RECONNECT)
        .when(kind == "view", schemas.DISCONNECTED)
        .when((kind == "error") & (n % 2 == 0), schemas.ERROR)
        .when(kind == "error", schemas.CONNECT_FAILED)
        .when(kind == "click", schemas.TRANSACTION)
        .when(kind == "purchase", schemas.PONG)
    )
    urls = F.array(*[F.lit(e.url) for e in ENDPOINTS])
    return events.select(
        F.concat(F.lit("client-"), client.cast("string")).alias("client_id"),
        F.element_at(urls, client.cast("int")).alias("endpoint"),
        event_ms().alias("ts_ms"),
        n.alias("seq"),
        log_kind.alias("kind"),
        # One in five has a code that the documentation does not name.
        F.when(
            kind == "error",
            F.concat(F.when(n % 5 == 0, "ODD_CODE: ").otherwise("UNAVAILABLE: "), F.col("props")),
        ).alias("details"),
    )


def connection_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connection_log_of(read_events(spark, sf_dir))
