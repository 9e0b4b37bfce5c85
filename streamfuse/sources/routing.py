"""Classification of messages by the payload they carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamfuse import schemas
from streamfuse.functions.payload import failed


def message_kind(transaction: Column, pong: Column) -> Column:
    """A message with both payloads counts as a transaction."""
    return (
        F.when(transaction.isNotNull(), F.lit(schemas.TRANSACTION))
        .when(pong.isNotNull(), F.lit(schemas.PONG))
        .otherwise(F.lit(schemas.OTHER))
    )


def route(df: DataFrame, transaction: str = "transaction", pong: str = "pong") -> DataFrame:
    """Add ``kind``; pongs and other messages stay visible so that their loss can be counted."""
    return df.withColumn("kind", message_kind(F.col(transaction), F.col(pong)))


def transactions_only(df: DataFrame) -> DataFrame:
    """Only transactions reach the user."""
    return df.filter(F.col("kind") == schemas.TRANSACTION)


def valid_signature(df: DataFrame, signature: str = "signature") -> DataFrame:
    """Keep rows with a signature. A signature of no bytes is valid, a missing one is not."""
    return df.filter(F.col(signature).isNotNull())


def with_variants(deliveries: DataFrame) -> DataFrame:
    """Deliveries with JSON texts as ``schemas.STORED_DELIVERY``: message, meta and extra values as variants.

    A text that is no JSON becomes null, as it has no path to be read.
    """
    extra = F.transform_values("transaction.extra", lambda _, v: F.try_parse_json(v))
    made = (
        F.col("transaction")
        .withField("transaction.transaction.message", F.try_parse_json("transaction.transaction.transaction.message"))
        .withField("meta", F.try_parse_json("transaction.meta"))
        .withField("extra", extra)
    )
    return deliveries.withColumn("transaction", made)


def _variant(df: DataFrame, path: str) -> Column:
    """A field of the payload as a variant, whether it is stored as one or as a JSON text."""
    kind: T.DataType = df.schema
    for part in path.split("."):
        kind = kind[part].dataType
    return F.col(path) if isinstance(kind, T.VariantType) else F.try_parse_json(path)


def flatten_transactions(df: DataFrame) -> DataFrame:
    """Lift the fields that later steps filter and shuffle on out of the nested payload.

    What a subscription speaks of comes along: the account keys of the message, whether the
    transaction failed, the owner of an account update. The commitment is a column of the delivery. Message and meta may be
    variants or JSON texts.
    """
    body = F.col("transaction.transaction")
    meta = _variant(df, "transaction.meta")
    message = _variant(df, "transaction.transaction.transaction.message")
    lifted = df.withColumns(
        {
            "signature": body["signature"],
            "is_vote": body["isVote"],
            "slot": F.col("transaction.slot"),
            "meta": meta,
            "account_keys": F.try_variant_get(message, "$.accountKeys", "array<string>"),
            "failed": F.when(F.col("transaction").isNotNull(), failed(meta)),
        }
    )
    if "account" in df.columns:
        lifted = lifted.withColumn("owner", F.col("account.owner"))
    return lifted
