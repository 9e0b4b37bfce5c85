"""The event families users see, and one log of all of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamfuse.functions.base58 import base58
from streamfuse.functions.text import received_time


def transaction_events(
    unique: DataFrame,
    data: Sequence[str],
    *,
    text: Callable[[Column], Column] = base58,
    fallback_ms: Column | None = None,
) -> DataFrame:
    """Signature text, payload, source and receive time of unique transactions.

    The signature is encoded here, after the split, so duplicates never pay for it twice.
    """
    fallback = fallback_ms if fallback_ms is not None else F.unix_millis(F.current_timestamp())
    return unique.select(
        text(F.col("signature")).alias("signature"),
        F.struct(*data).alias("data"),
        F.col("endpoint").alias("source"),
        received_time(F.col("received_ms"), fallback).alias("timestamp"),
    )


def duplicate_events(
    duplicates: DataFrame,
    *,
    text: Callable[[Column], Column] = base58,
    fallback_ms: Column | None = None,
) -> DataFrame:
    """Signature text, source and time of filtered duplicates."""
    fallback = fallback_ms if fallback_ms is not None else F.unix_millis(F.current_timestamp())
    return duplicates.select(
        text(F.col("signature")).alias("signature"),
        F.col("endpoint").alias("source"),
        received_time(F.col("received_ms"), fallback).alias("timestamp"),
    )


def event_log(
    families: Mapping[str, DataFrame],
    timestamp: str = "timestamp",
    typed: Sequence[DataFrame] = (),
) -> DataFrame:
    """All families as (type, timestamp, payload); the payload is the rest of the row as JSON.

    Tables in ``typed`` hold several families and tell them apart in a column ``type``, so that what
    they were made from is read once.
    """

    def projected(kind: Column, df: DataFrame) -> DataFrame:
        rest = [c for c in df.columns if c not in (timestamp, "type")]
        return df.select(
            kind.alias("type"),
            F.col(timestamp).alias("timestamp"),
            F.to_json(F.struct(*rest)).alias("payload"),
        )

    parts = [projected(F.lit(k), df) for k, df in families.items()]
    parts += [projected(F.col("type"), df) for df in typed]
    return reduce(DataFrame.unionByName, parts)
