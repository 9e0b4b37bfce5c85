"""Reading the open part of a transaction: outcome, fee, balances, log lines."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def failed(meta: Column) -> Column:
    """Whether ``err`` of a variant holds anything: not missing, null, false, 0 or an empty text."""
    err = F.try_variant_get(meta, "$.err", "variant")
    kind = F.schema_of_variant(err)
    number = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$")
    return (
        F.when(err.isNull() | (kind == "VOID"), F.lit(False))
        .when(kind == "BOOLEAN", F.try_variant_get(meta, "$.err", "boolean"))
        .when(kind == "STRING", F.try_variant_get(meta, "$.err", "string") != "")
        .when(number, F.try_variant_get(meta, "$.err", "double") != 0)
        .otherwise(F.lit(True))
    )


def tx_status(meta: Column) -> Column:
    """``Success`` unless the error is set; a transaction without meta counts as a success."""
    return F.when(F.coalesce(failed(meta), F.lit(False)), "Failed").otherwise("Success")


def slot_text(slot: Column) -> Column:
    """The slot, or N/A when it is missing or 0."""
    return F.when(slot != 0, slot.cast("string")).otherwise("N/A")


def fee(meta: Column) -> Column:
    return F.try_variant_get(meta, "$.fee", "bigint")


def accounts_affected(meta: Column) -> Column:
    """Number of balances after the transaction, when balances before and after are both there."""
    before = F.try_variant_get(meta, "$.preBalances", "array<bigint>")
    after = F.try_variant_get(meta, "$.postBalances", "array<bigint>")
    return F.when(before.isNotNull() & after.isNotNull(), F.size(after))


def tx_meta(df: DataFrame, meta: str = "meta", slot: str = "slot") -> DataFrame:
    """Add outcome, slot text, fee and accounts affected, for rows that have meta at all."""
    m, there = F.col(meta), F.col(meta).isNotNull()
    return df.withColumns(
        {
            "status": F.when(there, tx_status(m)),
            "slot_text": F.when(there, slot_text(F.col(slot))),
            "tx_fee": fee(m),
            "accounts_affected": accounts_affected(m),
        }
    )


def matching_logs(logs: Column, needles: Sequence[str]) -> Column:
    """Log lines that contain any of the texts, in their order."""
    return F.filter(
        logs, lambda line: reduce(lambda a, b: a | b, [line.contains(n) for n in needles])
    )


def first_of(lines: Column) -> Column:
    return F.try_element_at(lines, F.lit(1))


def has_any(lines: Column) -> Column:
    return F.coalesce(F.size(lines) > 0, F.lit(False))
