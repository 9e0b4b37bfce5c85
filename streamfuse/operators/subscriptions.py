"""Subscriptions compiled to predicates: accounts, votes, failures and commitment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamfuse import schemas
from streamfuse.config import (
    COMMITMENT_LEVELS,
    DEFAULT_COMMITMENT,
    SubscribeRequest,
    TransactionFilter,
)


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _all(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def _any(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(False)


def transaction_filter(
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    required: Sequence[str] = (),
    vote: bool | None = None,
    failed: bool | None = None,
    *,
    account_keys: str = "account_keys",
    is_vote: str = "is_vote",
    is_failed: str = "failed",
) -> Column:
    """All given constraints together; never null.

    Any of ``include``, none of ``exclude``, all of ``required``. ``vote`` must equal the flag.
    ``failed=False`` drops failed transactions, ``failed=True`` lets them in. Missing flags
    read as false, missing keys as none.
    """
    keys = F.coalesce(F.col(account_keys), F.array().cast("array<string>"))

    def overlaps(values):
        return F.coalesce(F.arrays_overlap(keys, _strings(values)), F.lit(False))

    parts = []
    # Plain flags first: they are cheap and reach the file scan.
    if vote is not None:
        parts.append(F.coalesce(F.col(is_vote), F.lit(False)) == vote)
    if failed is False:
        parts.append(~F.coalesce(F.col(is_failed), F.lit(False)))
    if include:
        parts.append(overlaps(include))
    if exclude:
        parts.append(~overlaps(exclude))
    if required:
        parts.append(F.size(F.array_except(_strings(required), keys)) == 0)
    return _all(parts)


def _from_spec(spec: TransactionFilter) -> Column:
    return transaction_filter(
        spec.account_include, spec.account_exclude, spec.account_required, spec.vote, spec.failed
    )


def account_filter(owner: Sequence[str], column: str = "owner") -> Column:
    """Account updates of the listed owners; an empty list is no constraint."""
    return F.coalesce(F.col(column).isin(list(owner)), F.lit(False)) if owner else F.lit(True)


def accounts_of(df: DataFrame, owners: DataFrame, column: str = "owner") -> DataFrame:
    """The same for a list of owners held in a table; joined by its measured size."""
    return df.join(owners.select(column).distinct(), column, "left_semi")


def named_filters(
    df: DataFrame, predicates: Mapping[str, Column], name: str = "filters"
) -> DataFrame:
    """Keep rows any filter matches, with the names of those that did, in the given order."""
    matched = F.array_compact(F.array(*[F.when(p, F.lit(n)) for n, p in predicates.items()]))
    return df.withColumn(name, matched).filter(F.size(name) > 0)


@dataclass(frozen=True)
class AccountTables:
    """A transaction filter whose account lists are tables with a column ``account``; an empty list is no constraint."""

    include: DataFrame | None = None
    exclude: DataFrame | None = None
    required: DataFrame | None = None
    vote: bool | None = None
    failed: bool | None = None


def named_table_filters(
    df: DataFrame,
    row_id: Sequence[str],
    filters: Mapping[str, AccountTables],
    name: str = "filters",
    *,
    account_keys: str = "account_keys",
) -> DataFrame:
    """``named_filters`` of transaction filters with account lists of any length.

    ``row_id`` are columns that tell rows apart and are never null. Only these and the single accounts of a row are joined with the
    lists, which the engine does by their measured sizes, with a Bloom filter of the lists where both sides are large. What a row
    has of each list is counted, and the counts come back to the row by one more join.
    """
    order = list(filters)
    tables, numbers, constrained = [], {}, set()
    for i, (_, f) in enumerate(filters.items()):
        for kind in ("include", "exclude", "required"):
            table = getattr(f, kind)
            if table is None:
                continue
            listed = table.select(F.col("account").cast("string").alias("_account")).filter(F.col("_account").isNotNull()).distinct()
            numbers[i, kind] = listed.count()
            if numbers[i, kind]:
                constrained.add((i, kind))
                tables.append(listed.withColumns({"_filter": F.lit(i), "_kind": F.lit(kind)}))
    marked = df
    if tables:
        keys = df.select(*row_id, F.explode(F.array_distinct(account_keys)).alias("_account"))
        met = keys.join(reduce(DataFrame.unionByName, tables), "_account").groupBy(*row_id, "_filter").agg(
            *[F.count_if(F.col("_kind") == kind).alias(kind) for kind in ("include", "exclude", "required")]
        )
        counts = F.struct("include", "exclude", "required")
        met = met.groupBy(*row_id).agg(F.map_from_entries(F.collect_list(F.struct("_filter", counts.alias("n")))).alias("_met"))
        marked = df.join(met, list(row_id), "left")

    def count(i: int, kind: str) -> Column:
        return F.coalesce(F.try_element_at("_met", F.lit(i))[kind], F.lit(0))

    predicates = {}
    for i, f in enumerate(filters.values()):
        parts = [transaction_filter(vote=f.vote, failed=f.failed)]
        if (i, "include") in constrained:
            parts.append(count(i, "include") > 0)
        if (i, "exclude") in constrained:
            parts.append(count(i, "exclude") == 0)
        if (i, "required") in constrained:
            parts.append(count(i, "required") == numbers[i, "required"])
        predicates[order[i]] = _all(parts)
    return named_filters(marked, predicates, name).select(*[c for c in df.columns if c != name], name)


def accounts_filter(df: DataFrame, row_id: Sequence[str], tables: AccountTables, **columns: str) -> DataFrame:
    """The rows that one such filter lets through."""
    return named_table_filters(df, row_id, {"": tables}, "_matched", **columns).drop("_matched")


def commitment_rank(column: Column) -> Column:
    """0, 1, 2 in ascending certainty, in either letter case; null for anything else."""
    rank = F.lit(None).cast("int")
    for i, level in enumerate(COMMITMENT_LEVELS):
        rank = F.when(F.lower(column) == level, F.lit(i)).otherwise(rank)
    return rank


def commitment_at_least(level: str = DEFAULT_COMMITMENT, column: str = "commitment") -> Column:
    """The levels from ``level`` up, as a plain list so that it reaches the file scan."""
    wanted = COMMITMENT_LEVELS[COMMITMENT_LEVELS.index(level.lower()) :]
    return F.coalesce(F.lower(column).isin(list(wanted)), F.lit(False))


def request_predicates(request: SubscribeRequest | Mapping) -> dict[str, Column]:
    """One predicate per named filter, each guarded by the kind of message it speaks of."""
    if not isinstance(request, SubscribeRequest):
        request = SubscribeRequest.from_dict(request)
    is_transaction = F.col("kind") == schemas.TRANSACTION
    # Other messages have no owner: slots, blocks and the like are no account updates.
    is_account = (F.col("kind") == schemas.OTHER) & F.col("owner").isNotNull()
    out: dict[str, Column] = {}
    for name, spec in request.transactions.items():
        out[name] = is_transaction & _from_spec(spec)
    for name, spec in request.accounts.items():
        out[name] = is_account & account_filter(spec.owner)
    return out


def subscribe(df: DataFrame, request: SubscribeRequest | Mapping) -> DataFrame:
    """One filter for the whole request: any named filter, at the wanted commitment.

    A request without any named filter subscribes to nothing. Rows must tell their commitment if the
    request names one; a feed without that column has been filtered at its source.
    """
    if not isinstance(request, SubscribeRequest):
        request = SubscribeRequest.from_dict(request)
    wanted = _any(list(request_predicates(request).values()))
    if request.commitment and "commitment" not in df.columns:
        raise ValueError("the request names a commitment, but the feed has no such column")
    if "commitment" in df.columns:
        wanted = commitment_at_least(request.commitment or DEFAULT_COMMITMENT) & wanted
    return df.filter(wanted)
