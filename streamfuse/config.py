"""Options, endpoints and subscription requests, as plain dataclasses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

# Commitment levels in ascending order of certainty.
COMMITMENT_LEVELS = ("processed", "confirmed", "finalized")
DEFAULT_COMMITMENT = "confirmed"


@dataclass(frozen=True)
class Endpoint:
    """One source of the feed. Access tokens are deliberately not kept here."""

    url: str
    ping: bool = False


@dataclass(frozen=True)
class PoolOptions:
    """Timings and limits. All durations are milliseconds. The defaults are fixed values."""

    ping_interval_ms: int = 30_000
    stale_timeout_ms: int = 120_000
    dedup_ttl_ms: int = 60_000
    max_cache_size: int = 10_000
    initial_retry_delay_ms: int = 500
    max_retry_delay_ms: int = 30_000
    retry_backoff_factor: float = 2.0
    min_stale_check_ms: int = 1_000
    max_stale_check_ms: int = 60_000

    @property
    def stale_check_interval_ms(self) -> int:
        """A tenth of the stale timeout, held between the two bounds."""
        tenth = self.stale_timeout_ms // 10
        return max(self.min_stale_check_ms, min(tenth, self.max_stale_check_ms))


@dataclass(frozen=True)
class TransactionFilter:
    """Account lists plus vote and failed flags; an empty list or None is no constraint."""

    account_include: Sequence[str] = ()
    account_exclude: Sequence[str] = ()
    account_required: Sequence[str] = ()
    vote: bool | None = None
    failed: bool | None = None


@dataclass(frozen=True)
class AccountFilter:
    owner: Sequence[str] = ()


def _only(part: str, given: Mapping, evaluated: Sequence[str]) -> None:
    """Refuse what would be ignored."""
    ignored = sorted(k for k, v in given.items() if k not in evaluated and v not in (None, {}, [], ()))
    if ignored:
        raise ValueError(f"{part}: not evaluated here: {', '.join(ignored)}")


@dataclass(frozen=True)
class SubscribeRequest:
    """Named filters per section; filters are OR-ed, the fields of one filter AND-ed."""

    accounts: Mapping[str, AccountFilter] = field(default_factory=dict)
    transactions: Mapping[str, TransactionFilter] = field(default_factory=dict)
    commitment: str | None = None

    @classmethod
    def from_dict(cls, request: Mapping) -> SubscribeRequest:
        """Read the wire form (camelCase keys). Missing, null and empty parts are no constraint; a part
        that nothing here evaluates must be empty, or the result would not be what was asked for.
        """
        _only("request", request, ("accounts", "transactions", "commitment"))
        for name, spec in (request.get("accounts") or {}).items():
            _only(f"accounts.{name}", spec, ("owner",))
        for name, spec in (request.get("transactions") or {}).items():
            known = ("accountInclude", "accountExclude", "accountRequired", "vote", "failed")
            _only(f"transactions.{name}", spec, known)
        accounts = {
            name: AccountFilter(owner=tuple(spec.get("owner") or ()))
            for name, spec in (request.get("accounts") or {}).items()
        }
        transactions = {
            name: TransactionFilter(
                account_include=tuple(spec.get("accountInclude") or ()),
                account_exclude=tuple(spec.get("accountExclude") or ()),
                account_required=tuple(spec.get("accountRequired") or ()),
                vote=spec.get("vote"),
                failed=spec.get("failed"),
            )
            for name, spec in (request.get("transactions") or {}).items()
        }
        return cls(accounts, transactions, request.get("commitment"))
