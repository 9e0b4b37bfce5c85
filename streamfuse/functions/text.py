"""Short texts shown beside events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error codes the documentation of the feed names.
ERROR_CODES = ("UNAUTHENTICATED", "UNAVAILABLE", "DEADLINE_EXCEEDED", "CANCELLED")


def received_time(received_ms: Column, fallback_ms: Column) -> Column:
    """The receive time; a missing or zero one is replaced."""
    return F.coalesce(F.nullif(received_ms, F.lit(0).cast("bigint")), fallback_ms)


def short_signature(text: Column, n: int = 8) -> Column:
    return F.concat(F.substring(text, 1, n), F.lit("..."))


def endpoint_label(url: Column, drop_scheme: bool = True) -> Column:
    """Text before the first dot, with or without the scheme."""
    head = F.split_part(url, F.lit("."), F.lit(1))
    return F.replace(head, F.lit("https://"), F.lit("")) if drop_scheme else head


def iso_time(ms: Column) -> Column:
    """ISO-8601 in UTC with milliseconds; the session time zone must be UTC."""
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def status_label(status: Column) -> Column:
    return F.upper(status)


def status_marker(status: Column) -> Column:
    """up, again or down."""
    return (
        F.when(status == "connected", "up").when(status == "reconnected", "again").otherwise("down")
    )


def client_state(connected: Column) -> Column:
    return F.when(connected, "CONNECTED").otherwise("DISCONNECTED")


def error_code(message: Column) -> Column:
    """The leading code of an error message, or an empty text."""
    return F.regexp_extract(message, "^([A-Z_]+)", 1)


def is_known_error(message: Column) -> Column:
    return error_code(message).isin(list(ERROR_CODES))


def first_frame(stack: Column) -> Column:
    """First stack frame, trimmed; null when there is none."""
    return F.trim(F.get(F.split(stack, "\n"), F.lit(1)))


def recovered_text(duration_ms: Column) -> Column:
    """Like ``Recovered after 2.3 seconds``, rounded half up; null for an open outage."""
    tenths = F.call_function("div", duration_ms + 50, F.lit(100))
    seconds = F.call_function("div", tenths, F.lit(10)).cast("string")
    tenth = F.pmod(tenths, F.lit(10)).cast("string")
    return F.concat(F.lit("Recovered after "), seconds, F.lit("."), tenth, F.lit(" seconds"))
