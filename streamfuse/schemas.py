"""Column layouts of the records the jobs exchange."""

from __future__ import annotations

# A stored delivery: one message from one endpoint.
DELIVERY = """
    client_id string, endpoint string, ordinal int, seq bigint, received_ms bigint,
    transaction struct<
        transaction: struct<
            signature: binary, isVote: boolean,
            transaction: struct<signatures: array<binary>, message: string>>,
        slot: bigint,
        meta: string,
        filters: array<string>,
        extra: map<string, string>>,
    pong struct<id: bigint>,
    account struct<owner: string>,
    commitment string
"""

# The same with its open parts as variants, the form to store: paths are read out of them without parsing a text.
STORED_DELIVERY = (
    DELIVERY.replace("message: string", "message: variant")
    .replace("meta: string", "meta: variant")
    .replace("map<string, string>", "map<string, variant>")
)

# One row per transition or message of one client, in the order (ts_ms, seq).
CONNECTION_LOG = (
    "client_id string, endpoint string, ts_ms bigint, seq bigint, kind string, details string"
)

ENDPOINTS = "client_id string, ordinal int, endpoint string, ping boolean"

# Kinds of the connection log.
CONNECTED = "connected"
DISCONNECTED = "disconnected"
ERROR = "error"
CONNECT_FAILED = "connect_failed"
FORCE_RECONNECT = "force_reconnect"
TRANSACTION = "transaction"
PONG = "pong"
OTHER = "other"

# What the pool hears about a client: an error reports nothing and leaves the client counted as up.
REPORTED_DOWN = (DISCONNECTED, FORCE_RECONNECT)
REPORTED = (CONNECTED, *REPORTED_DOWN)
# What the client knows of itself: an error clears its own flag.
OWN_DOWN = (ERROR, DISCONNECTED, FORCE_RECONNECT)
OWN_FLAG = (CONNECTED, *OWN_DOWN)
# Rows that restart the staleness clock.
REFRESH = (TRANSACTION, CONNECTED)
# Rows that advance the retry counter, and rows that reset it.
RETRY_FAILURE = (ERROR, DISCONNECTED, CONNECT_FAILED)
RETRY_RESET = (CONNECTED, FORCE_RECONNECT)
