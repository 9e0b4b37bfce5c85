"""The same results as plain SQL over the test tables, for checking."""

from __future__ import annotations

from streamfuse.plans.queries import (
    DAY_MS,
    END_MS,
    HOUR_MS,
    NOW_MS,
    STALE_MS,
    START_MS,
    TTL_MS,
)

SOURCE = """
ep(i, url) AS (VALUES (1, 'https://a.feed.example'), (2, 'https://b.feed.example'),
    (3, 'https://c.feed.example'), (4, 'https://c.feed.example')),
src AS (SELECT event_id AS n, epoch_us(ts) // 1000 AS t_ms, user_id, event_type, value, props FROM events),
"""

DELIVERIES = (
    SOURCE
    + """
kept AS (SELECT *, CASE WHEN n % 50 = 0 AND i = 1 THEN 'pong' WHEN n % 50 = 1 AND i = 2 THEN 'other'
    ELSE 'transaction' END AS kind FROM src, ep WHERE (n * 7 + i * 3) % 10 < 8),
deliveries AS (SELECT i AS ordinal, n AS seq, t_ms + ((n * 13 + i * 37) % 95) * 1000 AS received_ms, kind,
    CASE WHEN kind = 'transaction' AND NOT (i = 2 AND n % 97 = 0)
        THEN sha256(n::VARCHAR) || sha256('x' || n::VARCHAR) END AS signature,
    n // 10 AS slot, CASE WHEN n % 31 <> 0 THEN event_type = 'view' END AS is_vote,
    event_type = 'error' AS failed,
    ['u' || user_id::VARCHAR, 't' || event_type, 'm' || (n % 5)::VARCHAR] AS account_keys,
    CASE n % 3 WHEN 0 THEN 'processed' WHEN 1 THEN 'confirmed' ELSE 'finalized' END AS commitment,
    5000 + n % 7 AS fee,
    CASE WHEN n % 41 = 0 THEN NULL WHEN event_type = 'error' THEN '{"err":{"code":1}}'
        ELSE '{"err":null}' END AS meta_json,
    'client-' || i::VARCHAR AS client_id, url AS endpoint FROM kept),
signed AS (SELECT * FROM deliveries WHERE signature IS NOT NULL),
"""
)


WANTED = """((kind = 'other' AND account_keys[1] IN ('u3', 'u5', 'u8', 'u13'))
    OR (kind = 'transaction' AND list_has_any(account_keys, ['tclick', 'tpurchase'])
        AND NOT list_contains(account_keys, 'm2') AND NOT coalesce(is_vote, FALSE) AND NOT failed)
    OR (kind = 'transaction' AND list_contains(account_keys, 'terror')))"""


def judged(ttl_ms: int, where: str = "TRUE") -> str:
    """Fold of the rule, one row per key and step."""
    return (
        DELIVERIES
        + f"""
numbered AS (SELECT *, row_number() OVER (PARTITION BY signature ORDER BY received_ms, ordinal, seq) AS rn
    FROM signed WHERE {where}),
folded AS (SELECT signature, rn, received_ms AS anchor_ms, FALSE AS is_duplicate FROM numbered WHERE rn = 1
    UNION ALL
    SELECT d.signature, d.rn,
        CASE WHEN d.received_ms - f.anchor_ms <= {ttl_ms} THEN f.anchor_ms ELSE d.received_ms END,
        d.received_ms - f.anchor_ms <= {ttl_ms}
    FROM folded f JOIN numbered d ON d.signature = f.signature AND d.rn = f.rn + 1),
judged AS (SELECT d.*, f.anchor_ms, f.is_duplicate FROM numbered d JOIN folded f USING (signature, rn)),
"""
    )


LOG = (
    SOURCE
    + """
log AS (SELECT 'client-' || (1 + user_id % 4)::VARCHAR AS client_id, url AS endpoint, t_ms AS ts_ms,
    n AS seq,
    CASE event_type WHEN 'signup' THEN 'connected'
        WHEN 'view' THEN CASE WHEN n % 4 = 0 THEN 'force_reconnect' ELSE 'disconnected' END
        WHEN 'error' THEN CASE WHEN n % 2 = 0 THEN 'error' ELSE 'connect_failed' END
        WHEN 'click' THEN 'transaction' WHEN 'purchase' THEN 'pong' END AS kind,
    CASE WHEN event_type = 'error' THEN CASE WHEN n % 5 = 0 THEN 'ODD_CODE: ' ELSE 'UNAVAILABLE: ' END || props
        END AS details
    FROM src JOIN ep ON ep.i = 1 + user_id % 4),
reported AS (SELECT *, kind = 'connected' AS up,
    lag(kind = 'connected') OVER (PARTITION BY client_id ORDER BY ts_ms, seq) AS was_up
    FROM log WHERE kind IN ('connected', 'disconnected', 'force_reconnect')),
moves AS (SELECT *, up::INT - coalesce(was_up, FALSE)::INT AS change, (was_up IS NULL)::INT AS fresh
    FROM reported),
endpoint_events AS (SELECT *, CASE WHEN up AND was_up = FALSE THEN 'reconnected' WHEN up THEN 'connected'
    ELSE 'disconnected' END AS status FROM reported),
pool AS (SELECT *, sum(change) OVER (ORDER BY ts_ms, seq) AS n_up FROM moves WHERE change <> 0),
flags AS (SELECT *, last_value(CASE WHEN kind <> 'transaction' THEN kind = 'connected' END IGNORE NULLS)
        OVER (PARTITION BY client_id ORDER BY ts_ms, seq) AS own_up,
    coalesce(lead(ts_ms) OVER (PARTITION BY client_id ORDER BY ts_ms, seq), """
    + str(END_MS)
    + """) AS next_ms
    FROM log WHERE kind IN ('transaction', 'connected', 'error', 'disconnected', 'force_reconnect')
        AND ts_ms <= """
    + str(END_MS)
    + f"""),
stale AS (SELECT client_id, ts_ms AS last_message_ms, ts_ms + {STALE_MS} AS stale_from_ms, next_ms AS end_ms
    FROM flags WHERE own_up AND next_ms - ts_ms > {STALE_MS}),
"""
)


# Rows come in four steps of equal time; the newest time after each of them.
STEPS_SQL = """
ends AS (SELECT min(received_ms) AS first, max(received_ms) AS last FROM judged),
bounds AS (SELECT i, first + (last - first + 1) * i // 4 AS since, first + (last - first + 1) * (i + 1) // 4 AS until
    FROM ends, range(4) r(i)),
steps AS (SELECT i, since, until, max(received_ms) AS newest_ms FROM bounds JOIN judged ON received_ms < until GROUP BY ALL)
"""


def snapshot(now_ms: int) -> str:
    """Every configured client, also the fifth, which the log does not know."""
    return f"""
configured AS (SELECT 'client-' || i::VARCHAR AS client_id, url AS endpoint FROM ep
    UNION ALL VALUES ('client-5', 'https://d.feed.example')),
told_of AS (SELECT client_id, coalesce(arg_max(kind = 'connected', (ts_ms, seq)) FILTER (kind IN
        ('connected', 'error', 'disconnected', 'force_reconnect')), FALSE) AS connected,
    max(ts_ms) FILTER (kind IN ('transaction', 'connected')) AS heard_ms
    FROM log WHERE ts_ms <= {now_ms} GROUP BY ALL),
snapshot AS (SELECT client_id, endpoint, coalesce(connected, FALSE) AS connected, heard_ms
    FROM configured LEFT JOIN told_of USING (client_id)),
"""


def share(part: str, whole: str, scale: int = 100) -> str:
    return f"CASE WHEN {whole} > 0 THEN (2 * {scale} * {part} + {whole}) // (2 * {whole}) ELSE 0 END"


def recovered(ms: str) -> str:
    tenths = f"(({ms} + 50) // 100)"
    return (
        f"'Recovered after ' || ({tenths} // 10)::VARCHAR || '.' || ({tenths} % 10)::VARCHAR || ' seconds'"
    )


def select(ctes: str, body: str) -> str:
    return f"WITH RECURSIVE {ctes.strip().rstrip(',')}\n{body.strip()}"


COUNTS = f"""count(*) FILTER (NOT is_duplicate) AS n_unique, count(*) FILTER (is_duplicate) AS n_duplicate,
    count(*) AS n_total"""
JUDGED = judged(TTL_MS)


def keyed_judged(keys: str, ttl_ms: int) -> str:
    """The fold of ``judged`` for events of any key."""
    same = " AND ".join(f"e.{k} = f.{k}" for k in keys.split(", "))
    return select(
        f"""
e AS (SELECT {keys}, epoch_us(ts) // 1000 AS ts_ms, event_id,
    row_number() OVER (PARTITION BY {keys} ORDER BY ts, event_id) AS rn FROM events),
folded AS (SELECT {keys}, rn, event_id, FALSE AS is_duplicate, ts_ms AS anchor_ms FROM e WHERE rn = 1
    UNION ALL
    SELECT {', '.join('e.' + k for k in keys.split(', '))}, e.rn, e.event_id,
        e.ts_ms - f.anchor_ms <= {ttl_ms},
        CASE WHEN e.ts_ms - f.anchor_ms <= {ttl_ms} THEN f.anchor_ms ELSE e.ts_ms END
    FROM folded f JOIN e ON {same} AND e.rn = f.rn + 1),
""",
        "SELECT event_id, is_duplicate, anchor_ms FROM folded",
    )


ENDPOINT_EVENT_DETAILS = f"""
downs AS (SELECT *, max(CASE WHEN NOT up AND coalesce(was_up, TRUE) THEN ts_ms END)
    OVER (PARTITION BY client_id ORDER BY ts_ms, seq) AS down_since FROM endpoint_events),
told AS (SELECT client_id, endpoint, status, ts_ms AS timestamp, seq,
    CASE WHEN status = 'reconnected' THEN {recovered('(ts_ms - down_since)')} ELSE details END AS details
    FROM downs),
"""

ALPHABET = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def base58(source: str) -> str:
    """Long division of 64 bytes in ``hex`` of a table by 58^10, all columns unrolled."""
    step, limbs, passes = 58**10, 8, 10
    first = ", ".join(
        f"('0x' || substr(lpad(hex, 128, '0'), {16 * k + 1}, 16))::UBIGINT::HUGEINT AS q{k}"
        for k in range(limbs)
    )
    parts = [f"pass0 AS (SELECT *, '' AS digits, {first} FROM {source}),"]
    for n in range(1, passes + 1):
        columns, rest = [], "0::HUGEINT"
        for k in range(limbs):
            columns.append(f"{rest} * 18446744073709551616::HUGEINT + q{k} AS v{k}")
            rest = f"(v{k} % {step})"
        quotients = ", ".join(f"v{k} // {step} AS q{k}" for k in range(limbs))
        chars = " || ".join(
            f"substr('{ALPHABET}', ((rest // {58**d}) % 58 + 1)::BIGINT, 1)" for d in range(9, -1, -1)
        )
        parts.append(
            f"div{n} AS (SELECT * EXCLUDE (q0, q1, q2, q3, q4, q5, q6, q7), {', '.join(columns)},"
            f" {rest} AS rest, {quotients} FROM pass{n - 1}),"
            f" pass{n} AS (SELECT * EXCLUDE (digits, rest, v0, v1, v2, v3, v4, v5, v6, v7),"
            f" {chars} || digits AS digits FROM div{n}),"
        )
    zeros = "(length(hex) - length(ltrim(hex, '0'))) // 2"
    parts.append(f"texts AS (SELECT *, repeat('1', {zeros}) || ltrim(digits, '1') AS text FROM pass{passes}),")
    return "\n".join(parts)


def outcome(meta: str) -> str:
    """The outcome of a transaction by the ``err`` of its meta: nothing, null, false, 0 and '' are none."""
    err = f"coalesce(json_extract({meta}, '$.err')::VARCHAR, 'null')"
    return f"""CASE WHEN {err} IN ('null', 'false', '0', '0.0', '""') THEN 'Success' ELSE 'Failed' END"""


def hexed(source: str) -> str:
    """``texts``: the rows of a table with the base58 text of their hexadecimal signature."""
    return f"\nhexed AS (SELECT *, signature AS hex FROM {source}),\n" + base58("hexed")


TIME = "t_ms + ((n * 13 + i * 37) % 95) * 1000 AS received_ms"
TIMED = f"CASE WHEN n % 7 = 0 OR n % 11 = 0 THEN {NOW_MS} ELSE {TIME.replace(' AS received_ms', '')} END AS received_ms"
# A transaction without meta counts as a success.
STORED = judged(TTL_MS, f"commitment IN ('confirmed', 'finalized') AND {WANTED}").replace(
    "event_type = 'error' AS failed", "event_type = 'error' AND n % 41 <> 0 AS failed"
)

ORACLE: dict[str, str] = {
    "s4_stored_deliveries": select(
        STORED,
        """
SELECT ordinal, seq, kind, slot, is_duplicate FROM judged UNION ALL
SELECT ordinal, seq, kind, NULL, NULL FROM deliveries
WHERE kind = 'other' AND seq % 3 <> 0 AND account_keys[1] IN ('u3', 'u5', 'u8', 'u13')
    AND commitment IN ('confirmed', 'finalized')""",
    ),
    "d1_missing_times": select(
        judged(TTL_MS).replace(TIME, TIMED),
        "SELECT ordinal, seq, received_ms, is_duplicate, anchor_ms FROM judged",
    ),
    "d3_expiry": select(
        JUDGED,
        f"""
, ends AS (SELECT min(received_ms) AS first, max(received_ms) AS last FROM judged),
steps AS (SELECT b AS batch_id, first + (last - first + 1) * (b + 1) // 4 AS until FROM ends, range(4) r(b)),
newest AS (SELECT batch_id, until, max(received_ms) AS newest_ms FROM steps JOIN judged ON received_ms < until
    GROUP BY ALL)
SELECT batch_id::INT AS batch_id, count(*) AS n_live FROM (
    SELECT batch_id, newest_ms, signature, max(anchor_ms) AS anchor_ms FROM newest
    JOIN judged ON received_ms < until GROUP BY ALL)
WHERE anchor_ms >= newest_ms - {TTL_MS} - {DAY_MS} GROUP BY ALL""",
    ),
    "k3_callbacks": select(
        JUDGED,
        """
SELECT CASE WHEN is_duplicate THEN 'duplicate' ELSE 'unique' END AS part, ordinal, seq FROM judged""",
    ),
    "d3_state_entries": select(
        JUDGED + STEPS_SQL,
        f"""
, entries AS (SELECT i, signature, max(anchor_ms) AS anchor_ms FROM judged JOIN steps
    ON received_ms >= since AND received_ms < until WHERE NOT is_duplicate GROUP BY ALL),
held AS (SELECT s.i, signature FROM steps s JOIN entries e ON e.i <= s.i
    WHERE (anchor_ms // {TTL_MS // 4} + 1) * {TTL_MS // 4} + {TTL_MS} + {DAY_MS} > newest_ms)
SELECT i::INT AS step, count(*) AS n_entries, count(DISTINCT signature) AS n_keys FROM held GROUP BY ALL""",
    ),
    "d5_stream_size": select(
        JUDGED + STEPS_SQL,
        f"""
, live AS (SELECT i, newest_ms, signature FROM steps JOIN judged ON received_ms < until
    WHERE anchor_ms BETWEEN newest_ms - {HOUR_MS} AND newest_ms GROUP BY ALL)
SELECT newest_ms AS tick_ms, count(signature) AS size, 16::BIGINT AS max_size, {HOUR_MS}::BIGINT AS ttl_ms,
    count(signature) >= 16 AS cap_would_act FROM steps LEFT JOIN live USING (i, newest_ms) GROUP BY newest_ms""",
    ),
    "d6_stream_live_keys": select(
        JUDGED + STEPS_SQL,
        f"""
SELECT i::INT AS step, signature, max(anchor_ms) AS first_seen_ms
FROM steps JOIN judged ON received_ms < until
WHERE NOT is_duplicate AND anchor_ms BETWEEN newest_ms - {HOUR_MS} AND newest_ms GROUP BY ALL""",
    ),
    "w11_open_silences": select(
        LOG,
        f"""
SELECT client_id, last_message_ms, stale_from_ms, least(end_ms, now_ms) AS end_ms
FROM stale, (SELECT max(ts_ms) AS now_ms FROM log WHERE ts_ms <= {END_MS})
WHERE least(end_ms, now_ms) - last_message_ms > {STALE_MS}""",
    ),
    "w11_stale_stream": select(LOG, f"SELECT * FROM stale WHERE end_ms <> {END_MS}"),
    "s1_fan_in": select(
        DELIVERIES, "SELECT client_id, endpoint, ordinal, seq, received_ms, kind FROM deliveries"
    ),
    "s2_fan_in_available": """
SELECT c.client_id, c.endpoint, event_id FROM events, (VALUES ('client-1', 'https://a.feed.example'),
    ('client-3', 'https://c.feed.example')) c(client_id, endpoint)""",
    "s2_broken_source": """
SELECT 'client-' || (event_id % 3 + 1)::VARCHAR AS client_id, count(*) AS n_rows, sum(event_id)::BIGINT AS sum_ids,
    CASE WHEN event_id % 3 = 1 THEN 1 ELSE 0 END::BIGINT AS n_lost FROM events GROUP BY event_id % 3""",
    "s3_endpoints": select(
        DELIVERIES,
        """
SELECT 'client-' || i::VARCHAR AS client_id, i AS ordinal, url AS endpoint, i <= 2 AS ping,
    (SELECT count(*) FROM deliveries d WHERE d.ordinal = ep.i) AS n_delivered FROM ep""",
    ),
    "r1_route": select(
        DELIVERIES,
        """
SELECT ordinal, seq, CASE WHEN kind = 'transaction' THEN 'transaction'
    WHEN kind = 'pong' OR seq % 90 = 0 THEN 'pong' ELSE 'other' END AS kind FROM deliveries""",
    ),
    "f1_valid_signature": select(DELIVERIES, "SELECT ordinal, seq, signature FROM signed"),
    "f2_transaction_filter": select(
        DELIVERIES,
        """
SELECT ordinal, seq FROM deliveries
WHERE list_has_any(account_keys, ['tclick', 'tview', 'terror', 'u7'])
    AND NOT list_has_any(account_keys, ['m3', 'u1']) AND list_contains(account_keys, 'm1')
    AND NOT coalesce(is_vote, FALSE) AND NOT failed""",
    ),
    "f2_account_tables": select(
        DELIVERIES,
        """
SELECT ordinal, seq FROM deliveries
WHERE list_has_any(account_keys, ['tclick', 'tview', 'terror', 'u7'])
    AND NOT list_has_any(account_keys, ['m3', 'u1']) AND list_contains(account_keys, 'm1')
    AND NOT coalesce(is_vote, FALSE) AND NOT failed""",
    ),
    "f3_account_tables": select(
        DELIVERIES,
        """
, listed AS (SELECT DISTINCT 'u' || user_id::VARCHAR AS account FROM events WHERE user_id % 7 < 3),
marked AS (SELECT *, EXISTS (SELECT 1 FROM listed WHERE list_contains(account_keys, account)) AS is_listed FROM deliveries)
SELECT * FROM (SELECT ordinal, seq, concat_ws(',', CASE WHEN coalesce(is_vote, FALSE) THEN 'votes' END,
    CASE WHEN is_listed AND NOT failed THEN 'listed' END,
    CASE WHEN list_contains(account_keys, 'm3') AND NOT is_listed THEN 'other_third' END) AS filters FROM marked) WHERE filters <> ''""",
    ),
    "f3_named_filters": select(
        DELIVERIES,
        """
SELECT * FROM (SELECT ordinal, seq, concat_ws(',', CASE WHEN coalesce(is_vote, FALSE) THEN 'votes' END,
    CASE WHEN list_contains(account_keys, 'tclick') AND NOT failed THEN 'clicks' END,
    CASE WHEN list_contains(account_keys, 'm3') AND NOT list_contains(account_keys, 'tsignup')
        THEN 'third' END) AS filters FROM deliveries) WHERE filters <> ''""",
    ),
    "f4_account_filter": """
SELECT event_id, 'u' || user_id::VARCHAR AS owner FROM events
WHERE user_id IN (0, 7, 14, 21, 28, 35, 42, 49)""",
    "f4_accounts_of_table": """
SELECT event_id, 'u' || user_id::VARCHAR AS owner FROM events
WHERE user_id IN (SELECT user_id FROM events WHERE value > 150)""",
    "f5_subscribe": select(
        DELIVERIES,
        f"""
SELECT ordinal, seq, kind FROM deliveries WHERE commitment IN ('confirmed', 'finalized') AND {WANTED}""",
    ),
    "feed_end_to_end": select(
        judged(TTL_MS, f"commitment IN ('confirmed', 'finalized') AND {WANTED}"),
        f"""
SELECT *, {share('n_unique', 'n_total')} AS unique_pct, {share('n_duplicate', 'n_total')} AS duplicate_pct
FROM (SELECT client_id, endpoint, {COUNTS} FROM judged GROUP BY ALL)""",
    ),
    "f6_commitment": select(
        DELIVERIES,
        """
, told AS (SELECT ordinal, seq, CASE WHEN seq % 17 = 0 THEN 'rooted' WHEN seq % 5 = 0 THEN upper(commitment)
    ELSE commitment END AS commitment FROM deliveries),
levels(name, commitment_rank) AS (VALUES ('processed', 0), ('confirmed', 1), ('finalized', 2))
SELECT ordinal, seq, commitment, commitment_rank FROM told JOIN levels ON lower(commitment) = name
WHERE commitment_rank >= 1""",
    ),
    "p1_transaction_events": select(
        JUDGED + hexed("judged WHERE NOT is_duplicate"),
        """
SELECT text AS signature, slot, fee, meta_json, endpoint AS source, received_ms AS timestamp
FROM texts""",
    ),
    "p2_duplicate_events": select(
        JUDGED + hexed("judged WHERE is_duplicate"),
        "SELECT text AS signature, endpoint AS source, received_ms AS timestamp FROM texts",
    ),
    "p3_received_time": select(
        DELIVERIES,
        f"""
SELECT ordinal, seq, CASE WHEN seq % 7 = 0 OR seq % 11 = 0 THEN {NOW_MS} ELSE received_ms END AS timestamp
FROM deliveries""",
    ),
    "p4_render_binary": select(
        DELIVERIES
        + """
both_parts AS (SELECT ordinal, seq, slot, TRUE AS whole, signature AS hex FROM signed UNION ALL
    SELECT ordinal, seq, slot, FALSE, signature[1:12] FROM signed),
"""
        + base58("both_parts"),
        """
SELECT a.ordinal, a.seq, a.text AS signature, a.text || ',' || b.text AS signatures, b.text AS head, a.slot
FROM texts a JOIN texts b ON a.ordinal = b.ordinal AND a.seq = b.seq AND a.whole AND NOT b.whole""",
    ),
    "p5_preview": select(
        DELIVERIES,
        r"""
SELECT ordinal, seq, '{' || chr(10) || '  "ordinal" : ' || ordinal::VARCHAR || ',' || chr(10)
    || '  "seq" : ' || seq::VARCHAR || ',' || chr(10)
    || '  "received_ms" : ' || received_ms::VARCHAR || ',' || chr(10)
    || '  "kind" : "' || kind || '",' || chr(10) || '  "slot" : ' || slot::VARCHAR || ',' AS preview,
    4 AS more_lines FROM deliveries""",
    ),
    "p6_tx_status": select(
        DELIVERIES,
        f"""
, told AS (SELECT ordinal, seq, CASE WHEN seq % 41 = 0 THEN NULL WHEN seq % 43 = 0 THEN '{{}}'
    ELSE '{{"err":' || ['null', 'false', '0', '""', '0.0', '{{"code":1}}', '"boom"', 'true', '7'][seq % 9 + 1] || '}}'
    END AS meta FROM deliveries)
SELECT ordinal, seq, {outcome('meta')} AS status FROM told""",
    ),
    "p7_tx_meta": select(
        DELIVERIES,
        f"""
, listed AS (SELECT *, '[' || array_to_string([i * 1000 FOR i IN range(1, seq % 6 + 2)], ',') || ']' AS balances
    FROM deliveries),
told AS (SELECT ordinal, seq, slot, CASE WHEN seq % 41 <> 0 THEN
        '{{"err":' || CASE WHEN failed THEN '{{"code":1}}' ELSE 'null' END
        || CASE WHEN seq % 4 <> 0 THEN ',"fee":' || fee::VARCHAR ELSE '' END
        || CASE WHEN seq % 3 <> 0 THEN ',"preBalances":' || balances ELSE '' END
        || ',"postBalances":' || balances || '}}' END AS meta FROM listed)
SELECT ordinal, seq, CASE WHEN meta IS NOT NULL THEN {outcome('meta')} END AS status,
    CASE WHEN meta IS NULL THEN NULL WHEN slot = 0 THEN 'N/A' ELSE slot::VARCHAR END AS slot_text,
    json_extract(meta, '$.fee')::BIGINT AS tx_fee,
    CASE WHEN json_extract(meta, '$.preBalances') IS NOT NULL
        THEN json_array_length(json_extract(meta, '$.postBalances'))::INT END AS accounts_affected
FROM told""",
    ),
    "p8_matching_logs": select(
        DELIVERIES,
        """
, found AS (SELECT ordinal, seq, list_filter(['call ' || account_keys[1],
    'log ' || account_keys[2] || ' by ' || account_keys[1], 'end ' || account_keys[3]],
    lambda x: contains(x, 'tclick') OR contains(x, 'tview') OR contains(x, 'm4')) AS logs FROM deliveries)
SELECT ordinal, seq, logs[1] AS first_log, len(logs)::INT AS n_logs, len(logs) > 0 AS has_logs FROM found""",
    ),
    "p9_short_signature": select(
        DELIVERIES + hexed("signed"),
        """
SELECT ordinal, seq, text[1:8] || '...' AS short8, text[1:12] || '...' AS short12 FROM texts""",
    ),
    "p10_endpoint_label": select(
        DELIVERIES,
        """
SELECT ordinal, seq, replace(split_part(endpoint, '.', 1), 'https://', '') AS label,
    split_part(endpoint, '.', 1) AS url_head FROM deliveries""",
    ),
    "p11_iso_time": select(
        DELIVERIES,
        """
SELECT ordinal, seq, strftime(make_timestamp(received_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS received_at
FROM deliveries""",
    ),
    "p12_status_label": select(
        LOG,
        """
SELECT seq, upper(status) AS label, CASE status WHEN 'connected' THEN 'up' WHEN 'reconnected' THEN 'again'
    ELSE 'down' END AS marker FROM endpoint_events""",
    ),
    "p13_error_fields": select(
        LOG,
        """
SELECT seq, details AS message, regexp_extract(details, '^([A-Z_]+)', 1) AS code,
    regexp_extract(details, '^([A-Z_]+)', 1) IN
        ('UNAUTHENTICATED', 'UNAVAILABLE', 'DEADLINE_EXCEEDED', 'CANCELLED') AS is_known,
    CASE WHEN seq % 3 <> 0 THEN 'at connect:' || seq::VARCHAR END AS frame
FROM log WHERE details IS NOT NULL""",
    ),
    "d1_dedup_ttl": select(JUDGED, "SELECT ordinal, seq, is_duplicate, anchor_ms FROM judged"),
    "d1_dedup_long_chains": keyed_judged("user_id, event_type", DAY_MS),
    "d1_dedup_hot_keys": keyed_judged("event_type", HOUR_MS),
    "d2_dedup_stream": select(JUDGED, "SELECT ordinal, seq, is_duplicate, anchor_ms FROM judged"),
    "d2_dedup_micro_batches": select(
        JUDGED, "SELECT ordinal, seq, is_duplicate, anchor_ms FROM judged"
    ),
    "k1_split_sink": select(
        JUDGED,
        """
SELECT CASE WHEN is_duplicate THEN 'duplicate' ELSE 'unique' END AS part, ordinal, seq FROM judged""",
    ),
    "d4_split_unique": select(
        JUDGED,
        """
SELECT client_id, endpoint AS source, count(*) AS n_rows,
    CASE WHEN is_duplicate THEN 'duplicate' ELSE 'unique' END AS part FROM judged GROUP BY ALL""",
    ),
    "d5_occupancy": select(
        judged(HOUR_MS),
        f"""
, changes AS (SELECT anchor_ms AS at_ms, 1 AS change FROM judged WHERE NOT is_duplicate UNION ALL
    SELECT anchor_ms + {HOUR_MS} + 1, -1 FROM judged WHERE NOT is_duplicate),
per_tick AS (SELECT ((at_ms + 599999) // 600000) * 600000 AS tick_ms, sum(change) AS change
    FROM changes GROUP BY ALL),
spine AS (SELECT unnest(generate_series(min(tick_ms), max(tick_ms), 600000)) AS tick_ms FROM per_tick)
SELECT tick_ms, size, 16::BIGINT AS max_size, {HOUR_MS}::BIGINT AS ttl_ms, size >= 16 AS cap_would_act
FROM (SELECT tick_ms, (sum(coalesce(change, 0)) OVER (ORDER BY tick_ms))::BIGINT AS size
    FROM spine LEFT JOIN per_tick USING (tick_ms))""",
    ),
    "d6_live_signatures": select(
        judged(DAY_MS)
        + f"""
live AS (SELECT signature, max(anchor_ms) AS first_seen_ms FROM judged
    WHERE NOT is_duplicate AND anchor_ms BETWEEN {NOW_MS - DAY_MS} AND {NOW_MS} GROUP BY ALL),
"""
        + hexed("live"),
        "SELECT text AS signature, first_seen_ms FROM texts",
    ),
    "a1_dedup_counts": select(
        JUDGED,
        f"""
SELECT *, {share('n_unique', 'n_total')} AS unique_pct, {share('n_duplicate', 'n_total')} AS duplicate_pct
FROM (SELECT received_ms - received_ms % {HOUR_MS} AS window_start_ms, {COUNTS} FROM judged GROUP BY ALL)""",
    ),
    "a2_duplicate_pct": select(
        JUDGED,
        f"""
SELECT client_id, n_duplicate, n_total, {share('n_duplicate', 'n_total')} AS duplicate_pct
FROM (SELECT client_id, {COUNTS} FROM judged GROUP BY ALL)""",
    ),
    "a3_unique_pct": select(
        JUDGED,
        f"""
SELECT commitment, n_unique, n_total, {share('n_unique', 'n_total')} AS unique_pct
FROM (SELECT commitment, {COUNTS} FROM judged GROUP BY ALL)""",
    ),
    "a4_running_rate": select(
        JUDGED,
        f"""
, running AS (SELECT row_number() OVER o AS n_messages, (sum(is_duplicate::INT) OVER o)::BIGINT AS n_duplicates
    FROM judged WINDOW o AS (ORDER BY received_ms, ordinal, seq))
SELECT n_messages, n_duplicates, ({share('(n_messages - n_duplicates)', 'n_messages', 1000)}) / 10 AS unique_share
FROM running WHERE n_messages % 10 = 0""",
    ),
    "a5_throughput": select(
        DELIVERIES,
        f"""
SELECT n_messages, ({share('n_messages', f'{20 * DAY_MS}::BIGINT', 10000)}) / 10 AS messages_per_second
FROM (SELECT count(*) AS n_messages FROM deliveries
    WHERE received_ms BETWEEN {START_MS} AND {START_MS + 20 * DAY_MS})""",
    ),
    "a6_status_counts": select(
        LOG, "SELECT client_id, status, count(*) AS n_events FROM endpoint_events GROUP BY ALL"
    ),
    "a6_status_counts_wide": select(
        LOG,
        """
SELECT client_id, count(*) FILTER (status = 'connected') AS connected,
    count(*) FILTER (status = 'disconnected') AS disconnected,
    count(*) FILTER (status = 'reconnected') AS reconnected FROM endpoint_events GROUP BY ALL""",
    ),
    "a7_connected_summary": select(
        LOG + snapshot(NOW_MS),
        "SELECT count(*) FILTER (connected) AS n_connected, count(*) AS n_clients FROM snapshot",
    ),
    "a8_run_summary": select(
        JUDGED + LOG.replace(SOURCE, "") + snapshot(END_MS),
        f"""
, per_status AS (SELECT client_id, status, count(*) AS n FROM endpoint_events GROUP BY ALL)
SELECT ({END_MS - START_MS} + 500) // 1000 AS duration_s,
    count(*) FILTER (NOT is_duplicate) AS n_unique, count(*) FILTER (is_duplicate) AS n_duplicate,
    count(*) AS n_total,
    (SELECT string_agg(x, '; ' ORDER BY x) FROM (SELECT client_id || ' ' ||
        CASE WHEN connected THEN 'CONNECTED' ELSE 'DISCONNECTED' END AS x FROM snapshot)) AS states,
    (SELECT string_agg(x, '; ' ORDER BY x) FROM (SELECT client_id || ' ' || status || ' ' || n::VARCHAR AS x
        FROM per_status)) AS events
FROM judged""",
    ),
    "a9_first_messages": select(
        DELIVERIES
        + """
earliest AS (SELECT * FROM signed ORDER BY received_ms, ordinal, seq LIMIT 5),
"""
        + hexed("earliest"),
        """
SELECT text AS signature, ordinal, seq, slot,
    """
        + outcome("meta_json")
        + " AS status FROM texts",
    ),
    "a10_sequence_numbers": select(
        JUDGED,
        """
SELECT ordinal, seq, is_duplicate,
    row_number() OVER (PARTITION BY is_duplicate ORDER BY received_ms, ordinal, seq) AS number FROM judged""",
    ),
    "prefix_sum_fees": select(
        DELIVERIES,
        """
SELECT ordinal, seq, (sum(fee) OVER (ORDER BY received_ms, ordinal, seq))::BIGINT AS fees_so_far
FROM deliveries""",
    ),
    "w1_endpoint_events": select(LOG + ENDPOINT_EVENT_DETAILS, "SELECT * FROM told"),
    "w2_pool_events": select(
        LOG,
        """
SELECT CASE WHEN change = 1 THEN 'connected' ELSE 'disconnected' END AS status, ts_ms AS timestamp, seq
FROM pool WHERE (change = 1 AND n_up = 1) OR n_up = 0""",
    ),
    "w3_stale_episodes": select(LOG, "SELECT * FROM stale"),
    "w3_stale_episodes_short": select(
        LOG.replace(f"{STALE_MS}", "600000"), "SELECT * FROM stale"
    ),
    "w4_stale_detected": select(
        LOG,
        f"""
SELECT * FROM (SELECT *, {START_MS} + ((stale_from_ms - {START_MS}) // 60000 + 1) * 60000 AS detected_ms
    FROM stale) WHERE detected_ms < end_ms""",
    ),
    "w5_status_snapshot": select(
        LOG + snapshot(NOW_MS),
        f"""
SELECT client_id, endpoint, connected, CASE WHEN connected THEN {NOW_MS} - heard_ms END
    AS time_since_last_message FROM snapshot""",
    ),
    "w6_retry_schedule": select(
        LOG
        + """
runs AS (SELECT *, kind IN ('error', 'disconnected', 'connect_failed') AS failure,
    sum((kind IN ('connected', 'force_reconnect'))::INT) OVER (PARTITION BY client_id ORDER BY ts_ms, seq)
        AS run FROM log WHERE kind NOT IN ('transaction', 'pong')),
tries AS (SELECT *, row_number() OVER (PARTITION BY client_id, run ORDER BY ts_ms, seq) - 1 AS attempt,
    lead(ts_ms) OVER (PARTITION BY client_id ORDER BY ts_ms, seq) AS next_ms FROM runs WHERE failure),
delays AS (SELECT *, least(600000 * pow(2, attempt), 3600000)::BIGINT AS delay_ms FROM tries),
""",
        """
SELECT client_id, ts_ms, seq, kind, attempt, delay_ms, ts_ms + delay_ms AS retry_at_ms,
    coalesce(next_ms < ts_ms + delay_ms, FALSE) AS replaced FROM delays""",
    ),
    "w7_outages": select(
        LOG
        + """
edges AS (SELECT *, min(CASE WHEN up THEN ts_ms END) OVER (PARTITION BY client_id ORDER BY ts_ms, seq
    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS end_ms FROM reported),
""",
        f"""
SELECT client_id, ts_ms AS start_ms, seq, end_ms, end_ms - ts_ms AS duration_ms,
    {recovered('(end_ms - ts_ms)')} AS details FROM edges WHERE NOT up AND coalesce(was_up, TRUE)""",
    ),
    "w8_active_endpoints": select(
        LOG,
        """
SELECT client_id, ts_ms AS timestamp, seq, (sum(change) OVER o)::BIGINT AS n_active,
    (sum(fresh) OVER o)::BIGINT AS n_seen FROM moves WINDOW o AS (ORDER BY ts_ms, seq)""",
    ),
    "w9_status_report": select(
        JUDGED
        + LOG.replace(SOURCE, "")
        + f"""
spine AS (SELECT unnest(generate_series({START_MS + DAY_MS + HOUR_MS}, {END_MS}, {HOUR_MS})) AS tick_ms),
""",
        f"""
SELECT tick_ms, (tick_ms - {START_MS + DAY_MS} + 500) // 1000 AS uptime_s,
    (SELECT sum(change) FROM moves WHERE ts_ms <= tick_ms)::BIGINT AS active,
    (SELECT sum(fresh) FROM moves WHERE ts_ms <= tick_ms)::BIGINT AS seen,
    (SELECT count(*) FROM judged WHERE NOT is_duplicate AND received_ms <= tick_ms) AS transactions,
    (SELECT count(*) FROM judged WHERE is_duplicate AND received_ms <= tick_ms) AS duplicates,
    (SELECT count(*) FROM judged WHERE NOT is_duplicate AND anchor_ms <= tick_ms
        AND anchor_ms + {TTL_MS} >= tick_ms) AS size,
    10000::BIGINT AS max_size, {TTL_MS}::BIGINT AS ttl_ms
FROM spine""",
    ),
    "w9_status_job": select(
        JUDGED
        + LOG.replace(SOURCE, "")
        + f"""
spine AS (SELECT unnest(generate_series({START_MS + (END_MS - START_MS) // 4}, {END_MS}, {(END_MS - START_MS) // 4})) AS tick_ms),
""",
        f"""
SELECT tick_ms, (tick_ms - {START_MS} + 500) // 1000 AS uptime_s,
    (SELECT sum(change) FROM moves WHERE ts_ms <= tick_ms)::BIGINT AS active,
    (SELECT sum(fresh) FROM moves WHERE ts_ms <= tick_ms)::BIGINT AS seen,
    (SELECT count(*) FROM judged WHERE NOT is_duplicate AND received_ms <= tick_ms) AS transactions,
    (SELECT count(*) FROM judged WHERE is_duplicate AND received_ms <= tick_ms) AS duplicates,
    (SELECT count(*) FROM judged WHERE NOT is_duplicate AND anchor_ms <= tick_ms
        AND anchor_ms + {TTL_MS} >= tick_ms) AS size,
    10000::BIGINT AS max_size, {TTL_MS}::BIGINT AS ttl_ms
FROM spine""",
    ),
    "w10_endpoint_events_stream": select(
        LOG,
        """
SELECT client_id, endpoint, status, ts_ms AS timestamp, seq, details FROM endpoint_events""",
    ),
    "j1_endpoint_lookup": select(
        LOG,
        """
SELECT client_id, CASE WHEN client_id = 'client-4' THEN 'unknown' ELSE endpoint END AS endpoint, status,
    count(*) AS n_events FROM endpoint_events GROUP BY ALL""",
    ),
    "k2_event_log": select(
        JUDGED + LOG.replace(SOURCE, "") + hexed("judged"),
        """
SELECT CASE WHEN is_duplicate THEN 'DUPLICATE' ELSE 'TRANSACTION' END AS type, received_ms AS timestamp,
    '{"sig":"' || text[1:8] || '...","source":"' || split_part(endpoint, '.', 1) || '"}' AS payload
FROM texts UNION ALL
SELECT CASE WHEN change = 1 THEN 'CONNECTED' ELSE 'DISCONNECTED' END, ts_ms, '{"status":"' || CASE WHEN change = 1 THEN 'connected' ELSE 'disconnected' END || '"}'
FROM pool WHERE (change = 1 AND n_up = 1) OR n_up = 0 UNION ALL
SELECT 'ENDPOINT', ts_ms, '{"client_id":"' || client_id || '","endpoint":"' || endpoint || '","status":"'
    || status || '"}' FROM endpoint_events UNION ALL
SELECT 'ERROR', ts_ms, '{"message":"' || replace(details, '"', '\\"') || '"}' FROM log WHERE kind = 'error'""",
    ),
}
