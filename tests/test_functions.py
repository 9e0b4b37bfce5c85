import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamfuse.functions import base58 as b58
from streamfuse.functions import payload, text
from streamfuse.functions.render import preview, render_binary


def plain(value):
    """Base58 digit by digit."""
    if value is None:
        return None
    number, digits = int.from_bytes(value, "big"), ""
    while number:
        number, d = divmod(number, 58)
        digits = chr(b58.ALPHABET[d]) + digits
    zeros = len(value) - len(value.lstrip(b"\0"))
    return "1" * zeros + digits


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.binary(max_size=70)), max_size=12))
def test_encode_equals_digit_by_digit(values):
    got = b58.encode(pa.array(values, pa.binary())).to_pylist()
    assert got == [plain(v) for v in values]
    sliced = pa.array([b"pad", *values, b"pad"], pa.binary()).slice(1, len(values))
    assert b58.encode(sliced).to_pylist() == got


def test_known_texts():
    values = [bytes.fromhex("0000287fb4cd"), b"", b"\0\0", b"hello world", b"\xff" * 64]
    got = b58.encode(pa.array(values, pa.binary())).to_pylist()
    assert got[:4] == ["11233QC4", "", "11", "StV1DL6CwTryKyV"]
    assert len(got[4]) == 88


def test_nested_records(spark):
    schema = (
        "id int, flat binary, deep struct<a: struct<b: binary, c: int>, l: array<binary>,"
        " m: map<string, binary>, ll: array<struct<x: array<binary>, y: string>>>"
    )
    r = random.Random(1)

    def blob():
        return r.choice([None, b"", r.randbytes(9), r.randbytes(64)])

    rows = [
        (
            i,
            blob(),
            None
            if i % 7 == 3
            else (
                None if i % 5 == 0 else (blob(), i),
                None if i % 4 == 0 else [blob() for _ in range(i % 3)],
                None if i % 6 == 0 else {"k": blob(), "j": blob()},
                [([blob()], "y"), (None, None), None],
            ),
        )
        for i in range(40)
    ]
    frame = spark.createDataFrame(rows, schema)
    out = render_binary(frame)
    assert "binary" not in out.schema.simpleString()

    def walk(v):
        if isinstance(v, (bytes, bytearray)):
            return plain(bytes(v))
        if isinstance(v, dict):
            return {k: walk(x) for k, x in v.items()}
        if isinstance(v, (list, tuple)):
            return [walk(x) for x in v]
        return v

    assert [walk(x) for x in out.orderBy("id").collect()] == [walk(x) for x in rows]


def test_columns_without_bytes_stay_in_the_jvm(spark):
    frame = spark.createDataFrame([(1, "x")], "id int, name string")
    assert "Python" not in render_binary(frame)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("meta", "status"),
    [
        (None, "Success"),
        ("{}", "Success"),
        ('{"err":null}', "Success"),
        ('{"err":false}', "Success"),
        ('{"err":0}', "Success"),
        ('{"err":0.0}', "Success"),
        ('{"err":""}', "Success"),
        ('{"err":"0"}', "Failed"),
        ('{"err":true}', "Failed"),
        ('{"err":-1}', "Failed"),
        ('{"err":[]}', "Failed"),
        ('{"err":{}}', "Failed"),
        ('{"err":"false"}', "Failed"),
    ],
)
def test_status_follows_truthiness(spark, meta, status):
    frame = spark.createDataFrame([(meta,)], "meta string")
    assert frame.select(payload.tx_status(F.parse_json("meta"))).first()[0] == status


def test_meta_fields(spark):
    rows = [
        ('{"err":null,"fee":5000,"preBalances":[1,2],"postBalances":[1,2,3]}', 9),
        ('{"preBalances":[],"postBalances":[]}', 0),
        ('{"postBalances":[1]}', None),
        (None, 4),
    ]
    frame = spark.createDataFrame(rows, "meta string, slot bigint")
    got = payload.tx_meta(frame.withColumn("meta", F.parse_json("meta"))).collect()
    assert [(r.status, r.slot_text, r.tx_fee, r.accounts_affected) for r in got] == [
        ("Success", "9", 5000, 3),
        ("Success", "N/A", None, 0),
        ("Success", "N/A", None, None),
        (None, None, None, None),
    ]


def test_logs(spark):
    frame = spark.createDataFrame([(["a Token", "b", "SPL"],), ([],), (None,)], "logs array<string>")
    found = payload.matching_logs(F.col("logs"), ["Token", "SPL"])
    got = frame.select(found, payload.first_of(found), payload.has_any(found)).collect()
    assert [tuple(r) for r in got] == [
        (["a Token", "SPL"], "a Token", True),
        ([], None, False),
        (None, None, False),
    ]


def test_preview(spark):
    frame = spark.createDataFrame([(1, "x")], "id int, name string")
    row = preview(frame, 2).first()
    assert (row.preview, row.more_lines) == (["{", '  "id" : 1,'], 2)
    assert preview(frame, 9).first().more_lines == 0


def test_texts(spark):
    row = spark.range(1).select(
        text.short_signature(F.lit("abcdefghijkl")).alias("short"),
        text.endpoint_label(F.lit("https://a.feed.example")).alias("label"),
        text.endpoint_label(F.lit("https://a.feed.example"), False).alias("head"),
        text.iso_time(F.lit(1_703_123_456_789)).alias("iso"),
        text.first_frame(F.lit("Error: x\n    at y (z:1)\n  at w")).alias("frame"),
        text.first_frame(F.lit("Error: x")).alias("none"),
        text.error_code(F.lit("UNAUTHENTICATED: Invalid token")).alias("code"),
        text.error_code(F.lit("oops")).alias("no_code"),
        text.is_known_error(F.lit("CANCELLED: bye")).alias("known"),
        text.recovered_text(F.lit(2250).cast("long")).alias("recovered"),
        text.client_state(F.lit(False)).alias("state"),
        text.status_marker(F.lit("reconnected")).alias("marker"),
    )
    assert row.first().asDict() == {
        "short": "abcdefgh...",
        "label": "a",
        "head": "https://a",
        "iso": "2023-12-21T01:50:56.789Z",
        "frame": "at y (z:1)",
        "none": None,
        "code": "UNAUTHENTICATED",
        "no_code": "",
        "known": True,
        "recovered": "Recovered after 2.3 seconds",
        "state": "DISCONNECTED",
        "marker": "again",
    }


def test_missing_and_zero_receive_times_fall_back(spark):
    frame = spark.createDataFrame([(5,), (0,), (None,)], "ms bigint")
    got = frame.select(text.received_time(F.col("ms"), F.lit(9).cast("long"))).collect()
    assert [r[0] for r in got] == [5, 9, 9]
