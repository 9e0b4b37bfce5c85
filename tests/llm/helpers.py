"""Small tables and plain versions of the operators to hold results against."""

from __future__ import annotations

import re

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def docs_of(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*r, *(None, None)[: 4 - len(r)])[:4] for r in rows]
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], DOCS)


def awkward(spark):
    """Nulls everywhere, empty and long texts, repeated rows, shared ids, and clashing extra columns."""
    long = "alpha beta gamma delta epsilon zeta eta theta\n" * 3_000
    rows = [
        (None, None, None, None),
        (None, "some words without a number", "en", "a"),
        (1, "", "en", "a"),
        (1, "", "en", "a"),
        (2, None, "en", None),
        (3, "repeated line of more than twenty characters\nsecond", "en", "a"),
        (3, "repeated line of more than twenty characters\nother text", "en", "b"),
        (4, "Repeated line of more than twenty characters \nthird", "fr", "a"),
        (5, "repeated line of more than twenty characters\nfourth one", "fr", "a"),
        (6, long, "fr", "a"),
        (7, "Été \U0001f600 token = 'abcdefghij0123456789'", None, "b"),
        (8, "under the MIT License, cc by-nc", "en", "b"),
        (8, "under the MIT License, cc by-nc", "en", "b"),
    ]
    docs = docs_of(spark, rows)
    clashing = "_k kind kinds slot rank fp score key batch tokens dropped _mask _th _doc _id _head _told _s _h"
    clashing += " _b _copy _own _next _text _spans block c0 c1 lang_rejected n_lines _salt _row h1 h2 line pos"
    for name in clashing.split():
        docs = docs.withColumn(name, docs["doc_id"].cast("string"))
    return docs, rows


def empty(spark):
    return docs_of(spark, [(1, "x")]).limit(0)


def words(text):
    """Words of the licence contract."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
