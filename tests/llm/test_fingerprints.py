import hashlib
import random

import pytest
from pyspark.sql import functions as F

from streamfuse.llm import fingerprints as fp
from tests.llm.helpers import awkward, docs_of, empty


def edited(text, after):
    cut = len(text) // 3
    return text[: len(text) - cut] + after[:cut]


def test_edited_text_is_of_the_next_in_descending_order(spark, monkeypatch):
    monkeypatch.setattr(fp, "BLOCK_ROWS", 7)
    draw = random.Random(4)
    texts = {i * 37 % 101: "".join(draw.choice("abc é\U0001f600") for _ in range(draw.randrange(40))) for i in range(101)}
    docs = docs_of(spark, list(texts.items()))
    ids = sorted(texts, reverse=True)
    want = {
        i: hashlib.sha256(edited(texts[i], texts[ids[(k + 1) % len(ids)]]).encode()).hexdigest()
        for k, i in enumerate(ids)
    }
    got = {r.doc_id: r for r in fp.edited_fingerprints(docs).collect()}
    assert {i: r.edited_sha256 for i, r in got.items()} == want
    assert {i: r.n_chars for i, r in got.items()} == {i: len(t) for i, t in texts.items()}


def plain_bins(hashes, bins):
    """Smallest hash of each bin, bins by the top bits of the signed number."""
    shift = 64 - (bins.bit_length() - 1)
    out = [None] * bins
    for h in hashes:
        b = (h >> shift) + bins // 2
        out[b] = h if out[b] is None else min(out[b], h)
    return out


def test_bin_minima_and_densification(spark):
    docs = docs_of(spark, [(1, "a b c d e f g h i"), (2, "one"), (3, ""), (4, " ".join(map(str, range(900))))])
    hashes = fp.shingle_hashes(F.col("text"))
    minima = fp.bin_minima(hashes, 64)
    for r in docs.select("doc_id", hashes.alias("h"), minima.alias("m"), fp.densified(minima, 64).alias("d")).collect():
        assert len(r.h) == {1: 5, 2: 1, 3: 1, 4: 896}[r.doc_id]
        want = plain_bins(r.h, 64)
        assert list(r.m) == want
        filled = {h for h in want if h is not None}
        for a, b in zip(want, r.d, strict=True):
            assert b == a if a is not None else b in filled


def test_likeness_is_near_the_shingles_jaccard(spark):
    draw = random.Random(9)
    pool = [f"w{i}" for i in range(5000)]
    rows, truth = [], {}
    for i in range(30):
        base = draw.choices(pool, k=1200)
        other = base[:]
        for j in range(0, 1200, 4 + 8 * i):
            other[j] = draw.choice(pool)
        sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in (base, other)]
        truth[i] = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        rows.append((i, " ".join(base), " ".join(other)))
    pairs = spark.createDataFrame(rows, "i int, a string, b string")
    told = pairs.select("i", fp.likeness(fp.fingerprint_bins(F.col("a")), fp.fingerprint_bins(F.col("b"))).alias("s"))
    errors = [r.s - truth[r.i] for r in told.collect()]
    assert max(map(abs, errors)) < 0.14
    assert abs(sum(errors) / len(errors)) < 0.03


def test_equal_texts_have_equal_fingerprints(spark):
    docs, rows = awkward(spark)
    got = fp.edited_fingerprints(docs).collect()
    assert len(got) == len(rows)
    by_text = {}
    prints = docs.select(F.coalesce("text", F.lit("")).alias("t"), fp.packed(fp.fingerprint_bins(F.coalesce("text", F.lit("")))).alias("p"))
    for r in prints.collect():
        assert by_text.setdefault(r.t, r.p) == r.p and len(r.p) == 512
    assert {r.fingerprint for r in got} == set(by_text.values())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_empty_and_single_row_tables(spark):
    assert fp.edited_fingerprints(empty(spark)).count() == 0
    (r,) = fp.edited_fingerprints(docs_of(spark, [(5, "abcdef")])).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and r.near_next == 1


def test_options_are_checked():
    with pytest.raises(ValueError):
        fp.fingerprint_bins(F.lit("x"), bins=100)
