import random
from pathlib import Path

import duckdb
import pytest

from streamfuse.llm import licenses as lic
from tests.llm.helpers import awkward, docs_of, empty, words

PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def plain_base(text):
    found = words(text)
    places = []
    for label, phrase in PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(found)) if found[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({x for _, x in places}))
    return len(found), len(places), min(starts, default=None), max(starts, default=None), labels


def base_of(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


def test_base_columns_equal_a_plain_scan(spark):
    texts = [
        "Released under the MIT License. Also CC BY-NC 4.0; cc-by-nc!",
        "under the mit under the mit license under the mit license",
        "Apache License, Version 2.0", "apache license version 20", "cc by", "éunder the mit license",
        "under\x00the\x7fmit license", "UNDER THE MIT LICENSEÉ", "", None,
    ]
    docs = docs_of(spark, list(enumerate(texts)))
    got = {r.doc_id: base_of(r) for r in lic.scan_licenses(docs).collect()}
    assert got == {i: plain_base(t) for i, t in enumerate(texts)}


def test_awkward_rows_and_empty_table(spark):
    docs, rows = awkward(spark)
    got = sorted(map(str, (base_of(r) for r in lic.scan_licenses(docs).collect())))
    assert got == sorted(str(plain_base(r[1])) for r in rows)
    assert lic.scan_licenses(empty(spark)).count() == 0


def test_templates_need_their_key_phrases_and_their_places(spark):
    mit = lic.MORE_TEMPLATES[1].text
    other = mit.split()
    moved = " ".join(other[:7] + ["x"] * 30 + other[7:])
    docs = docs_of(
        spark,
        [
            (1, f"Copyright. {mit.capitalize()}, and so on"),
            (2, mit.replace("hereby", "gladly")),
            (3, moved),
            (4, "This work is licensed under the GNU General Public License, version 3."),
            (5, "a page about the mit and a license of version 2 by apache"),
        ],
    )
    got = {r.doc_id: r for r in lic.scan_licenses(docs).collect()}
    assert got[1].labels == "mit" and got[1].base_labels == "" and got[1].score > 0.99
    assert got[2].labels == "" and got[2].score == 0
    assert got[3].labels == ""
    assert got[4].labels == "gpl" and got[4].n_base == 0
    assert got[5].labels == ""


def test_rarest_words_of_the_file_are_looked_up_until_their_places_agree():
    counts = {w: 1000 for t in lic.TEMPLATES for w in t.words} | {b"nc": 1, b"by": 5}
    index = lic.LicenseIndex(lic.TEMPLATES, counts, 1000)
    k = next(i for i, t in enumerate(lic.TEMPLATES) if t.text == "cc by nc")
    looked = []

    class Places(dict):
        def __getitem__(self, word):
            looked.append(word)
            return super().__getitem__(word)

    words = b"nc by nc cc cc by nc by".split()
    at = Places(index._positions(words, {b"cc", b"by", b"nc"}))
    assert index._offsets(at, {(k, 0): 2}) == {(k, 0): {0, 4}} and looked == [b"nc", b"by"]
    assert [(t, p) for t, p, _ in index.scan(words)] == [(k, 4)]


def test_a_notice_with_its_first_key_phrase_damaged_is_found(spark):
    """A fixed anchor in the first key phrase would have nothing to look up."""
    whole = lic.MORE_TEMPLATES[0]
    first, size = whole.keys[0]
    words_ = whole.text.split()
    damaged = " ".join(["x"] * size + words_[size:])
    only_one = " ".join(words_[: whole.keys[1][0]]) + " nothing more"
    shifted = " ".join(words_[10:])  # begins inside the notice
    docs = docs_of(spark, [(1, f"a b c {damaged}."), (2, only_one), (3, shifted), (4, f"{whole.text} {whole.text}")])
    got = {r.doc_id: r for r in lic.scan_licenses(docs).collect()}
    assert first == 0 and got[1].labels == "mit" and 0.5 < got[1].score < 1
    assert got[2].labels == ""
    assert got[3].labels == "mit"
    assert got[4].labels == "mit" and got[4].score == 1


def test_offsets_equal_a_search_of_all_places():
    """Random texts of template words: the looked-up places lose none that a search of every offset verifies."""
    draw = random.Random(8)
    vocabulary = sorted({w for t in lic.TEMPLATES for w in t.words})
    index = lic.LicenseIndex(lic.TEMPLATES, {w: draw.randrange(50) for w in vocabulary}, 60)
    for _ in range(60):
        words_ = []
        for _ in range(draw.randrange(1, 8)):
            t = draw.choice(lic.TEMPLATES)
            part = list(t.words)
            if draw.random() < 0.5:
                part[draw.randrange(len(part))] = draw.choice(vocabulary)
            words_ += part[draw.choice([0, 0, 3]) :] + draw.choices(vocabulary, k=draw.randrange(3))
        want = []
        for k, t in enumerate(lic.TEMPLATES):
            for offset in range(-len(t.words), len(words_)):
                if index._verified(t, words_, offset):
                    share = index._votes(t, words_, offset)
                    if share >= lic.MIN_SHARE:
                        want.append((k, offset + t.keys[0][0], share))
        assert index.scan(words_) == want


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="test tables are not here")
def test_sql_says_the_same(spark):
    mit = lic.MORE_TEMPLATES[1].text
    long = lic.MORE_TEMPLATES[0].text
    texts = ["x y " + " ".join(long.split()[9:]), long.replace("restriction", "end"), long[:300], mit + " in a text", "x " + mit[:200], "cc by nc cc by sa", None, "", "of the gnu general public license",
             " ".join(reversed(mit.split())), "license you may not use this file except in compliance with the license"]
    docs = docs_of(spark, list(enumerate(texts)))
    db = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841 - read by name
    db.execute("CREATE TABLE documents AS SELECT doc_id, text FROM documents")
    frame = lic.scan_licenses(docs)
    result = db.execute(f"SELECT {', '.join(frame.columns)} FROM ({lic.oracle_sql()})").fetchall()
    assert sorted(map(str, map(tuple, frame.collect()))) == sorted(map(str, result))
