import random

import numpy as np

from streamfuse.llm import language as lang
from tests.llm.helpers import awkward, docs_of, empty

SYLLABLES = {"en": "the ing er th an on re", "fr": "le eau ou tion é que", "de": "sch ung der ein ch"}


def speak(draw, name, n):
    parts = SYLLABLES[name].split()
    return " ".join("".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(n))


def plain_phrases(text, sample):
    count = 0
    for at in range(0, len(text), lang.SEGMENT):
        seg, i = text[at : at + lang.SEGMENT], 0
        while i < len(seg):
            size = 1
            while i + size < len(seg) and seg[i : i + size + 1] in sample:
                size += 1
            i, count = i + size, count + 1
    return count


def test_phrases_equal_a_plain_longest_match(monkeypatch):
    monkeypatch.setattr(lang, "SEGMENT", 50)
    draw = random.Random(2)
    samples = {n: speak(draw, n, 80) for n in SYLLABLES}
    parser = lang.CrossParser(samples)
    texts = ["", "?", "the", *[speak(draw, draw.choice(list(SYLLABLES)), draw.randint(1, 60)) for _ in range(30)], "中文 the"]
    got, sizes = parser.phrases(texts)
    want = [[plain_phrases(t, samples[n]) for n in parser.names] for t in texts]
    assert got.tolist() == want and sizes.tolist() == [len(t) for t in texts]


def test_letters_without_a_column_are_looked_up(monkeypatch):
    monkeypatch.setattr(lang, "DENSE", 5)
    draw = random.Random(3)
    samples = {n: speak(draw, n, 80) for n in SYLLABLES}
    samples["many"] = "".join(chr(draw.randrange(0x4E00, 0x4E60)) for _ in range(400))
    parser = lang.CrossParser(samples)
    texts = [samples["many"][50:90] + "the", samples["many"][::-1], *[speak(draw, n, 20) for n in SYLLABLES], "中文 the"]
    got, _ = parser.phrases(texts)
    assert got.tolist() == [[plain_phrases(t, samples[n]) for n in parser.names] for t in texts]


def test_many_letters_take_no_more_room():
    draw = random.Random(4)
    samples = {n: speak(draw, n, 4000)[: lang.SAMPLE_CHARS] for n in SYLLABLES}
    samples["zh"] = "".join(chr(0x4E00 + min(2999, int(draw.expovariate(0.003)))) for _ in range(lang.SAMPLE_CHARS))
    parser = lang.CrossParser(samples)
    assert len(set(samples["zh"])) > 1000
    assert parser.codes.nbytes + sum(t.nbytes() for t in parser.tables) < 60e6


def test_automaton_reads_exactly_the_substrings():
    text = "abcbcabca"
    step = lang.suffix_automaton(text)

    def reads(s):
        state = 0
        for c in s:
            if c not in step[state]:
                return False
            state = step[state][c]
        return True

    every = {text[i:j] for i in range(len(text)) for j in range(i + 1, len(text) + 1)}
    assert all(map(reads, every))
    assert not any(reads(s + c) for s in every for c in "abcx" if s + c not in text)


def test_held_out_texts_are_told_apart(spark):
    draw = random.Random(6)
    names = sorted(SYLLABLES)
    rows = [(i, speak(draw, names[i % 3], 30), names[i % 3], "s") for i in range(240)]
    got = lang.identify(docs_of(spark, rows)).collect()
    held = [r for r in got if r.held_out]
    assert held and all(r.lang_pred == names[r.doc_id % 3] for r in held)
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_held_out_rows_teach_nothing(spark):
    draw = random.Random(6)
    rows = [(i, speak(draw, "en", 20), "en", "s") for i in range(60)]
    docs = docs_of(spark, rows)
    held = {r.doc_id for r in lang.identify(docs).collect() if r.held_out}
    wrong = [(i, t, "xx" if i in held else n, s) for i, t, n, s in rows]
    assert {r.lang_pred for r in lang.identify(docs_of(spark, wrong)).collect()} == {"en"}


def test_awkward_rows(spark):
    docs, rows = awkward(spark)
    got = lang.identify(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2) or (r.doc_id is None and r.score == 0))
    assert lang.identify(empty(spark)).count() == 0
    unlabelled = docs_of(spark, [(1, "words")])
    assert [r.lang_pred for r in lang.identify(unlabelled).collect()] == ["und"]


def test_rejected_documents_go_and_the_others_stay_whole(spark):
    draw = random.Random(8)
    rows = [(i, speak(draw, "en" if i % 2 else "de", 30), "en" if i % 2 else "de", "s") for i in range(60)]
    strange = [(100, "中文字" * 9, None, "s"), (101, "12 + 34\u00b2 \u2167", None, "s"), (102, None, None, "s")]
    kept = lang.keep_identified(docs_of(spark, rows + strange))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted((r[0], r[1]) for r in rows)


def test_ties_go_to_the_first_name():
    parser = lang.CrossParser({"b": "same words", "a": "same words"})
    names, scores, _ = lang.judge(parser, ["same"])
    assert names == ["a"] and scores == [0.0] and np.isfinite(scores[0])


def test_a_tiny_sample_wins_no_text_of_others(spark):
    draw = random.Random(11)
    names = sorted(SYLLABLES)
    rows = [(i, speak(draw, names[i % 3], 30), names[i % 3], "s") for i in range(240)]
    told = {r.doc_id: r.lang_pred for r in lang.identify(docs_of(spark, rows)).collect()}
    for rare in ("e", " ", "th", "tion"):
        with_rare = [*rows, (1001, rare, "aa", "s"), (1003, rare, "zz", "s"), (1007, rare, "mm", "s")]
        got = {r.doc_id: r.lang_pred for r in lang.identify(docs_of(spark, with_rare)).collect()}
        assert {i: got[i] for i in told} == told


POLISH = (
    "litwo ojczyzno moja ty jesteś jak zdrowie ile cię trzeba cenić ten tylko się dowie kto cię stracił "
    "dziś piękność twą w całej ozdobie widzę i opisuję bo tęsknię po tobie"
)


def test_foreign_and_random_texts_go_and_short_clean_ones_stay(spark):
    draw = random.Random(13)
    names = sorted(SYLLABLES)
    rows = [(i, speak(draw, names[i % 3], 30), names[i % 3], "s") for i in range(360)]
    gibberish = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz   ") for _ in range(400))
    strange = [(1000, POLISH, None, "s"), (1001, gibberish, None, "s"), (1002, "Μῆνιν ἄειδε θεὰ " * 9, None, "s")]
    code = f"token = '{draw.getrandbits(160):040x}' +1 (545) 555-9193"
    short = [(2000 + i, speak(draw, n, 2), None, "s") for i, n in enumerate(names * 4)]
    short += [(3000, f"{code} {speak(draw, 'en', 6)}", None, "s")]
    short += [(3001, f"{speak(draw, 'en', 40)} {speak(draw, 'de', 40)}", None, "s")]
    for rare in ([], [(4001, "x", "zz", "s"), (4003, "the", "yy", "s")]):
        docs = docs_of(spark, rows + strange + short + rare)
        kept = {r.doc_id for r in lang.keep_identified(docs).collect()}
        assert {r[0] for r in rows + short} <= kept
        assert not {r[0] for r in strange} & kept
