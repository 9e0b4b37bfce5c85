"""Every stage against a plain version on its own input, and the whole run."""

import random
from collections import Counter

import corpus_pipeline
from streamfuse.llm import language
from tests.llm.helpers import awkward, docs_of
from tests.llm.test_language import speak
from tests.llm.test_lines import key
from tests.llm.test_simhash import plain_groups, plain_print

SHARED = "this very line stands in many documents"


def corpus(spark, tmp_path):
    draw = random.Random(12)
    rows = []
    for i in range(120):
        name = ("en", "fr", "de")[i % 3]
        text = speak(draw, name, 60)
        if i % 10 == 0:
            text = f"{text}\n{SHARED}"
        rows.append((i, text, name, "hot" if i % 2 else f"s{i % 4}"))
    rows += [(200 + i, rows[i][1], rows[i][2], "copy") for i in range(1, 9)]
    rows += [(300, None, None, None), (301, "12345", None, "hot"), (302, "", "en", "hot")]
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    return rows


def test_stages_in_order(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "simhash_near_dedup", "source_mixing", "best_fit_packing"]


def test_each_stage_equals_a_plain_version(spark, tmp_path):
    rows = corpus(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)

    # Language: what the parser itself rejects goes, nothing else.
    samples = language.labelled_sample(docs)
    parser = language.CrossParser(samples)
    texts = [r[1] for r in rows]
    _, _, rejected = language.judge(parser, texts)
    first = stages["language_id"](spark, docs, str(tmp_path))
    assert first.columns == columns
    kept = sorted(r.doc_id for r in first.collect())
    assert kept == sorted(r[0] for r, gone in zip(rows, rejected, strict=True) if not gone)
    assert not {300, 301, 302} & set(kept) and set(range(120)) <= set(kept)

    # Lines: shared lines stay in the document with the largest doc_id.
    before = {r.doc_id: r.text for r in first.collect()}
    holders = {}
    for i, t in before.items():
        for line in t.split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(i)
    want = {
        i: "\n".join(x for x in t.split("\n") if len(holders.get(key(x), ())) < 3 or max(holders[key(x)]) == i)
        for i, t in before.items()
    }
    second = stages["line_dedup"](spark, first, str(tmp_path))
    assert second.columns == columns
    got = {r.doc_id: (r.text, r.n_chars) for r in second.collect()}
    assert got == {i: (t, len(t)) for i, t in want.items()}
    assert sum(SHARED in t for t in want.values()) == 1

    # Near duplicates: the smallest doc_id of each group.
    prints = {i: plain_print(t) for i, t in want.items()}
    roots = plain_groups(prints.values())
    heads = {}
    for i, p in prints.items():
        heads[roots[p]] = min(i, heads.get(roots[p], i))
    third = stages["simhash_near_dedup"](spark, second, str(tmp_path))
    assert third.columns == columns
    assert sorted(r.doc_id for r in third.collect()) == sorted(heads.values())

    # Mixing keeps everything; packing gives every token one place.
    fourth = stages["source_mixing"](spark, third, str(tmp_path))
    assert fourth.columns == columns
    assert sorted(map(str, fourth.collect())) == sorted(map(str, third.collect()))
    last = stages["best_fit_packing"](spark, fourth, str(tmp_path)).collect()
    tokens = Counter()
    for r in last:
        tokens[r.doc_id] += r.n_tokens
    assert tokens == {i: len(want[i].split()) for i in heads.values()}


def test_run_is_the_stages_one_after_another(spark, tmp_path):
    corpus(spark, tmp_path)
    out = corpus_pipeline.run(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))


def test_awkward_rows_and_empty_tables(spark):
    docs, _ = awkward(spark)
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, "")
            assert out.columns == table.columns
            assert out.count() <= table.count()
        corpus_pipeline.STAGES[-1][1](spark, table, "").collect()
