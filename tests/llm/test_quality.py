import random

import numpy as np

from streamfuse.llm import quality
from tests.llm.helpers import awkward, docs_of, empty


def text_of(draw, good):
    plain = [draw.choice(["river", "house", "walks", "green", "under", "table"]) for _ in range(40)]
    return " ".join(plain) + "." if good else " ".join(w.upper() + "!!" for w in plain)


def tables(spark, n=300):
    draw = random.Random(1)
    docs = docs_of(spark, [(i, text_of(draw, i % 4 != 0)) for i in range(n)])
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(n)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_held_out_texts_are_scored_right(spark):
    docs, labels = tables(spark)
    held = [r for r in quality.score_quality(docs, labels).collect() if r.held_out]
    assert len(held) > 50
    assert all(r.predicted == int(r.doc_id % 4 != 0) for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in held)


def test_held_out_labels_teach_nothing(spark):
    docs, labels = tables(spark, 120)
    first = {r.doc_id: (r.score, r.held_out) for r in quality.score_quality(docs, labels).collect()}
    rows = [(r.doc_id, 1 - r.quality if first[r.doc_id][1] else r.quality, 0) for r in labels.collect()]
    other = spark.createDataFrame(rows, labels.schema)
    second = {r.doc_id: (r.score, r.held_out) for r in quality.score_quality(docs, other).collect()}
    assert first == second


def test_awkward_rows(spark):
    docs, rows = awkward(spark)
    labels = spark.createDataFrame(
        [(3, 1, 0), (4, 0, 0), (8, 1, 0), (8, 0, 0), (None, 1, 0), (5, None, 0), (6, 7, 0)],
        "doc_id long, quality int, toxic int",
    )
    got = quality.score_quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert quality.score_quality(empty(spark), labels).count() == 0
    assert {r.score for r in quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}


def test_words_used_alike_are_near():
    draw = random.Random(2)
    texts = []
    for _ in range(300):
        texts.append(f"the {draw.choice(['cat', 'dog'])} eats meat . {draw.choice(['one', 'two'])} plus three is")
    words = quality.WordVectors(texts)

    def near(a, b):
        x, y = words.vectors[words.number[a]], words.vectors[words.number[b]]
        return float(x @ y / np.linalg.norm(x) / np.linalg.norm(y))

    assert near("cat", "dog") > near("cat", "one") and near("one", "two") > near("dog", "two")


def test_pooling_is_the_mean_over_all_tokens():
    words = quality.WordVectors(["a b c d . " * 5])
    text = "a b zzz ### . a"
    ids = words.ids(quality._TOKEN.findall(text))
    assert np.allclose(words.pooled(text), words.vectors[ids].mean(axis=0), atol=1e-6)


def test_temperature_calms_an_overconfident_network():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(600, 6))
    y = (x[:, 0] + draw.normal(scale=2, size=600) > 0).astype(float)
    net = quality.train(x, y)
    p = net.probability(x)
    assert abs(p.mean() - y.mean()) < 0.1 and net.temperature > 1
