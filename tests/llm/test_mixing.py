from collections import Counter
from itertools import islice

import pytest

from streamfuse.llm import mixing
from tests.llm.helpers import awkward, docs_of, empty


@pytest.mark.parametrize("slots", [{"a": 1}, {"a": 5, "b": 3, "c": 1, "d": 1}, {"a": 97, "b": 31, "c": 2}])
def test_one_period_meets_every_window_and_stays_within_a_block(slots):
    period = sum(slots.values())
    served = Counter()
    for s, i, t, release, deadline in mixing.earliest_deadline_first(slots):
        assert release <= t < deadline and served[s] == i
        served[s] += 1
        for x, n in slots.items():
            assert abs(served[x] - (t + 1) * n / period) < 1
    assert served == slots


def schedule_of(docs, **options):
    return mixing.scheduled(docs, **options).collect()


def test_all_rows_are_placed_and_each_stretch_has_its_shares(spark):
    rows = [(i, f"t{i}", None, "hot" if i % 3 else f"s{i % 4}") for i in range(900)]
    weights = {"hot": 2.0, "s0": 1.0, "s1": 1.0, "s2": 1.0, "s3": 1.0}
    got = schedule_of(docs_of(spark, rows), weights=weights, block_docs=8, period=12)
    assert sorted(r.doc_id for r in got) == list(range(900))
    turns = {}
    for r in got:
        assert r.release <= r.slot < r.deadline
        turns.setdefault(r.slot, set()).add((r.source, r.block))
    assert all(len(t) == 1 for t in turns.values())
    # While all sources last, no source is a whole block off its share.
    blocks = [next(iter(turns[t]))[0] for t in sorted(turns)]
    counts = Counter(r.source for r in got)
    share = {s: w / 6 for s, w in weights.items()}
    upto = int(min(-(-counts[s] // 8) / share[s] for s in share)) - 12
    seen = Counter()
    for t, s in enumerate(blocks[:upto], 1):
        seen[s] += 1
        assert all(abs(seen[x] - t * w) < 1 for x, w in share.items())


def test_ranks_count_every_source_without_gaps(spark):
    docs, rows = awkward(spark)
    got = mixing.mix_schedule(docs).collect()
    assert len(got) == len(rows)
    by_source = {}
    for r in got:
        by_source.setdefault(r.source, []).append(r["rank"])
    assert {s: sorted(v) for s, v in by_source.items()} == {
        s: list(range(n)) for s, n in Counter(r[3] for r in rows).items()
    }


def test_mixed_keeps_rows_and_columns_in_order(spark):
    docs, rows = awkward(spark)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
    plain = docs_of(spark, [(i, f"t{i}", None, f"s{i % 2}") for i in range(100)])
    order = [r.doc_id for r in mixing.mixed(plain).collect()]
    places = {r.doc_id: (r.slot, r["rank"]) for r in mixing.scheduled(plain).collect()}
    assert order == sorted(places, key=places.get)


def test_empty_table(spark):
    assert mixing.mix_schedule(empty(spark)).count() == 0
    assert mixing.mixed(empty(spark)).count() == 0


def test_weights_are_checked():
    with pytest.raises(ValueError):
        mixing.period_of({"a": 0.0, "b": 1.0})


@pytest.mark.parametrize("weights", [{"a": 0.9995, "b": 0.0005}, {f"s{i}": 1 / (i + 1) for i in range(20)}])
def test_no_source_is_a_block_off_its_exact_weight_however_long(weights, monkeypatch):
    monkeypatch.setattr(mixing, "STRETCH", 1_000)
    total = sum(weights.values())
    blocks = {s: int(40_000 * w / total) for s, w in weights.items()}
    slots = mixing.period_of(weights, mixing.PERIOD)
    states = mixing.stretches(blocks, slots)
    seen, at = Counter(), 0
    for base, start, n, sources, shares, before, done in states:
        if base:
            break
        own = dict(zip(sources, shares, strict=True))
        served = mixing.served(own, dict(zip(sources, done, strict=True)), start)
        for s, i, t, release, deadline in islice(served, n):
            assert t == at and seen[s] == i and release <= t < deadline
            seen[s], at = seen[s] + 1, at + 1
            for x, w in weights.items():
                assert abs(seen[x] - at * w / total) < 1 + 1e-6
    assert at > 30_000


def test_every_block_has_a_turn_after_sources_end(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STRETCH", 7)
    rows = [(i, f"t{i}", None, "hot" if i % 3 else f"s{i % 7}") for i in range(1500)]
    table = docs_of(spark, rows)
    got = schedule_of(table, block_docs=4)
    # Where the driver holds few states, it writes them as they are made.
    monkeypatch.setattr(mixing, "HELD_NUMBERS", 100)
    assert sorted(schedule_of(table, block_docs=4)) == sorted(got)
    assert sorted(r.doc_id for r in got) == list(range(1500))
    assert all(r.block == r["rank"] // 4 and r.release <= r.slot < r.deadline for r in got)
    turns = {}
    for r in got:
        turns.setdefault(r.slot, set()).add((r.source, r.block))
    assert sorted(turns) == list(range(len(turns))) and all(len(t) == 1 for t in turns.values())


def test_a_small_weight_keeps_its_target(spark):
    rows = [(i, f"t{i}", None, "big" if i < 12_000 else "small") for i in range(12_100)]
    got = schedule_of(docs_of(spark, rows), weights={"big": 0.9995, "small": 0.0005}, block_docs=2)
    while_both = max(r.slot for r in got if r.source == "big")
    assert sum(1 for r in got if r.source == "small" and r.slot <= while_both) <= 2 * 4
