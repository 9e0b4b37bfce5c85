import random
from collections import Counter, defaultdict

from streamfuse.llm import packing
from tests.llm.helpers import awkward, docs_of, empty
from tests.llm.test_simhash import plain_groups, plain_print


def plain_best_fit(pieces, capacity):
    """The same rule with a list of bins and no order: the least room that holds the piece, without conflict."""
    bins, out = [], []
    for size, source, cluster in pieces:
        able = [
            (b["room"], i)
            for i, b in enumerate(bins)
            if b["room"] >= size and source not in b["sources"] and cluster not in b["clusters"]
        ]
        if able:
            i = min(able)[1]
        else:
            i = len(bins)
            bins.append({"room": capacity, "sources": set(), "clusters": set()})
        bins[i]["room"] -= size
        bins[i]["sources"].add(source)
        bins[i]["clusters"].add(cluster)
        out.append(i)
    return out


def test_bins_equal_a_plain_search():
    draw = random.Random(3)
    for _ in range(30):
        rows = [(draw.randint(1, 90), draw.choice("aaabcdef"), draw.choice([1, 2, *range(9, 60)])) for _ in range(80)]
        order = sorted(range(len(rows)), key=lambda k: (-rows[k][0], k))
        want = dict(zip(order, plain_best_fit([rows[k] for k in order], 100), strict=True))
        got = {k: b for k, _, _, _, b in packing.pack_shard(rows, 100)}
        assert got == want


def test_every_token_has_one_place(spark):
    draw = random.Random(5)
    rows = [(i, " ".join(["w"] * draw.choice([0, 3, 40, 100, 250]) + [str(i)]), None, draw.choice("abc")) for i in range(300)]
    rows += [(1000 + i, "same copied text", None, "abcd"[i % 4]) for i in range(12)]
    got = packing.pack(docs_of(spark, rows), capacity=100, shard_docs=64).collect()
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append((r.first_token, r.n_tokens))
        by_bin[r.shard, r.bin].append(r)
    assert by_doc.keys() == {r[0] for r in rows}
    for i, text, *_ in rows:
        at = 0
        for first, size in sorted(by_doc[i]):
            assert first == at and size <= 100
            at += size
        assert at == len(text.split())
    texts = {r[0]: r[1] for r in rows}
    for content in by_bin.values():
        assert sum(r.n_tokens for r in content) <= 100
        assert max(Counter(r.source for r in content).values()) == 1
        assert max(Counter(texts[r.doc_id] for r in content).values()) == 1


def test_runs_of_the_mixed_order(spark):
    rows = [(i, f"text {i}", None, f"s{i % 3}") for i in range(200)]
    got = packing.pack(docs_of(spark, rows), capacity=8, shard_docs=64, in_mix=True).collect()
    assert sorted(r.doc_id for r in got) == list(range(200))
    for shard in {r.shard for r in got}:
        counts = Counter(r.source for r in got if r.shard == shard)
        assert max(counts.values()) - min(counts.values()) <= 16 or shard == max(r.shard for r in got)


def test_awkward_rows_and_empty_table(spark):
    docs, rows = awkward(spark)
    got = packing.pack(docs).collect()
    assert Counter(r.doc_id for r in got if r.first_token == 0) == Counter(r[0] for r in rows)
    assert packing.pack(empty(spark)).count() == 0
    assert packing.pack(empty(spark), in_mix=True).count() == 0


def test_near_copies_of_different_sources_share_no_bin(spark):
    """Near copies are texts in one SimHash group, by a plain search of the groups."""
    draw = random.Random(21)
    rows = []
    for _ in range(12):
        base = [f"w{draw.randrange(5000)}" for _ in range(400)]
        for k in range(4):
            words = base[:]
            words[draw.randrange(400)] = f"changed{len(rows)}"
            rows.append((len(rows), " ".join(words[:399]), None, f"s{k}"))
    prints = {i: plain_print(t) for i, t, _, _ in rows}
    roots = plain_groups(prints.values())
    group = {i: roots[p] for i, p in prints.items()}
    assert len(set(group.values())) < 0.7 * len(rows)
    own = docs_of(spark, rows)
    named = own.withColumn("mine", (own["doc_id"] % 3).cast("string"))
    for table, options, of in ((own, {}, group), (named, {"clusters": "mine"}, {i: i % 3 for i in group})):
        bins = {}
        for r in packing.pack(table, **options).collect():
            bins.setdefault((r.shard, r.bin), []).append(of[r.doc_id])
        assert all(len(set(b)) == len(b) for b in bins.values())
        assert max(map(len, bins.values())) > 1
