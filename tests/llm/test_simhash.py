import random

import numpy as np
import xxhash

from streamfuse.llm import simhash
from tests.llm.helpers import awkward, docs_of, empty


def plain_print(text):
    low = (text or "").encode().lower().decode()
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in low).split(" ") if w]
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """Smallest member reachable over links of two bits, by plain search."""
    values = sorted(set(prints))
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {v: root(v) for v in values}


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_fingerprints_equal_a_plain_count(spark):
    texts = ["", None, " \t", "One", "one two", "a b c d a b c d", "É é x Y z", "w " * 70_000 + "end", "\x1fa b c"]
    got = simhash.near_duplicates(docs_of(spark, list(enumerate(texts)))).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{plain_print(t):016x}" for i, t in enumerate(texts)}


def test_nearest_codewords_are_within_three_bits():
    tables = simhash.golay_tables()
    words = np.random.default_rng(0).integers(0, 1 << 23, 500).astype(np.int32)
    low, high, leader = tables
    error = leader[low[words & 0xFFF] ^ high[words >> 12]]
    assert max(int(e).bit_count() for e in error) <= 3
    code = words ^ error
    assert not (low[code & 0xFFF] ^ high[code >> 12]).any()
    assert (simhash.nearest_codeword(words, tables) == code >> 11).all()


def test_fingerprints_in_reach_share_a_key():
    draw = random.Random(1)
    pairs = []
    for _ in range(2000):
        a = draw.getrandbits(64)
        flips = draw.sample(range(64), draw.choice([0, 1, 2]))
        pairs += [a, a ^ sum(1 << b for b in flips)]
    owner, key = simhash.golay_keys(np.array(pairs, dtype=np.uint64).view(np.int64), simhash.golay_tables())
    keys = [set() for _ in pairs]
    for i, k in zip(owner, key, strict=True):
        keys[i].add(k)
    assert all(keys[i] & keys[i + 1] for i in range(0, len(pairs), 2))
    assert {len(k) for k in keys} <= {3, 8, 13, 18}  # one or six for each segment


def groups_of(spark, values):
    frame = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    return {r.fp: r.root for r in simhash.components(simhash.links(frame)).collect()}


def clouds(seed):
    """Chains and dense groups of near values, and values on their own."""
    draw = random.Random(seed)
    values = {draw.getrandbits(64) for _ in range(150)}
    for _ in range(6):
        v = draw.getrandbits(64)
        for _ in range(40):
            v ^= sum(1 << b for b in draw.sample(range(64), draw.choice([1, 2, 3])))
            values.add(v)
        hub = draw.getrandbits(64)
        values |= {hub ^ sum(1 << b for b in draw.sample(range(64), draw.choice([1, 2, 3]))) for _ in range(60)}
    return sorted(values)


def check_groups(spark, values):
    want = plain_groups(values)
    sets = {}
    for v, r in want.items():
        sets.setdefault(r, set()).add(signed(v))
    linked = {min(s): s for s in sets.values() if len(s) > 1}
    got = {}
    for v, r in groups_of(spark, values).items():
        got.setdefault(r, set()).add(v)
    assert got == linked


def test_groups_equal_a_plain_search(spark):
    check_groups(spark, clouds(1))


def test_dense_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PAIR_BUCKET", 1)
    check_groups(spark, clouds(2))
    monkeypatch.setattr(simhash, "PAIR_BUCKET", 6)
    check_groups(spark, clouds(3))


def test_long_chain_settles(spark):
    values, v = [], 0
    order = list(range(64))
    random.Random(3).shuffle(order)
    for b in order:
        values.append(v)
        v ^= 1 << b
    check_groups(spark, values)


def test_any_order_of_a_chain_or_star_settles(spark):
    rising = [(i, i + 1) for i in range(400)]
    star = [(1000 + i, 1999) for i in range(300)]
    comb = [(3000 + i, 3500 + i % 7) for i in range(100)] + [(3500 + i, 3507) for i in range(7)]
    edges = spark.createDataFrame(rising + star + comb, "a long, b long")
    got = {r.fp: r.root for r in simhash.components(edges).collect()}
    want = {i: 0 for i in range(401)} | {1000 + i: 1000 for i in range(300)} | {1999: 1000}
    want |= {3000 + i: 3000 for i in range(100)} | {3500 + i: 3000 for i in range(8)}
    assert got == want


def test_component_is_the_smallest_doc_id_in_reach(spark):
    draw = random.Random(5)
    base = [f"w{draw.randrange(400)}" for _ in range(400)]
    rows = []
    for i in range(60):
        words = base[:]
        words[draw.randrange(400)] = "changed"
        rows.append((200 - i, " ".join(words)))
    rows += [(300 + i, " ".join(f"x{draw.randrange(900)}" for _ in range(50))) for i in range(20)]
    prints = {i: plain_print(t) for i, t in rows}
    roots = plain_groups(prints.values())
    least = {}
    for i, p in prints.items():
        least[roots[p]] = min(i, least.get(roots[p], i))
    got = simhash.near_duplicates(docs_of(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: least[roots[p]] for i, p in prints.items()}


def test_awkward_rows(spark):
    docs, rows = awkward(spark)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    zero = [r for r in got if r.fingerprint == "0" * 16]
    assert {r.component_id for r in zero} == {1} and len(zero) == 4
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.one_of_each(empty(spark)).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs, _ = awkward(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and ids.count(8) == 1 and 2 not in ids and ids.count(None) == 1
    assert {3, 4, 5, 6, 7} <= set(ids)
