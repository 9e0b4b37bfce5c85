import hashlib
import math
import random
import zlib

import pytest

from streamfuse.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((t is not None, t or 0), (role or "", text or "")))
    own = {c: [turn for _, turn in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    return out


def plain(sequences):
    """Every node by counting all beginnings; subtrees by comparing beginnings."""
    members = {}
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    own = {p: (len(m) - 1) * len(p[-1][1]) if p else 0 for p, m in members.items()}
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[b] for b in below) or 1
        saved[p] = own[p] + sum(saved[b] for b in below)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(sequences[c]) == len(p))
        out.append((
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def got(frame):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted(map(tuple, frame.select(*names).collect()), key=str)


def some_conversations(draw, n):
    rows = []
    for c in [*range(n), *draw.sample(range(100, 5000), n)]:
        for t in range(draw.randrange(1, 9)):
            rows.append((c, t, draw.choice(["user", "assistant"]), draw.choice(["a", "bé", "", "long text"])))
    return rows


def frame_of(spark, sequences):
    rows = []
    for c, s in sequences.items():
        rows.append((c, -1, None, 0))
        rows += [(c, i, hashlib.md5(repr(t).encode()).digest(), len(t[1])) for i, t in enumerate(s)]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, pos int, id binary, n_chars int")


def some_sequences(seed, n=120):
    draw = random.Random(seed)
    base = [("u", f"{i}" * draw.randrange(9)) for i in range(40)]
    out = {}
    for c in range(n):
        s = base[: draw.choice([0, 0, 1, 3, 12, 40])] + [("a", draw.choice("xyz")) for _ in range(draw.randrange(4))]
        out[c * 3] = tuple(s)
    return out


@pytest.mark.parametrize(("suffix", "shard", "container"), [(256, 200_000, 64), (3, 40, 1), (5, 100, 4)])
def test_nodes_equal_a_plain_count(spark, suffix, shard, container):
    sequences = some_sequences(suffix)
    found = trie.prefix_trie(frame_of(spark, sequences), suffix, shard, container)
    assert got(found) == plain(sequences)


@pytest.mark.parametrize("container", [1, 3, 1000])
def test_burst_trie_equals_a_count_of_beginnings(container):
    draw = random.Random(container)
    sequences = {c: [bytes([draw.randrange(3)] * trie.ID) for _ in range(draw.randrange(7))] for c in range(300)}
    made = trie.BurstTrie(trie.ROOT, 0, container)
    want = {}
    for c, s in sequences.items():
        made.add(c, b"".join(s), [t[0] for t in s])
        name = trie.ROOT
        for d, t in enumerate(s, 1):
            up, name = name, trie.chained(name, t)
            _, _, n, low, _ = want.get(name, (up, d, 0, c, t[0]))
            want[name] = (up, d, n + 1, min(low, c), t[0])
    nodes = list(made.nodes())
    assert len(nodes) == len(want)
    assert {n[0]: n[1:] for n in nodes} == want


def test_rebuilt_conversations_equal_a_plain_version(spark):
    rows = some_conversations(random.Random(7), 60)
    # Null turns, roles and texts, a missing number, a giver with few turns and one that is not there.
    rows = [r for r in rows if r[0] != 200]
    rows += [(300, None, None, None), (300, 1, "user", "x"), (301, None, "user", None), (None, 0, "user", "lost")]
    rows += [(-5, 0, "user", "a"), (-100, 0, "user", "a"), (9000, 0, "user", "y" * 100_000), (9001, 0, "user", "y" * 100_000)]
    assert got(trie.rebuilt_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rebuilt(rows))


def test_many_equal_conversations_and_empty_table(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 90_000, 100) for t in range(5)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "pos", "name", "up", "depth", "giver", "head", "n_chars"):
        frame = frame.withColumn(name, frame["text"])
    assert got(trie.rebuilt_trie(frame)) == plain(rebuilt(rows))
    assert trie.rebuilt_trie(frame.limit(0)).count() == 0
