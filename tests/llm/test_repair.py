import hashlib
import itertools
import random
import re
import zlib

import pytest

from streamfuse.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")
STATES = re.compile(r"(s?(ua)+)?")


def damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub(r"[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(c, t, role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        solid = BLANK.findall(text)
        if not solid:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def every_repair(rows, found):
    """All edit sequences with up to two insertions at each place, as (cost, audit, turns)."""
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]

    def options(row, fault):
        yield 4, "D", None
        if fault in ("blank", "duplicate"):
            return
        more = 3 if fault == "truncated" else 0
        yield more, "K", (row[2], row[3])
        for role in ("user", "assistant"):
            yield 3 + more, "R", (role, row[3])

    per_row = [list(options(r, f)) for r, f in zip(rows, found, strict=True)]
    for edits in itertools.product(*per_row):
        for added in itertools.product(inserts, repeat=len(rows) + 1):
            cost, audit, turns = 3 * len(added[0]), "I" * len(added[0]), [(r, "") for r in added[0]]
            for (c, letter, turn), more in zip(edits, added[1:], strict=True):
                cost, audit = cost + c + 3 * len(more), audit + letter + "I" * len(more)
                turns = turns + ([turn] if turn else []) + [(r, "") for r in more]
            if STATES.fullmatch("".join(r[:1] or "-" for r, _ in turns)):
                yield cost, audit, turns


def cheapest(rows, found):
    """The same by a table of (cost, audit, turns) for every state, without a tree."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}

    def relax(table):
        for _ in range(3):
            for s, (c, a, t) in list(table.items()):
                for role in ("user", "assistant"):
                    if (s, role[0]) in step:
                        way = (c + 3, a + "I", [*t, (role, "")])
                        e = step[s, role[0]]
                        table[e] = min(table.get(e, way), way, key=lambda w: w[:2])
        return table

    table = relax({0: (0, "", [])})
    for row, fault in zip(rows, found, strict=True):
        nxt, more = {}, 3 if fault == "truncated" else 0
        for s, (c, a, t) in table.items():
            ways = [(s, (c + 4, a + "D", t))]
            if fault not in ("blank", "duplicate"):
                for role, price, letter in ((row[2], 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")):
                    if (s, role[:1]) in step:
                        ways.append((step[s, role[:1]], (c + price + more, a + letter, [*t, (role, row[3])])))
            for e, way in ways:
                nxt[e] = min(nxt.get(e, way), way, key=lambda w: w[:2])
        table = relax(nxt)
    return min((table[s] for s in (0, 3) if s in table), key=lambda w: w[:2])


def plain(rows, search=cheapest):
    """{conv_id: report} of rows that are not to be damaged any more."""
    out = {}
    for c in dict.fromkeys(r[0] for r in rows):
        own = [r for r in rows if r[0] == c]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        found = faults(own)
        turns = {r[1] for r in own} - {None}
        cost, audit, repaired = search(own, found)
        pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(own)]
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        out[c] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(found.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


def reports(frame):
    got = [tuple(r) for r in frame.collect()]
    assert len(got) == len({r[0] for r in got})
    return {r[0]: r[1:] for r in got}


def some_rows(draw, conversations, most):
    rows = []
    for c in range(conversations):
        for t in range(draw.randrange(most + 1)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
            rows.append((c, t, role, draw.choice(["yes.", "no", "", " \t", "why?", "é!  ", "long text."])))
    return rows


def walked(rows, found):
    edits = []
    v = repair.Viterbi(lambda *e: edits.append(e))
    longest = 0
    for r, f in zip(rows, found, strict=True):
        v.step(r[2], r[3], f in ("blank", "duplicate"), f == "truncated")
        longest = max(longest, v.waiting)
    cost = v.finish()
    return cost, "".join(e[0] for e in edits), [(e[1], e[2]) for e in edits if e[1] is not None], longest


def test_table_equals_every_repair():
    draw = random.Random(1)
    for _ in range(60):
        rows = [r for r in some_rows(draw, 1, 3)]
        found = faults(rows)
        assert cheapest(rows, found)[:2] == min(w[:2] for w in every_repair(rows, found))


def test_walk_equals_the_table():
    draw = random.Random(2)
    for n in [*range(8)] * 60 + [200] * 5:
        rows = [(0, i, draw.choice(["user", "assistant", "system", "x"]), draw.choice(["a.", f"b{i}.", f"c{i}", ""])) for i in range(n)]
        found = faults(rows)
        assert walked(rows, found)[:3] == cheapest(rows, found)


MIXED = ["user", "assistant", "user", "user", "system", "assistant", "assistant", "x", "user", "assistant"]


@pytest.mark.parametrize(
    ("roles", "open_edits"),
    [(["user", "assistant"], 40), (["user"], 40), (["assistant"], 40), (MIXED, 40), (["system"], 3000), (["x"], 3000)],
)
def test_edits_become_final_on_the_way(roles, open_edits):
    """Memory follows the unresolved rows; only rows that all get another role leave two ways open."""
    rows = [(0, i, roles[i % len(roles)], f"row {i}" + "." * (i % 4)) for i in range(3000)]
    cost, audit, turns, longest = walked(rows, faults(rows))
    assert longest <= open_edits
    assert (cost, audit, turns) == cheapest(rows, faults(rows))


def test_report_equals_a_plain_version(spark):
    rows = some_rows(random.Random(3), 150, 12)
    rows += [(500, None, "user", "a."), (500, None, "user", "a."), (500, 3, "user", "a."), (500, 3, None, None)]
    rows += [(None, 1, "user", "x."), (None, None, "user", "x."), (501, 0, "user", "x" * 200_000 + ".")]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert reports(repair.repair_report(frame)) == plain([(c, t, r or " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])


def test_damaged_conversations_equal_a_plain_version(spark):
    rows = some_rows(random.Random(4), 300, 8)
    rows += [(700 + i, None if i % 2 else 5, None, None) for i in range(30)]
    rows += [(800 + i, 0, "user", "only one.") for i in range(60)]  # some conversations lose all their rows
    want = plain(damage(rows))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = reports(repair.damaged_and_repaired(spark.createDataFrame(rows, SCHEMA)))
    assert got == {c: want.get(c, empty) for c in {r[0] for r in rows}}
    assert empty in got.values()


def test_turns_are_those_of_the_hash(spark):
    rows = some_rows(random.Random(5), 80, 10)
    frame = spark.createDataFrame(rows, SCHEMA)
    turns = {}
    for r in sorted(repair.repaired_turns(frame).collect(), key=lambda r: (r.conv_id, r.position)):
        turns.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for c, report in reports(repair.repair_report(frame)).items():
        assert report[-1] == hashlib.sha256("\n".join(turns.get(c, [])).encode()).hexdigest()


def test_empty_table_and_other_columns(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a.")], SCHEMA)
    for name in ("seen", "absent", "kind", "k", "dropped", "position"):
        frame = frame.withColumn(name, frame["text"])
    assert repair.damaged_and_repaired(frame.limit(0)).count() == 0
    assert repair.damaged_and_repaired(frame).count() == 1
