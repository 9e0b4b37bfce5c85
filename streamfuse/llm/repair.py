"""Conversation structure repair: the cheapest edits that make a conversation's roles alternate.

Roles must read ``(s?(ua)+)?`` by their initials: an optional system turn, then user and assistant in turn. A Viterbi walk goes
over the rows of a conversation; its states are what the repaired turns so far end with. Each state has a survivor, the
cheapest way to reach it, and of equally cheap ones the one whose edits read least. Survivors are leaves of a tree
of backpointers whose nodes count who refers to them: a survivor that loses is let go of, and with it all that only it
referred to. As soon as all survivors have an ancestor in common, the edits up to it are final; they are handed on and
their rows forgotten. A tie is decided by the complete edits since that ancestor, which is all in which the tied ways differ.

Conversations are sorted by the engine and streamed, so a task holds the unresolved rows of one conversation, however
long it is. Only stretches in which every row gets another role keep two ways open, one row apart, and are held until one of them
wins. The hash over a conversation's text is sequential by definition, so a conversation is read by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamfuse.llm.common import crc32_sql

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# What the repaired turns so far end with.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
BLANKS = " \t\n\v\f\r"
LEGAL = ("su", "ua", "au")


class Node:
    """One edit; ``refs`` counts the edits after it and the survivors that end with it."""

    __slots__ = ("letter", "role", "text", "up", "refs")

    def __init__(self, letter: str, role: str | None, text: str | None, up: Node | None):
        self.letter, self.role, self.text, self.up, self.refs = letter, role, text, up, 0
        if up is not None:
            up.refs += 1


class Viterbi:
    """The survivors of one conversation. ``emit`` gets every edit as soon as it is final, in order."""

    def __init__(self, emit):
        self.emit = emit
        self.root = Node("", None, None, None)
        self.alive: list[tuple[int, Node] | None] = [(0, self._held(self.root)), None, None, None]
        self.waiting = 0  # edits since the root on the longest way, for tests
        self._inserts()

    def _held(self, node: Node) -> Node:
        node.refs += 1
        return node

    def _let_go(self, node: Node | None) -> None:
        while node is not None:
            node.refs -= 1
            if node.refs:
                return
            above, node.up = node.up, None
            node = above

    def _way(self, node: Node) -> list[Node]:
        """The edits from the common ancestor to a node."""
        way = []
        while node is not self.root:
            way.append(node)
            node = node.up
        return way[::-1]

    def _reads(self, node: Node, letter: str) -> str:
        return "".join(n.letter for n in self._way(node)) + letter

    def _better(self, new: tuple, old: tuple | None) -> bool:
        """``new`` and ``old`` are (cost, node to go on from, letter of the next edit)."""
        if old is None or new[0] != old[0]:
            return old is None or new[0] < old[0]
        return self._reads(new[1], new[2]) < self._reads(old[1], old[2])

    def _replace(self, state: int, cost: int, node: Node) -> None:
        self._held(node)
        if self.alive[state] is not None:
            self._let_go(self.alive[state][1])
        self.alive[state] = (cost, node)

    def _inserts(self) -> None:
        """Ways that go on with an inserted turn; two in a row at most are ever worth it."""
        for ends, role, befores in ((USER, "user", (NOTHING, SYSTEM, ASSISTANT)), (ASSISTANT, "assistant", (USER,))):
            held = self.alive[ends]
            best = None if held is None else (held[0], held[1], "")
            for before in befores:
                if self.alive[before] is not None:
                    cost, node = self.alive[before]
                    way = (cost + INSERT, node, "I")
                    if self._better(way, best):
                        best = way
            if best is not None and best[2]:
                self._replace(ends, best[0], Node("I", role, "", best[1]))

    def step(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        """Take one row; ``must_go`` rows can only be deleted."""
        ways: list[tuple | None] = [None] * 4  # (cost, node, letter, role)

        def offer(state: int, way: tuple) -> None:
            if self._better(way, ways[state]):
                ways[state] = way

        initial, extra = role[:1], TRUNCATED if truncated else 0
        for state, held in enumerate(self.alive):
            if held is None:
                continue
            cost, node = held
            offer(state, (cost + DELETE, node, "D", None))
            if must_go:
                continue
            if state == NOTHING and initial == "s":
                offer(SYSTEM, (cost + extra, node, "K", role))
            wanted, name, ends = ("a", "assistant", ASSISTANT) if state == USER else ("u", "user", USER)
            if initial == wanted:
                offer(ends, (cost + extra, node, "K", role))
            else:
                offer(ends, (cost + REROLE + extra, node, "R", name))
        before = [held[1] for held in self.alive if held is not None]
        self.alive = [
            None if w is None else (w[0], self._held(Node(w[2], w[3], None if w[3] is None else text, w[1])))
            for w in ways
        ]
        for node in before:
            self._let_go(node)
        self._inserts()
        self._prune()
        self._settle()

    def _prune(self) -> None:
        """Drop survivors that can't win: whatever follows, the assistant's state does as well as the state after a
        system turn, and as the empty one for the price of the deletion of a system turn that this could keep."""
        last = self.alive[ASSISTANT]
        for state, more in ((NOTHING, DELETE), (SYSTEM, 0)):
            held = self.alive[state]
            if held is not None and last is not None and held[0] > last[0] + more:
                self.alive[state] = None
                self._let_go(held[1])

    def _settle(self) -> None:
        """Hand on the edits that all survivors share."""
        ends = [held[1] for held in self.alive if held is not None]
        way = self._way(ends[0])
        self.waiting = len(way)
        for node in way:
            # The root is left only if nothing but this edit refers to it.
            if self.root.refs != 1:
                return
            self._final(node)

    def _final(self, node: Node) -> None:
        self.emit(node.letter, node.role, node.text)
        node.up, node.text, self.root = None, None, node

    def finish(self) -> int:
        """Hand on the rest and give the cost."""
        best = None
        for state in (NOTHING, ASSISTANT):
            if self.alive[state] is not None:
                cost, node = self.alive[state]
                if self._better((cost, node, ""), best):
                    best = (cost, node, "")
        for node in self._way(best[1]):
            self._final(node)
        return best[0]


class Conversation:
    """Counts and edits of one conversation, row by row."""

    def __init__(self, conv_id, keep_turns: bool):
        self.conv_id, self.keep_turns = conv_id, keep_turns
        self.least = self.most = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: tuple | None = None  # the last row
        self.audit: list[str] = []
        self.hash, self.written = hashlib.sha256(), 0
        self.repaired: list[tuple] = []
        self.viterbi = Viterbi(self._edit)

    def _edit(self, letter: str, role: str | None, text: str | None) -> None:
        self.audit.append(letter)
        if role is None:
            return
        start = "\n" if self.written else ""
        self.hash.update(f"{start}{role}:{text}".encode())
        if self.keep_turns:
            self.repaired.append((self.conv_id, self.written, letter, role, text))
        self.written += 1

    def row(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        """``seen`` tells that the row's role and text stand in an earlier turn."""
        if turn is not None and turn != self.last_turn:
            self.turns, self.last_turn, self.most = self.turns + 1, turn, turn
            self.least = turn if self.least is None else self.least
        solid = text.rstrip(BLANKS)
        blank = not solid
        # Equal rows of one turn are neighbours.
        repeat = not blank and (seen or self.before == (turn, role, text))
        cut = not blank and not repeat and solid[-1] not in ".!?"
        if self.before is not None:
            self.illegal += self.before[1][:1] + role[:1] not in LEGAL
        self.blank, self.duplicate = self.blank + blank, self.duplicate + repeat
        self.truncated += cut
        self.before = (turn, role, text)
        self.viterbi.step(role, text, blank or repeat, cut)

    def report(self) -> tuple:
        cost = self.viterbi.finish()
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost)
        return (self.conv_id, *counts, "".join(self.audit), self.hash.hexdigest())


REPORT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint,"
    " audit string, repaired_sha256 string"
)
TURNS = "conv_id bigint, position bigint, edit string, role string, text string"


def _arrow(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    fields = [f.split() for f in ddl.split(", ")]
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)],
                                      [n for n, _ in fields])


def _walk(keep_turns: bool):
    """Over rows sorted by conversation and turn, which may go on from batch to batch."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        for batch in batches:
            reports, turns = [], []
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "seen", "absent")]
            for conv_id, turn, role, text, seen, absent in zip(*columns, strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        reports.append(now.report())
                        turns += now.repaired
                    now = Conversation(conv_id, keep_turns)
                if not absent:
                    now.row(turn, role, text, seen)
            if keep_turns and now is not None:
                turns += now.repaired
                now.repaired = []
            if keep_turns and turns:
                yield _arrow(turns, TURNS)
            if not keep_turns and reports:
                yield _arrow(reports, REPORT)
        if now is not None:
            report = now.report()
            if not keep_turns:
                yield _arrow([report], REPORT)
            elif now.repaired:
                yield _arrow(now.repaired, TURNS)

    return of_partition


def _sorted(rows: DataFrame, absent: str | None) -> DataFrame:
    """(conv_id, turn, role, text, seen, absent) by conversation and turn; equal rows of a turn are neighbours."""
    plain = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.coalesce(F.col(absent), F.lit(False)) if absent else F.lit(False)).alias("absent"),
    )
    # A null turn comes before all others.
    alike = Window.partitionBy("conv_id", F.xxhash64("text"), "role", "text", "absent")
    first, without = F.min("turn").over(alike), F.count_if(F.col("turn").isNull()).over(alike)
    seen = F.col("turn").isNotNull() & ((without > 0) | (first < F.col("turn")))
    marked = plain.withColumn("seen", F.coalesce(seen, F.lit(False)))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    return marked.repartition("conv_id").sortWithinPartitions(*order)


def repair_report(rows: DataFrame, absent: str | None = None) -> DataFrame:
    """One row per conversation: faults, cost, the edits' initials and a hash of the repaired turns.

    ``rows`` has conv_id, turn, role and text. Rows of a conversation are taken by turn, those without a turn first, ties by role and
    text. A null role or text is one space; a null conv_id is a conversation of its own. Empty, blank and repeated rows are
    deleted at their price; a very long text is hashed as a whole and only held until its edit is final. Rows with
    ``absent`` only name their conversation: one without other rows has zeros, an empty audit and the empty text's hash.
    Other columns are left aside. An empty table gives an empty one.
    """
    return _sorted(rows, absent).mapInArrow(_walk(False), REPORT)


def repaired_turns(rows: DataFrame, absent: str | None = None) -> DataFrame:
    """(conv_id, position, edit, role, text): the repaired conversations themselves, by the edits of the report."""
    return _sorted(rows, absent).mapInArrow(_walk(True), TURNS)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped): rows damaged by a checksum of their number; nulls are one space."""

    def number(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(number("conv_id"), F.lit(":"), number("turn"))) % 20
    plain = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        kind.alias("kind"),
    )
    kind, text = F.col("kind"), F.col("text")
    text = F.when(kind.isin(0, 1), F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(text)
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    made = plain.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("dropped"), copies.alias("k"))
    return made.select("conv_id", "turn", "role", "text", "dropped", F.explode("k").alias("k")).drop("k")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    return repair_report(damaged(conversations), absent="dropped")


def oracle_sql() -> str:
    """The same in SQL: a table of the four states, each with its cost and edits, carried from row to row."""

    def way(state: str, cost: str, letter: str, when: str = "TRUE") -> str:
        return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}} END"

    def turn(state: str, initial: str) -> str:
        keep = way(state, "extra", "K", f"stays AND initial = '{initial}'")
        return f"{keep}, {way(state, f'{REROLE} + extra', 'R', f"stays AND initial <> '{initial}'")}"

    def gone(state: str) -> str:
        return way(state, str(DELETE), "D")

    def put(state: str) -> str:
        return way(state, str(INSERT), "I")

    number = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    solid = r"[^\x20\x09-\x0D]"
    return rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql(number)} % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) FROM raw WHERE kind <> 0)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn FROM damaged),
told AS (
  SELECT *, substr(role, 1, 1) AS initial, NOT regexp_matches(text, '{solid}') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 AS again,
    regexp_extract(text, '({solid})[ 	-]*$', 1) NOT IN ('.', '!', '?') AS cut,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY rn) || substr(role, 1, 1) AS pair FROM numbered),
lines AS (
  SELECT *, again AND NOT blank AS duplicate, cut AND NOT blank AND NOT again AS truncated, NOT blank AND NOT again AS stays,
    CASE WHEN cut AND NOT blank AND NOT again THEN {TRUNCATED} ELSE 0 END AS extra FROM told),
walk AS (
  SELECT conv_id, 0::BIGINT AS rn, {{'c': 0, 'a': ''}} AS s0, NULL::STRUCT(c INTEGER, a VARCHAR) AS s1,
    {{'c': {INSERT}, 'a': 'I'}} AS s2, {{'c': {2 * INSERT}, 'a': 'II'}} AS s3
  FROM (SELECT DISTINCT conv_id FROM lines)
  UNION ALL
  SELECT conv_id, rn, n0, n1, m2, list_min([n3, {put("m2")}]) FROM (
    SELECT *, list_min([n2, {put("n0")}, {put("n1")}, {put("n3")}]) AS m2 FROM (
      SELECT l.conv_id, l.rn, {gone("s0")} AS n0,
        list_min([{gone("s1")}, {way("s0", "extra", "K", "stays AND initial = 's'")}]) AS n1,
        list_min([{gone("s2")}, {turn("s0", "u")}, {turn("s1", "u")}, {turn("s3", "u")}]) AS n2,
        list_min([{gone("s3")}, {turn("s2", "a")}]) AS n3
      FROM walk w JOIN lines l ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.rn = w.rn + 1))),
best AS (SELECT conv_id, list_min([arg_max(s0, rn), arg_max(s3, rn)]) AS b FROM walk GROUP BY conv_id),
letters AS (SELECT conv_id, b.a AS audit, unnest(range(1, len(b.a) + 1)) AS i FROM best),
edits AS (
  SELECT conv_id, i, audit[i] AS l, sum(CASE WHEN audit[i] = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY i) AS rn,
    sum(CASE WHEN audit[i] = 'D' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY i) AS place FROM letters),
kept AS (
  SELECT e.conv_id, i, l, place, CASE WHEN l <> 'I' THEN x.role END AS role, CASE WHEN l = 'I' THEN '' ELSE x.text END AS text
  FROM edits e LEFT JOIN lines x ON x.conv_id IS NOT DISTINCT FROM e.conv_id AND x.rn = e.rn WHERE l <> 'D'),
opened AS (SELECT *, coalesce(bool_or(place = 1 AND l = 'K' AND role[1] = 's') OVER (PARTITION BY conv_id), FALSE) AS s FROM kept),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN l = 'K' THEN role WHEN (place - CASE WHEN s THEN 1 ELSE 0 END) % 2 = 1 THEN 'user'
    ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i) AS t FROM opened GROUP BY conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM lines GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0)::BIGINT AS cost,
  coalesce(b.a, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id"""
