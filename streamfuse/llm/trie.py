"""Prefix trie of conversations, built from burst tries.

A turn's id is a hash of its role and text; a conversation is a sequence of ids, cut into suffixes of bounded length. A suffix
stands under the trie head that the turns before it make, named by the chained hash of their ids, so equal beginnings have
equal heads wherever they are read. Suffixes are dealt into shards of bounded size by head and next turn; a frequent
next turn is spread over several shards. Inside a shard each head has a container of suffixes. A container that
holds too many bursts: it becomes a trie node, and its suffixes go to one container for each next turn id. What is left in
containers at the end is sorted, and one sweep over neighbours with a common beginning makes the nodes. Nodes that several shards
have are added up by their chained hashes.

Sums over subtrees are made by doubling: each node adds what it has to the node one step up, then two, then four steps up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamfuse.llm.common import crc32_sql, written

ID = 16  # bytes of a turn id and of a chained hash
# Turns of one suffix, turns of one shard, and suffixes that a container holds before it bursts.
SUFFIX_TURNS = 256
SHARD_TURNS = 200_000
CONTAINER = 64
ROOT = bytes(ID)
SEED = 42


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes that tell turns apart; the role's length keeps role and text from running into each other."""
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def chained(prefix: bytes, turn: bytes) -> bytes:
    """The name of the node that ``turn`` leads to from the node ``prefix``."""
    return xxhash.xxh3_128_digest(prefix + turn, SEED)


# Burst tries


class Node:
    """A node of a shard's trie: a container of suffixes until it bursts, then one child for each next turn id."""

    __slots__ = ("prefix", "depth", "chars", "count", "least", "children", "box")

    def __init__(self, prefix: bytes, depth: int, chars: int):
        self.prefix, self.depth, self.chars = prefix, depth, chars
        self.count, self.least = 0, None
        self.children: dict[bytes, Node] | None = None
        self.box: list[tuple] = []

    def member(self, conv_id: int) -> None:
        self.count += 1
        self.least = conv_id if self.least is None else min(self.least, conv_id)

    def child(self, turn: bytes, chars: int) -> Node:
        found = self.children.get(turn)
        if found is None:
            found = self.children[turn] = Node(chained(self.prefix, turn), self.depth + 1, chars)
        return found


class BurstTrie:
    """Suffixes under one head. A suffix is (conv_id, ids, lengths): ids run together, ID bytes each."""

    def __init__(self, prefix: bytes, depth: int, container: int = CONTAINER):
        self.head, self.container = Node(prefix, depth, 0), container

    def add(self, conv_id: int, ids: bytes, lengths: list[int]) -> None:
        node, at = self.head, 0
        node.member(conv_id)
        while node.children is not None:
            if at == len(lengths):
                return
            node = node.child(ids[at * ID : at * ID + ID], lengths[at])
            node.member(conv_id)
            at += 1
        node.box.append((ids[at * ID :], lengths[at:], conv_id))
        self._burst(node)

    def _burst(self, node: Node) -> None:
        full = [node]
        while full:
            node = full.pop()
            if len(node.box) <= self.container or node.children is not None:
                continue
            box, node.box, node.children = node.box, [], {}
            for ids, lengths, conv_id in box:
                if lengths:
                    child = node.child(ids[:ID], lengths[0])
                    child.member(conv_id)
                    child.box.append((ids[ID:], lengths[1:], conv_id))
            full.extend(node.children.values())

    def nodes(self) -> Iterator[tuple]:
        """(name, parent's name, depth, members, smallest member, length of the last text), the head left out."""
        waiting = [(self.head, None)]
        while waiting:
            node, parent = waiting.pop()
            if parent is not None:
                yield node.prefix, parent, node.depth, node.count, node.least, node.chars
            if node.children is None:
                yield from _swept(node)
            else:
                waiting.extend((child, node.prefix) for child in node.children.values())


def _swept(top: Node) -> Iterator[tuple]:
    """The nodes below a container: its suffixes in order, a node for each beginning of them."""
    path = [(top.prefix, 0)]  # names from the container's own node down, and lengths of last texts
    counts, least = [0], [None]
    before = b""

    def close() -> tuple:
        (name, chars), count, low = path.pop(), counts.pop(), least.pop()
        counts[-1] += count
        least[-1] = low if least[-1] is None else min(least[-1], low)
        return name, path[-1][0], top.depth + len(path), count, low, chars

    for ids, lengths, conv_id in sorted(top.box):
        common = 0
        while common < min(len(ids), len(before)) and ids[common : common + ID] == before[common : common + ID]:
            common += ID
        while len(path) > common // ID + 1:
            yield close()
        for at in range(common // ID, len(lengths)):
            path.append((chained(path[-1][0], ids[at * ID : at * ID + ID]), lengths[at]))
            counts.append(0)
            least.append(None)
        counts[-1] += 1
        least[-1] = conv_id if least[-1] is None else min(least[-1], conv_id)
        before = ids
    while len(path) > 1:
        yield close()


# Sequences to suffixes

SUFFIXES = (
    "conv_id bigint, depth bigint, head binary, first binary, ids binary, lengths array<int>, end binary, n_turns bigint"
)


def _suffixes(turns: DataFrame, size: int) -> DataFrame:
    """Rows of (conv_id, pos, id, n_chars), one with pos -1 and no id for each conversation, as suffixes of ``size`` turns at most.

    ``end`` is the name of a conversation's last node, on its last suffix.
    """

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush(last: bool) -> None:
            first = chained(head, ids[0]) if ids else head
            end = prefix if last else None
            out.append((conv_id, depth, head, first, b"".join(ids), list(lengths), end, len(ids)))

        conv_id = None
        head = prefix = ROOT
        depth, ids, lengths = 0, [], []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "id", "n_chars")]
            for c, turn, chars in zip(*columns, strict=True):
                if turn is None:  # a conversation's first row
                    if conv_id is not None:
                        flush(True)
                    conv_id, head, prefix, depth = c, ROOT, ROOT, 0
                    ids, lengths = [], []
                    continue
                if len(ids) == size:
                    flush(False)
                    head, depth = prefix, depth + size
                    ids, lengths = [], []
                ids.append(turn)
                lengths.append(chars)
                prefix = chained(prefix, turn)
            if out:
                yield _batch(out, SUFFIXES)
                out.clear()
        if conv_id is not None:
            flush(True)
            yield _batch(out, SUFFIXES)

    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    return dealt.select("conv_id", "id", "n_chars").mapInArrow(of_partition, SUFFIXES)


KINDS = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    fields = [f.split() for f in ddl.split(", ")]
    columns = list(zip(*rows, strict=True))
    arrays = [pa.array(c, KINDS[k]) for c, (_, k) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in fields])


def _shards(suffixes: DataFrame, shard_turns: int) -> DataFrame:
    """Suffixes with a shard; those with one next turn under one head stay together unless they are too many."""
    sizes = suffixes.groupBy("first").agg(F.sum("n_turns").alias("n"))
    many = sizes.filter(F.col("n") > shard_turns)
    many = many.select("first", F.ceil(F.col("n") / shard_turns).alias("parts"))
    total = suffixes.agg(F.sum("n_turns")).first()[0] or 0
    shards = F.lit(max(1, -(-total // shard_turns)))
    part = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("conv_id"), F.col("parts"))).otherwise(F.lit(0))
    dealt = suffixes.join(many, "first", "left")
    return dealt.withColumn("shard", F.pmod(F.xxhash64("first", part), shards)).drop("parts")


NODES = (
    "name binary, up binary, depth bigint, n_convs bigint, least bigint, chars bigint"
)


def _nodes(suffixes: DataFrame, shard_turns: int, container: int) -> DataFrame:
    """(name, up, depth, n_convs, least, chars) of every node but the root."""

    def of_shard(table: pa.Table) -> pa.Table:
        tries: dict[bytes, BurstTrie] = {}
        columns = [table.column(n).to_pylist() for n in ("conv_id", "depth", "head", "ids", "lengths")]
        for conv_id, depth, head, ids, lengths in zip(*columns, strict=True):
            if head not in tries:
                tries[head] = BurstTrie(head, depth, container)
            tries[head].add(conv_id, ids, lengths)
        rows = [node for trie in tries.values() for node in trie.nodes()]
        return pa.Table.from_batches([_batch(rows, NODES)]) if rows else pa.table(
            {n: pa.array([], KINDS[k]) for n, k in (f.split() for f in NODES.split(", "))}
        )

    held = _shards(suffixes.filter(F.col("n_turns") > 0), shard_turns)
    held = held.select("shard", "conv_id", "depth", "head", "ids", "lengths")
    parts = held.groupBy("shard").applyInArrow(of_shard, NODES)
    return parts.groupBy("name", "up", "depth", "chars").agg(
        F.sum("n_convs").alias("n_convs"), F.min("least").alias("least")
    )


def _ends(suffixes: DataFrame) -> DataFrame:
    """(name, ends_sha256): a hash of the conversations that end at a node, streamed in order of their numbers."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, digest = None, None
        for batch in batches:
            rows = []
            for end, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if end != name:
                    if name is not None:
                        rows.append((name, digest.hexdigest()))
                    name, digest = end, hashlib.sha256(str(conv_id).encode())
                else:
                    digest.update(f",{conv_id}".encode())
            if rows:
                yield _batch(rows, "name binary, ends_sha256 string")
        if name is not None:
            yield _batch([(name, digest.hexdigest())], "name binary, ends_sha256 string")

    ends = suffixes.filter(F.col("end").isNotNull()).select("end", "conv_id")
    ends = ends.repartition("end").sortWithinPartitions("end", "conv_id")
    return ends.mapInArrow(of_partition, "name binary, ends_sha256 string")


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """(name, n_leaves, saved_tokens) from rows of (name, up, leaves, saved); the top's ``up`` is null."""
    rows = nodes
    while not rows.filter(F.col("up").isNotNull()).isEmpty():
        # What each node has is that of the nodes up to 2^k - 1 steps below it; ``up`` is 2^k steps above.
        given = rows.filter(F.col("up").isNotNull()).groupBy(F.col("up").alias("name"))
        given = given.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = rows.select(F.col("name").alias("up"), F.col("up").alias("up2"))
        step = rows.join(given, "name", "left").join(above, "up", "left")
        rows = written(
            step.select(
                "name",
                F.col("up2").alias("up"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "trie-sums",
        )
    return rows.select("name", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def prefix_trie(
    turns: DataFrame,
    suffix_turns: int = SUFFIX_TURNS,
    shard_turns: int = SHARD_TURNS,
    container: int = CONTAINER,
) -> DataFrame:
    """Every node of the trie of sequences of turns.

    ``turns`` has (conv_id, pos, id, n_chars), and for each conversation one row with pos -1 and a null id, so that one without
    turns is a member of the root. Sequences are read in order of pos. The result has name, up, conv_id (the smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256. An empty table has no node.
    """
    suffixes = written(_suffixes(turns, suffix_turns), "trie-suffixes")
    members = suffixes.filter(F.col("depth") == 0)
    root = members.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("least")).filter(F.col("n_convs") > 0)
    root = root.select(
        F.lit(ROOT).alias("name"), F.lit(None).cast("binary").alias("up"), F.lit(0).cast("bigint").alias("depth"),
        F.lit(0).cast("bigint").alias("chars"), "n_convs", "least",
    )
    nodes = written(_nodes(suffixes, shard_turns, container).unionByName(root), "trie-nodes")
    children = nodes.groupBy(F.col("up").alias("name")).agg(F.count("*").alias("n_children"))
    placed = nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
    placed = written(placed.join(_ends(suffixes), "name", "left"), "trie-placed")
    own = placed.select(
        "name", "up", (F.col("n_children") == 0).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    parents = nodes.select(F.col("name").alias("up"), F.col("least").alias("parent_conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    whole = placed.join(_subtree_sums(own), "name").join(parents, "up", "left")
    return whole.select(
        "name", "up", F.col("least").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, id, n_chars): turns numbered from 0; null turns first, ties by role and text.

    A null role or text is empty. Rows without a conv_id belong to no conversation and take no part.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    slim = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("turn"),
        turn_id(role, text).alias("id"), F.char_length(text).alias("n_chars"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id")
    return slim.select("conv_id", (F.row_number().over(order) - 1).alias("pos"), "id", "n_chars")


def borrowed_beginnings(turns: DataFrame) -> DataFrame:
    """Sequences whose first turns, up to five of them by a checksum of the number, are those of the conversation whose
    number ends with 00; each conversation also has its row with pos -1."""
    head = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    turns = written(turns, "trie-turns")
    conversations = turns.filter(F.col("pos") == 0).select("conv_id")
    own = turns.filter(F.col("pos") >= head)
    givers = turns.filter((F.col("conv_id") % 100 == 0) & (F.col("pos") < 5)).select(
        F.col("conv_id").alias("giver"), "pos", "id", "n_chars"
    )
    asked = conversations.withColumns({"giver": F.col("conv_id") - F.col("conv_id") % 100, "head": head})
    taken = asked.join(givers, "giver").filter(F.col("pos") < F.col("head"))
    starts = conversations.select(
        "conv_id", F.lit(-1).alias("pos"), F.lit(None).cast("binary").alias("id"), F.lit(0).alias("n_chars")
    )
    return own.unionByName(taken.select("conv_id", "pos", "id", "n_chars")).unionByName(starts)


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations with borrowed beginnings."""
    return prefix_trie(borrowed_beginnings(turn_rows(conversations))).drop("name", "up")


def oracle_sql() -> str:
    """The same in SQL: all beginnings of all sequences, subtrees by comparing beginnings."""
    return f"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS pos,
    md5(length(role) || ':' || role || text) AS id, length(text) AS n
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (SELECT conv_id, {crc32_sql("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rows_ AS (
  SELECT conv_id, pos, id, n FROM turns JOIN heads USING (conv_id) WHERE pos > h
  UNION ALL SELECT c.conv_id, pos, id, n FROM heads c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 WHERE pos <= h),
sequences AS (
  SELECT conv_id, coalesce(list(id ORDER BY pos) FILTER (id IS NOT NULL), []) AS ids, coalesce(list(n ORDER BY pos) FILTER (id IS NOT NULL), []) AS ns
  FROM heads LEFT JOIN rows_ USING (conv_id) GROUP BY conv_id),
members AS (
  SELECT conv_id, d, array_to_string(ids[1:d], '') AS k, CASE WHEN d > 0 THEN ns[d] ELSE 0 END AS chars, d = len(ids) AS ends
  FROM (SELECT *, unnest(range(len(ids) + 1)) AS d FROM sequences)),
nodes AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS own FROM members GROUP BY k, d),
families AS (
  SELECT p.k, p.d, count(c.k) AS n_children FROM nodes p LEFT JOIN nodes c ON c.d = p.d + 1 AND starts_with(c.k, p.k) GROUP BY p.k, p.d),
sums AS (
  SELECT t.k, t.d, count(*) FILTER (f.n_children = 0) AS n_leaves, sum(b.saved)::BIGINT AS saved_tokens
  FROM nodes t JOIN nodes b ON b.d >= t.d AND starts_with(b.k, t.k) JOIN families f ON f.k = b.k AND f.d = b.d GROUP BY t.k, t.d)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens,
  sha256(n.own) AS ends_sha256
FROM nodes n JOIN families USING (k, d) JOIN sums USING (k, d)
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.k = n.k[1:32 * (n.d - 1)]"""
