"""Best-fit packing of documents into training sequences, with conflicts.

A document longer than a sequence fills sequences of its own; what remains, and shorter documents whole, is
packed best-fit: pieces in falling order of length, each into the open bin with the least room that still
holds it. Bins are kept in order of their room and carry two bitmaps, of the sources and of the duplicate clusters in
them. If the tightest bin already has the piece's source or cluster, the search goes on to its
successor until a bin has neither; if none has, a new bin opens.

Pieces are packed in shards of bounded size, which take their rows from all sources alike.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamfuse.llm import mixing, simhash
from streamfuse.llm.common import whole, written

SEQUENCE_TOKENS = 2_048
SHARD_DOCS = 4_096


class Bins:
    """Open bins in order of their room."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.rooms: list[int] = []  # the different rooms, ascending
        self.at: dict[int, list[int]] = {}  # room -> bins, ascending

    def _hold(self, bin_: int, room: int) -> None:
        if room not in self.at:
            self.at[room] = []
            insort(self.rooms, room)
        insort(self.at[room], bin_)

    def new(self, size: int, source: int, cluster: int) -> int:
        bin_ = len(self.sources)
        self.sources.append(source)
        self.clusters.append(cluster)
        self._hold(bin_, self.capacity - size)
        return bin_

    def place(self, size: int, source: int, cluster: int) -> int:
        """The bin of the least room that holds ``size`` and has neither bit; the first of equal ones."""
        for i in range(bisect_left(self.rooms, size), len(self.rooms)):
            room = self.rooms[i]
            for bin_ in self.at[room]:
                if not (self.sources[bin_] & source or self.clusters[bin_] & cluster):
                    self.at[room].remove(bin_)
                    if not self.at[room]:
                        del self.at[room]
                        del self.rooms[i]
                    self.sources[bin_] |= source
                    self.clusters[bin_] |= cluster
                    self._hold(bin_, room - size)
                    return bin_
        return self.new(size, source, cluster)


def pack_shard(rows: list[tuple], capacity: int) -> list[tuple]:
    """(row, piece, first token, tokens, bin) for rows of (tokens, source, cluster).

    Bins of whole sequences come first, in order of the rows; then those of the packed rest.
    """
    out, rest, whole_bins = [], [], 0
    for k, (tokens, source, cluster) in enumerate(rows):
        full, left = divmod(tokens, capacity)
        for piece in range(full):
            out.append((k, piece, piece * capacity, capacity, whole_bins))
            whole_bins += 1
        if left or not tokens:  # a text without words still has a piece
            rest.append((left, k, full, source, cluster))
    many = {}
    for _, _, _, _, cluster in rest:
        many[cluster] = many.get(cluster, 0) + 1
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(r[3] for r in rest))}
    shared = [c for c, n in many.items() if n > 1]
    cluster_bit = {c: 1 << i for i, c in enumerate(shared)}  # no bit where no conflict is possible
    bins = Bins(capacity)
    for size, k, piece, source, cluster in sorted(rest, key=lambda r: (-r[0], r[1])):
        bin_ = bins.place(size, source_bit[source], cluster_bit.get(cluster, 0))
        out.append((k, piece, piece * capacity, size, whole_bins + bin_))
    return out


def _measured(docs: DataFrame, clusters: str | None) -> DataFrame:
    """(doc_id, source, tokens, copy, th, cluster): whitespace tokens, a hash that copies share, and one of the text;
    ``cluster`` is a hash of the caller's column, or else the copy."""

    def of_batch(texts: pa.Array) -> pa.Array:
        tokens, copies = [], []
        for x in texts.cast(pa.large_binary()):
            words = (x.as_py() or b"").lower().split()
            tokens.append(len(words))
            digest = xxhash.xxh64_intdigest(b" ".join(words))
            copies.append(digest - (1 << 64) if digest >> 63 else digest)
        return pa.StructArray.from_arrays(
            [pa.array(tokens, pa.int64()), pa.array(copies, pa.int64())], ["tokens", "copy"]
        )

    told = F.arrow_udf(of_batch, "tokens bigint, copy bigint")(F.col("text"))
    # Without a cluster of the caller's a row is alike with its copies only.
    given = F.lit(None).cast("bigint") if clusters is None else F.when(
        F.col(clusters).isNotNull(), F.xxhash64(F.col(clusters).cast("string"))
    )
    rows = docs.select(
        "doc_id", "source", told.alias("m"), F.xxhash64(whole("text")).alias("th"), given.alias("given")
    )
    return rows.select(
        "doc_id", "source", F.col("m.tokens").alias("tokens"), F.col("m.copy").alias("copy"), "th",
        F.coalesce("given", "m.copy").alias("cluster"),
    )


def pack(
    docs: DataFrame,
    capacity: int = SEQUENCE_TOKENS,
    shard_docs: int = SHARD_DOCS,
    in_mix: bool = False,
    clusters: str | None = None,
    near_copies: bool = True,
) -> DataFrame:
    """(doc_id, source, piece, first_token, n_tokens, shard, bin): where every token goes.

    No bin has two pieces of one source or two texts of one duplicate cluster. Clusters are the groups of
    ``simhash.near_groups``, those that the column ``clusters`` names, or without ``near_copies`` the copies of one text (blanks and
    case aside). Shards are dealt by hash, or with ``in_mix`` are runs of the mixed order of the sources, so that sequences follow
    it. A null text has no words and gives one empty piece; a null source is a source of its own. Repeated rows are
    copies of each other. An empty table gives an empty one.
    """
    slim = docs.select("doc_id", "source", "text", *([clusters] if clusters else []))
    rows = written(_measured(slim, clusters), "pack-items")
    if clusters is None and near_copies:
        groups = simhash.near_groups(docs).select("th", "root").distinct()
        rows = written(rows.join(groups, "th").withColumn("cluster", F.col("root")), "pack-clusters")
    rows = rows.select("doc_id", "source", "tokens", "copy", "cluster")
    if in_mix:
        placed = mixing.scheduled(rows, tie=F.col("copy"))
        shard: Column = F.floor(F.col("slot") / (shard_docs // mixing.BLOCK_DOCS))
    else:
        placed = rows
        count = max(1, -(-rows.count() // shard_docs))
        shard = F.pmod(F.xxhash64("doc_id", "copy"), F.lit(count))
    dealt = placed.select("doc_id", "source", "tokens", "copy", "cluster", shard.cast("bigint").alias("shard"))

    def of_shard(table: pa.Table) -> pa.Table:
        found = table.to_pydict()
        order = sorted(
            range(table.num_rows),
            key=lambda i: (found["doc_id"][i] is None, found["doc_id"][i] or 0, found["copy"][i], found["source"][i] or ""),
        )
        given = [(found["tokens"][i], found["source"][i], found["cluster"][i]) for i in order]
        packed = pack_shard(given, capacity)
        take = pa.array([order[p[0]] for p in packed], pa.int64())
        own = table.select(["doc_id", "source", "shard"]).take(take)
        values = [pa.array([p[j] for p in packed], pa.int64()) for j in (1, 2, 3, 4)]
        return pa.table(
            [own.column("doc_id"), own.column("source"), *values[:3], own.column("shard"), values[3]],
            names=["doc_id", "source", "piece", "first_token", "n_tokens", "shard", "bin"],
        )

    schema = (
        "doc_id bigint, source string, piece bigint, first_token bigint, n_tokens bigint,"
        " shard bigint, bin bigint"
    )
    ready = dealt.withColumns(
        {"doc_id": F.col("doc_id").cast("bigint"), "source": F.col("source").cast("string")}
    )
    return ready.groupBy("shard").applyInArrow(of_shard, schema)
