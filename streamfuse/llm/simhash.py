"""SimHash near-duplicate groups by fuzzy hashing with the Golay code.

A fingerprint of 64 bits is cut into three segments. Two fingerprints that differ in two bits at most
have, by the pigeonhole principle, a segment without a difference followed (in a circle) by
one with a single difference at most. The second is hashed so that one wrong bit does not matter: the (23, 12)
Golay code decodes any 23 bits to the nearest codeword, and a segment gets the codewords of itself
and of its neighbours at one bit, which are one or six. So each fingerprint has a few keys (exact segment,
codeword), fingerprints in reach share one, and what shares a key is compared.

Buckets with many fingerprints are not compared in pairs. Each of their fingerprints is sent to the 65
values at one bit or none; two fingerprints differ in two bits at most exactly if they meet
at such a value, and one value is met by 65 fingerprints at most.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamfuse.llm.common import neutral, original, whole, written

SHINGLE_WORDS = 3
SEED = 42
# (first bit, bits) of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# Fingerprints of one bucket that are compared in pairs; larger buckets go the other exact way.
PAIR_BUCKET = 48

# Fixed value: generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 of the Golay code.
GENERATOR = 0b101011100011


# Fingerprints


def _fingerprint(data: bytes, size: int, seed: int) -> int:
    words = data.lower().split()  # bytes: only A-Z and the six ASCII blanks are special
    n = len(words)
    if n == 0:
        return 0
    if n < size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[k:] for k in range(size)], strict=False))
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(s, seed) for s in shingles]), dtype=np.uint8)
    hashes = hashes.reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory, however long the text
        ones += np.unpackbits(hashes[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.uint32)
    bits = np.packbits(ones * 2 > len(hashes))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprint(text: Column, size: int = SHINGLE_WORDS, seed: int = SEED) -> Column:
    """The SimHash of a text as a signed 64-bit number; null and wordless texts have zero."""

    def of_batch(texts: pa.Array) -> pa.Array:
        values = [
            0 if data is None else _fingerprint(data, size, seed)
            for data in (x.as_py() for x in texts.cast(pa.large_binary()))
        ]
        return pa.array(values, pa.int64())

    return F.arrow_udf(of_batch, "bigint")(text)


def digits(value: Column) -> Column:
    """A 64-bit number as 16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")


# Keys


def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low and high bits of a word, and the error of least weight per syndrome."""

    def syndrome(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    low = np.array([syndrome(w) for w in range(1 << 12)], dtype=np.int32)
    high = np.array([syndrome(w << 12) for w in range(1 << 11)], dtype=np.int32)
    leader = np.zeros(1 << 11, dtype=np.int32)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            error = sum(1 << b for b in bits)
            leader[syndrome(error)] = error
    return low, high, leader


def nearest_codeword(words: np.ndarray, tables) -> np.ndarray:
    """The 12 message bits of the codeword within three bits of each 23-bit word."""
    low, high, leader = tables
    return (words ^ leader[low[words & 0xFFF] ^ high[words >> 12]]) >> 11


def golay_keys(values: np.ndarray, tables) -> tuple[np.ndarray, np.ndarray]:
    """(index of the fingerprint, key) for every key of every fingerprint, each once."""
    unsigned = values.astype(np.int64).view(np.uint64)
    parts = [
        ((unsigned >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int32)
        for at, bits in SEGMENTS
    ]
    owners, keys = [], []
    for i in range(3):
        exact, fuzzy = parts[i], parts[(i + 1) % 3]
        flips = np.array([0, *[1 << b for b in range(SEGMENTS[(i + 1) % 3][1])]], dtype=np.int32)
        near = np.sort(nearest_codeword(fuzzy[:, None] ^ flips[None, :], tables), axis=1)
        first = np.ones(near.shape, dtype=bool)
        first[:, 1:] = near[:, 1:] != near[:, :-1]
        row, col = np.nonzero(first)
        owners.append(row)
        keys.append((exact[row].astype(np.int64) << 14) | (near[row, col].astype(np.int64) << 2) | i)
    return np.concatenate(owners), np.concatenate(keys)


def with_keys(prints: DataFrame) -> DataFrame:
    """(fp, key): about sixteen rows for each fingerprint."""

    def of_partition(batches):
        tables = golay_tables()
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            if len(values) == 0:
                continue
            owner, key = golay_keys(values, tables)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[owner], pa.int64()), pa.array(key, pa.int64())], ["fp", "key"]
            )

    return prints.select("fp").mapInArrow(of_partition, "fp bigint, key bigint")


# Links and groups


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b), a < b, among the distinct fingerprints ``fp``: enough pairs at ``max_bits`` bits or fewer
    to connect everything that such pairs connect."""
    if max_bits != 2:
        raise ValueError("the keys are made for two differing bits")
    keys = with_keys(prints)
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    # Most keys have one fingerprint and go here.
    members = written(keys.join(shared, "key"), "simhash-members")
    few = members.filter(F.col("n") <= PAIR_BUCKET)
    left = few.select("key", F.col("fp").alias("a"))
    right = few.select("key", F.col("fp").alias("b"))
    pairs = left.join(right, "key").filter((F.col("a") < F.col("b")) & (_distance("a", "b") <= 2))

    dense = members.filter(F.col("n") > PAIR_BUCKET).select("fp").distinct()
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << b).cast("bigint") for b in range(63)],
                    F.lit(-(2**63)).cast("bigint"))
    near = dense.select("fp", F.explode(F.transform(flips, lambda f: f.bitwiseXOR(F.col("fp")))).alias("m"))
    # At most 65 fingerprints are within one bit of a value, and all of them are within two of another.
    met = near.groupBy("m").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    stars = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    found = pairs.select("a", "b").unionByName(stars.filter(F.col("a") < F.col("b")))
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(fp, root): the smallest fingerprint of the group, for every fingerprint that has a link.

    In each round every group takes the link of least hash that leaves it. These links make trees of two groups
    or more, whatever the order of the fingerprints, so the groups at least halve and the rounds are logarithmic.
    """
    edges = written(edges, "links")
    tops = None
    while not edges.isEmpty():
        up = _tops(edges)
        if tops is None:
            tops = up.select(F.col("a").alias("fp"), F.col("up").alias("top"))
        else:
            step = up.select(F.col("a").alias("top"), F.col("up").alias("next"))
            moved = tops.join(step, "top", "left")
            tops = written(moved.select("fp", F.coalesce("next", "top").alias("top")), "tops")
        lower = up.select("a", F.col("up").alias("x"))
        upper = up.select(F.col("a").alias("b"), F.col("up").alias("y"))
        left = edges.join(lower, "a").join(upper, "b").filter(F.col("x") != F.col("y"))
        left = left.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        edges = written(left.distinct(), "links")
    if tops is None:
        return edges.select(F.col("a").alias("fp"), F.col("b").alias("root"))
    least = tops.groupBy("top").agg(F.min("fp").alias("root"))
    return tops.join(least, "top").select("fp", "root")


def _tops(edges: DataFrame) -> DataFrame:
    """(a, up): for every end of a link the top of the tree that the chosen links make of it.

    All look to whom the one they look to looks to, until nobody's view changes; each look doubles the way.
    """
    link = F.struct(F.xxhash64("a", "b").alias("h"), "a", "b").alias("e")
    ends = edges.select("a", link).unionByName(edges.select(F.col("b").alias("a"), link))
    chosen = ends.groupBy("a").agg(F.min("e").alias("e"))
    other = F.when(F.col("e.a") == F.col("a"), F.col("e.b")).otherwise(F.col("e.a"))
    up = written(chosen.select("a", other.alias("up")), "tops")
    # The least link of a tree is chosen by both its ends; the smaller one is the top.
    top = (F.col("up2") == F.col("a")) & (F.col("a") < F.col("up"))
    up = written(_above(up).select("a", F.when(top, F.col("a")).otherwise(F.col("up")).alias("up")), "tops")
    while True:
        looked = _above(up).select("a", F.col("up2").alias("up"), (F.col("up") != F.col("up2")).alias("moved"))
        looked = written(looked, "tops")
        up = looked.select("a", "up")
        if looked.filter("moved").isEmpty():
            return up


def _above(up: DataFrame) -> DataFrame:
    """(up, a, up2): with whom the one that ``a`` looks to looks to."""
    return up.join(up.select(F.col("a").alias("up"), F.col("up").alias("up2")), "up")


def near_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, th, fp, root, component_id): the SimHash of every text and its group.

    Texts whose fingerprints differ in two bits at most are linked, and groups are what links
    connect. ``root`` is the group's smallest fingerprint, ``component_id`` its smallest doc_id, ``th`` tells rows
    with the same doc_id apart. Null, empty and wordless texts all have fingerprint zero and so are
    one group. Rows that share a doc_id are each judged by their own text; a null doc_id names a group
    only if the whole group has none. An empty table gives an empty one.
    """
    judged = docs.select(
        "doc_id", F.xxhash64(whole("text")).alias("th"), fingerprint(F.col("text")).alias("fp")
    )
    judged = written(judged, "simhash")
    prints = judged.groupBy("fp").agg(F.min("doc_id").alias("first"))
    prints = written(prints, "simhash-distinct")
    rooted = prints.join(components(links(prints)), "fp")
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    linked = rooted.join(least, "root").select("fp", "root", "least")
    named = prints.join(linked, "fp", "left").select(
        "fp",
        F.coalesce("root", "fp").alias("root"),
        F.coalesce("least", "first").alias("component_id"),
    )
    # The rows of a frequent fingerprint are on the other side; the engine splits a skewed join.
    return judged.join(written(named, "simhash-groups"), "fp").select(
        "doc_id", "th", "fp", "root", "component_id"
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    return near_groups(docs).select(
        "doc_id", digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """One document of each group, the one with the smallest doc_id, with all columns.

    ``groups`` has (doc_id, th, root) for every row, by default those of ``near_groups``.

    Where several rows have that doc_id, the one whose text has the least hash; a row without a doc_id only
    from groups that have none. Rows equal in doc_id and text are kept once.
    """
    first = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "th")
    groups = near_groups(docs) if groups is None else groups
    heads = groups.groupBy("root").agg(F.min(first).alias("h"))
    heads = heads.select(F.col("h.doc_id").alias("_id"), F.col("h.th").alias("_head"))
    marked = neutral(docs, ["doc_id", "text"]).withColumn("_th", F.xxhash64(whole("text")))
    here = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_head"))
    kept = marked.join(heads, here, "left_semi")
    return kept.dropDuplicates(["doc_id", "_th"]).select(*original(docs))
