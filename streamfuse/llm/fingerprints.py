"""One-permutation MinHash fingerprints, in DataFrame functions only.

Every shingle of five words is hashed once. The top bits of a hash choose its bin and the bin keeps
its smallest hash. A bin that got no hash borrows from a bin that has one: each empty bin probes the
others in a random order of its own, the same for every text, and takes the first that is filled
(optimal densification). Only the low bits of each bin are kept, so two unrelated bins agree by
chance once in 2^bits; the estimate takes that out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamfuse.llm.common import whole

SHINGLE_WORDS = 5
BINS = 256
BITS = 8
# Fixed probes tried before the rest of an empty bin's probing order is worked out.
PROBES = 6
BLOCK_ROWS = 500
MAX_BLOCKS = 20_000


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """One hash for each run of ``words`` words of the lower-cased text.

    Words are separated by spaces, tabs and line ends. A text with fewer words is one shingle, and
    a text without words is the empty shingle.
    """
    blanks = " \t\n\v\f\r"
    inner = F.btrim(F.lower(text), F.lit(blanks))
    tokens = F.split(inner, f"[{blanks}]+")

    def runs(h: Column) -> Column:
        # Words are hashed once each; a run is the hash of its words' hashes.
        starts = F.slice(h, 1, F.greatest(F.size(h) - (words - 1), F.lit(0)))
        each = F.transform(
            starts, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, words)])
        )
        return F.when(F.size(h) < words, F.array(F.xxhash64(h))).otherwise(each)

    none = F.array().cast("array<bigint>")
    hashed = F.transform(tokens, lambda w: F.xxhash64(w))
    return bound(F.when(inner == "", none).otherwise(hashed), runs)


def bin_minima(hashes: Column, bins: int = BINS) -> Column:
    """The smallest hash of each bin, null where a bin has none; one entry for each bin.

    The bin is the top bits of the signed hash, so sorted hashes stand in order of their bins.
    """
    shift = 64 - (bins.bit_length() - 1)

    def bin_of(h: Column) -> Column:
        return F.shiftright(h, shift).cast("int") + bins // 2

    def empty(count: Column) -> Column:
        return F.array_repeat(F.lit(None).cast("bigint"), count)

    def firsts(s: Column) -> Column:
        return F.filter(
            s, lambda h, i: (i == 0) | (F.shiftright(h, shift) != F.shiftright(F.get(s, i - 1), shift))
        )

    def spread(f: Column) -> Column:
        def with_gap(h: Column, i: Column) -> Column:
            before = F.when(i == 0, F.lit(-1)).otherwise(bin_of(F.get(f, i - 1)))
            return F.concat(empty(bin_of(h) - before - 1), F.array(h))

        gaps = F.flatten(F.transform(f, with_gap))
        tail = empty(bins - 1 - bin_of(F.element_at(f, -1)))
        return F.when(F.size(f) == bins, f).otherwise(F.concat(gaps, tail))

    return bound(bound(F.sort_array(hashes), firsts), spread)


def densified(minima: Column, bins: int = BINS) -> Column:
    """Fill every empty bin from the first filled one in its own random order of the bins."""

    def fill(m: Column) -> Column:
        def rank(i: Column, j: Column) -> Column:
            return F.xxhash64(i, j, F.lit(7))

        def first_filled(i: Column) -> Column:
            tried = [
                F.get(m, F.pmod(F.xxhash64(i, F.lit(p)), F.lit(bins)).cast("int"))
                for p in range(PROBES)
            ]
            # What the fixed probes miss: the filled bin of least rank.
            filled = F.filter(
                F.transform(m, lambda h, j: F.when(h.isNotNull(), F.struct(rank(i, j).alias("r"), h.alias("h")))),
                lambda s: s.isNotNull(),
            )
            return F.coalesce(*tried, F.array_min(filled)["h"])

        return F.transform(m, lambda h, i: F.when(h.isNotNull(), h).otherwise(first_filled(i)))

    return bound(minima, fill)


def low_bits(values: Column, bits: int = BITS) -> Column:
    return F.transform(values, lambda h: h.bitwiseAND(F.lit((1 << bits) - 1)).cast("smallint"))


def packed(low: Column, bits: int = BITS) -> Column:
    """The bins in order as hexadecimal digits."""
    width = (bits + 3) // 4
    return F.array_join(F.transform(low, lambda v: F.lpad(F.lower(F.hex(v)), width, "0")), "")


def fingerprint_bins(text: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """The low bits of every bin of a text's fingerprint. Equal texts have equal bins."""
    if bins & (bins - 1) or not 2 <= bins <= 4096 or not 1 <= bits <= 16:
        raise ValueError("bins is a power of two up to 4096, bits is 1 to 16")
    return low_bits(densified(bin_minima(shingle_hashes(text), bins), bins), bits)


def likeness(a: Column, b: Column, bits: int = BITS) -> Column:
    """Estimated Jaccard similarity of two fingerprints: agreement without the chance agreement."""
    same = F.aggregate(
        F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x
    )
    chance = 1.0 / (1 << bits)
    return F.greatest(F.lit(0.0), (same / F.size(a) - chance) / (1 - chance))


def with_next(
    docs: DataFrame,
    here: dict[str, Column],
    after: dict[str, str],
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Add values of the next row in descending order of the key; after the last row comes the first.

    ``here`` are columns worked out for each row, ``after`` gives names to those of the next row. Rows are dealt into blocks of consecutive keys, cut at
    quantiles, and each block also gets a copy of the row that opens the following block. So every
    text shuffles once, before anything is worked out, and no block waits for another. Rows with the same key follow each other in
    order of their text's hash; a null key counts as the smallest.
    """
    least = -(2**63)
    keys = docs.select(F.coalesce(F.col(key).cast("bigint"), F.lit(least)).alias("_k"))
    blocks = min(max(keys.count() // BLOCK_ROWS, 1), MAX_BLOCKS)
    cuts: list[int] = []
    if blocks > 1:
        shares = [i / blocks for i in range(1, blocks)]
        found = keys.agg(F.percentile_approx("_k", shares, 20 * blocks).alias("c")).first()
        cuts = sorted(set(found.c), reverse=True)
    # The block is the number of cuts above the key, so block 0 has the largest keys.
    keys = _with_block(keys, cuts)
    # The largest key of every block: one row a block, MAX_BLOCKS at most.
    heads = sorted((r["_b"], r["k"]) for r in keys.groupBy("_b").agg(F.max("_k").alias("k")).collect())
    follows = [(k, heads[i - 1][0]) for i, (_, k) in enumerate(heads)]
    opens = docs.sparkSession.createDataFrame(follows, "_k bigint, _to int")

    keyed = docs.withColumn("_k", F.coalesce(F.col(key).cast("bigint"), F.lit(least)))
    copies = keyed.join(F.broadcast(opens), "_k").withColumnRenamed("_to", "_b")
    rows = _with_block(keyed, cuts).withColumn("_copy", F.lit(0))
    rows = rows.unionByName(copies.withColumn("_copy", F.lit(1)))
    # Dealt out first, worked out then: the window needs no other placement.
    rows = rows.repartition("_b").withColumns({**here, "_th": F.xxhash64(whole(text), F.lit(1))})
    place = Window.partitionBy("_b").orderBy("_copy", F.desc("_k"), "_th")
    led = {new: F.lead(old).over(place) for new, old in after.items()}
    return rows.withColumns(led).filter(F.col("_copy") == 0).select(*docs.columns, *here, *after)


def _with_block(df: DataFrame, cuts: list[int]) -> DataFrame:
    """Binary search for the number of cuts above the key, one column for each step."""
    at = F.lit(0)
    if cuts:
        table = F.array(*[F.lit(c).cast("bigint") for c in cuts])
        for step in (1 << b for b in reversed(range(len(cuts).bit_length()))):
            df = df.withColumn("_b", at)
            above = F.get(table, F.col("_b") + step - 1) > F.col("_k")
            at = F.when(above, F.col("_b") + step).otherwise(F.col("_b"))
    return df.withColumn("_b", at)


def edited_fingerprints(docs: DataFrame, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how alike they are.

    The edited text has the last third of the code points replaced by the first as many of the next
    document. A null text is empty. An empty table gives an empty result; in a table of one row the
    next document is the row itself. Repeated rows are kept, each with a result of its own, and
    columns beyond ``doc_id`` and ``text`` are not looked at.
    """
    base = docs.select("doc_id", whole("text").alias("text"))
    own = fingerprint_bins(F.col("text"), bins, bits)
    near = with_next(base, {"_own": own}, {"_next_text": "text", "_next": "_own"})
    edited = F.expr(
        "concat(substring(text, 1, char_length(text) - cast(floor(char_length(text) / 3) AS int)),"
        " substring(_next_text, 1, cast(floor(char_length(text) / 3) AS int)))"
    )
    made = near.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), "_own", "_next", edited.alias("_text")
    ).select(
        "doc_id",
        "n_chars",
        F.sha2("_text", 256).alias("edited_sha256"),
        "_own",
        fingerprint_bins(F.col("_text"), bins, bits).alias("_edited"),
        "_next",
    )
    return made.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        packed(F.col("_own"), bits).alias("fingerprint"),
        packed(F.col("_edited"), bits).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_edited"), bits).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next"), bits).alias("near_next"),
    )
