"""Exact top-k search by accumulation term at a time.

Vectors become sparse rows of whole numbers: component d with a weight other than zero is term d. A block of
candidates is an inverted index: for each term the candidates that have it, with their weights.
A block of queries goes through its terms one by one and adds weight times weight to dense score arrays at the
places of the postings. Each block gives its best k by partition selection, and these few are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamfuse.llm.common import written

K = 20
SCALE = 64
# Rows of a block of candidates and of queries, and queries whose score arrays a task holds at a time.
CANDIDATE_BLOCK = 4_096
QUERY_BLOCK = 4_096
QUERY_TILE = 128
# Doubles from here on are whole numbers.
WHOLE = 2.0**53


def whole_numbers(embedding: Column) -> Column:
    """floor(64 * x) of each component, as doubles."""

    def scaled(x: Column) -> Column:
        wide = x.cast("double") * SCALE
        return F.when(F.abs(wide) < WHOLE, F.floor(wide).cast("double")).otherwise(wide)

    return F.transform(embedding, scaled)


def valid(embedding: Column) -> Column:
    """Not null, no component null, NaN or infinite."""
    finite = F.forall(
        embedding, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x)
    )
    return F.coalesce(embedding.isNotNull() & finite, F.lit(False))


def narrowest(q: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, type]:
    """The weights in the smallest kind of number that holds all scores exactly; Python's own if 64 bits may not do."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, c.shape[1])
    if bound < 2.0**62:
        kind = np.int32 if bound < 2**30 else np.int64
        return q.astype(kind), c.astype(kind), kind

    def exact(weights: np.ndarray) -> np.ndarray:
        made = np.empty(weights.shape, dtype=object)
        for at, w in np.ndenumerate(weights):
            made[at] = int(w)
        return made

    return exact(q), exact(c), object


def top_of_block(
    q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, candidate id, score) of the best k of one block, ties to smaller ids.

    ``q`` and ``c`` are (rows, terms). A candidate with the query's own id takes no part.
    """
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    q, c, kind = narrowest(q, c)
    least = -(1 << 4096) if kind is object else np.iinfo(kind).min
    # Postings: for each term the candidates with a weight, and the weights.
    index = []
    for d in range(c.shape[1]):
        at = np.flatnonzero(c[:, d])
        everywhere = len(at) == len(c)
        index.append((slice(None) if everywhere else at, np.ascontiguousarray(c[at, d])))
    out_q, out_c, out_s = [], [], []
    for first in range(0, len(q), QUERY_TILE):
        tile = q[first : first + QUERY_TILE]
        scores = np.zeros((len(tile), len(c)), dtype=kind)
        for r in range(len(tile)):
            row = scores[r]
            for d in np.flatnonzero(tile[r]):
                at, weights = index[d]
                row[at] += tile[r, d] * weights
        own = np.searchsorted(c_ids, q_ids[first : first + QUERY_TILE], side="left")
        upto = np.searchsorted(c_ids, q_ids[first : first + QUERY_TILE], side="right")
        for r in range(len(tile)):
            row = scores[r]
            row[own[r] : upto[r]] = least
            take = min(k, len(row) - int(upto[r] - own[r]))
            if take <= 0:
                continue
            # All above the k-th score, then those equal to it in order of their ids.
            cut = row[np.argpartition(row, len(row) - take)[len(row) - take]]
            above = np.flatnonzero(row > cut)
            level = np.flatnonzero(row == cut)[: take - len(above)]
            best = np.concatenate([above, level])
            out_q.append(np.full(len(best), first + r))
            out_c.append(c_ids[best])
            if kind is object and any(abs(x) >= 1 << 63 for x in row[best]):
                raise OverflowError("a score does not fit into 64 bits")
            out_s.append(row[best].astype(np.int64))
    if not out_q:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(out_q), np.concatenate(out_c), np.concatenate(out_s)


def _blocks(rows: DataFrame, size: int, names: tuple[str, str, str], salt: int) -> tuple[DataFrame, int]:
    """Rows dealt by hash into blocks of about ``size``, each packed into one row."""
    block, ids, vectors = names
    n = max(1, -(-rows.count() // size))
    dealt = rows.withColumn(block, F.pmod(F.xxhash64("vec_id", "copy", F.lit(salt)), F.lit(n)))
    packed = dealt.groupBy(block).agg(F.collect_list(F.struct("vec_id", "copy", "v")).alias("r"))
    return packed.select(
        block, F.col("r.vec_id").alias(ids), F.col("r.copy").alias(f"{ids}_copy"), F.col("r.v").alias(vectors)
    ), n


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the best k candidates of every query, exactly.

    ``vectors`` has vec_id and embedding. Every row but those with the query's own vec_id is a candidate; fewer
    than k candidates are all returned. Rows without a vec_id, and vectors that are null or have null,
    NaN or infinite components, take no part; all others do, with sums as wide as they need. One of the best scores that
    does not fit into a long is an error. Missing components at the end of a shorter vector count
    as zero. Repeated rows each are candidates; repeated queries are told apart by their vectors, and
    equal ones give one result. An empty table gives an empty one.
    """
    usable = vectors.filter(valid(F.col("embedding")) & F.col("vec_id").isNotNull())
    v = usable.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").alias("v"),
        F.xxhash64(whole_numbers(F.col("embedding"))).alias("copy"),
        is_query.alias("q"),
    )
    rows = written(v, "vectors")
    queries = rows.filter("q").dropDuplicates(["vec_id", "copy"])
    candidates, _ = _blocks(rows, CANDIDATE_BLOCK, ("c_block", "c_ids", "c"), 1)
    asked, n = _blocks(queries, QUERY_BLOCK, ("q_block", "q_ids", "q"), 2)
    # Every block of queries meets every block of candidates: one packed row each.
    sent = candidates.withColumn(
        "q_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    )
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = sent.join(asked, "q_block").repartition(parts, "c_block", "q_block")

    def matrix(values) -> np.ndarray:
        lists = values.values if isinstance(values, pa.ListScalar) else values
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        sizes = np.diff(lists.offsets.to_numpy())
        wide = np.zeros((len(sizes), int(sizes.max(initial=0))))
        wide[np.arange(wide.shape[1])[None, :] < sizes[:, None]] = np.floor(flat.astype(np.float64) * SCALE)
        return wide

    def of_partition(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(batch.schema.get_field_index(n))[i] for n in batch.schema.names}
                c, q = matrix(row["c"]), matrix(row["q"])
                wide = max(c.shape[1], q.shape[1])
                c = np.pad(c, ((0, 0), (0, wide - c.shape[1])))
                q = np.pad(q, ((0, 0), (0, wide - q.shape[1])))
                q_ids = row["q_ids"].values.to_numpy(zero_copy_only=False)
                copies = row["q_ids_copy"].values.to_numpy(zero_copy_only=False)
                c_ids = row["c_ids"].values.to_numpy(zero_copy_only=False)
                at, ids, scores = top_of_block(q_ids, q, c_ids, c, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (q_ids[at], copies[at], ids, scores)],
                    ["query_id", "copy", "vec_id", "score"],
                )

    found = pairs.select("q_ids", "q_ids_copy", "q", "c_ids", "c").mapInArrow(
        of_partition, "query_id bigint, copy bigint, vec_id bigint, score bigint"
    )
    place = Window.partitionBy("query_id", "copy").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def every_twentieth(vectors: DataFrame) -> DataFrame:
    """The stated query set: rows whose vec_id is divisible by 20."""
    asks = F.coalesce(F.col("vec_id") % 20 == 0, F.lit(False))
    return top_k(vectors.select("vec_id", "embedding"), asks)


ORACLE = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""
