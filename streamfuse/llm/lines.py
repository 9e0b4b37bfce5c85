"""Removal of lines that many documents share, in DataFrame functions only.

Line hashes are kept as levelled sorted runs, like the files of a log-structured merge tree. Each
batch of documents is anti-joined with the runs: keys that no run holds are first sightings and
become a new run, the others go to a log of repeats. When a level has ``fanout`` runs they are merged into
one run of the next level. A key stands in one run only, so the runs together hold each key once, and
all decisions need is the repeats and the runs' rows for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamfuse.llm.common import ascii_lower, neutral, original, whole, written

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 2
_BLANKS = " \t\n\v\f\r"
_KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in small letters."""
    return ascii_lower(F.btrim(line, F.lit(_BLANKS)))


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, th, pos, h1, h2) for every line whose key is long enough; no text leaves the task.

    ``th`` tells rows with the same doc_id apart. 96 bits of hash make an accidental match of
    different lines negligible up to 10^12 lines.
    """
    rows = docs.select(
        doc_number().alias("doc"),
        F.xxhash64(whole("text")).alias("th"),
        F.posexplode(F.split(whole("text"), "\n")).alias("pos", "line"),
    )
    keyed = rows.withColumn("key", line_key(F.col("line")))
    long = keyed.filter(F.char_length("key") >= min_chars)
    return long.select("doc", "th", "pos", F.xxhash64("key").alias("h1"), F.hash("key").alias("h2"))


def doc_number() -> Column:
    """The doc_id; a missing one counts as one document, smaller than all others."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63)))


class LineRuns:
    """Levelled runs of (h1, h2, n_docs, last_doc), each a sorted table in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("fanout must be 2 at least")
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []
        self.repeats: list[DataFrame] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> None:
        """Take in the lines of new documents; a document must not come in two batches."""
        # The distinct count spreads a frequent line by document before its counts meet.
        counts = lines.groupBy(*_KEY).agg(
            F.count_distinct("doc").alias("n_docs"), F.max("doc").alias("last_doc")
        )
        held = self.runs()
        if not held:
            return self._put(self._sorted(counts), 0)
        batch = written(counts, "line-batch")
        fresh = batch
        for run in held:
            fresh = fresh.join(run.select(*_KEY), _KEY, "left_anti")
        fresh = self._sorted(fresh)
        self.repeats.append(batch.join(fresh.select(*_KEY), _KEY, "left_anti"))
        return self._put(fresh, 0)

    def _sorted(self, counts: DataFrame) -> DataFrame:
        return written(counts.sortWithinPartitions(*_KEY), "line-run")

    def _put(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self.levels[level][0]
            for other in self.levels[level][1:]:
                merged = merged.unionByName(other)
            self.levels[level] = []
            parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            self._put(self._sorted(merged.repartition(parts, *_KEY)), level + 1)

    def shared(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """(h1, h2, last_doc) of the keys that ``min_docs`` documents hold."""
        held = self.runs()
        if not held:
            raise ValueError("no batch was added")
        firsts = held[0]
        for run in held[1:]:
            firsts = firsts.unionByName(run)
        if not self.repeats:
            return firsts.filter(F.col("n_docs") >= min_docs).select(*_KEY, "last_doc")
        again = self.repeats[0]
        for more in self.repeats[1:]:
            again = again.unionByName(more)
        total = again.groupBy(*_KEY).agg(
            F.sum("n_docs").alias("more_docs"), F.max("last_doc").alias("more_last")
        )
        both = firsts.join(total, _KEY, "left")
        n = F.col("n_docs") + F.coalesce("more_docs", F.lit(0))
        last = F.greatest("last_doc", "more_last")  # ignores null
        return both.filter(n >= min_docs).select(*_KEY, last.alias("last_doc"))


def dropped_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """(doc, th, dropped): the sorted numbers of the lines each row loses, for rows that lose any."""
    place = F.pmod(F.xxhash64("doc"), F.lit(batches))
    lines = written(line_hashes(docs, min_chars).withColumn("batch", place), "lines")
    runs = LineRuns(docs.sparkSession, fanout)
    for i in range(batches):
        runs.add(lines.filter(F.col("batch") == i))
    shared = written(runs.shared(min_docs), "shared-lines")
    lost = lines.join(shared, _KEY).filter(F.col("doc") != F.col("last_doc"))
    return lost.groupBy("doc", "th").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))


def _mask(dropped: Column) -> Column:
    """One entry for each line up to the last dropped one: whether it goes."""

    def upto(p: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(F.get(dropped, i - 1))
        return F.concat(F.array_repeat(F.lit(False), p - before - 1), F.array(F.lit(True)))

    return F.flatten(F.transform(dropped, upto))


def dedup_lines(docs: DataFrame, counts: bool = True, **options) -> DataFrame:
    """Replace ``text`` by its kept lines and, with ``counts``, add ``n_lines`` and ``n_dropped``.

    A line goes if its key has at least 20 code points, at least 3 documents hold it, and this
    document isn't the one of them with the largest doc_id. All lines of a key stay in that one, even
    repeats. A null or empty text is one empty line and is returned as it is; an empty table gives
    an empty one. Rows that share a doc_id are one document, each with a text of its own.
    """
    lost = dropped_lines(docs.select("doc_id", "text"), **options)
    lost = lost.select(F.col("doc").alias("_doc"), F.col("th").alias("_th"), "dropped")
    here = (doc_number() == F.col("_doc")) & (F.xxhash64(whole("text")) == F.col("_th"))
    marked = neutral(docs, ["doc_id", "text"]).join(lost, here, "left")
    marked = marked.withColumn("_mask", _mask(F.col("dropped")))
    lines = F.split(whole("text"), "\n")

    def stays(_, i: Column) -> Column:
        return ~F.coalesce(F.get(F.col("_mask"), i), F.lit(False))

    kept = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(
        F.array_join(F.filter(lines, stays), "\n")
    )
    told = [
        F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
    ]
    return marked.select(*original(docs, text=kept), *(told if counts else []))


def line_digest(docs: DataFrame) -> DataFrame:
    made = dedup_lines(docs.select("doc_id", "text"))
    return made.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(whole("text"), 256).alias("kept_sha256")
    )


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
lines AS (
  SELECT r, doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS pos
  FROM d),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.last AS lost FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id"""
