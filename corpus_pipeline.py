"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes to the shared folder and reads
back for the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamfuse.llm import language, lines, mixing, packing, simhash
from streamfuse.llm.common import written


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that the labels teach go; all others stay as they are."""
    return language.keep_identified(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents share stay in one of them; lengths follow the texts."""
    kept = lines.dedup_lines(docs, counts=False)
    length = F.char_length("text").cast("bigint")
    return kept.select(*[length.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group whose SimHash fingerprints (three words) differ in two bits or fewer."""
    return simhash.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, sorted so that every stretch has the sources at their target weights."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences, packed from runs of the mixed order."""
    # The near-duplicate stage has left one text of each group, so only copies are looked for.
    return packing.pack(docs, in_mix=True, near_copies=False)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

# The first and third stage learn and hash in ways that SQL does not express; tests hold every stage
# against a brute-force version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
