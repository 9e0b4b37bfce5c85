"""The registered queries of this package, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streamfuse.llm import (
    fingerprints,
    html,
    language,
    licenses,
    lines,
    mixing,
    packing,
    quality,
    repair,
    secrets,
    simhash,
    topk,
    trie,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {
    "op1_license_scan": licenses.oracle_sql(),
    "op5_secret_scan": secrets.oracle_sql(),
    "op8_line_dedup": lines.ORACLE,
    "op9_exact_top_k": topk.ORACLE,
    "op11_prefix_trie": trie.oracle_sql(),
    "op12_conversation_repair": repair.oracle_sql(),
}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_license_scan(spark, sf_dir):
    return licenses.scan_licenses(documents(spark, sf_dir))


@query
def op2_minhash_fingerprints(spark, sf_dir):
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


@query
def op3_source_mixing(spark, sf_dir):
    return mixing.mix_schedule(documents(spark, sf_dir))


@query
def op4_language_id(spark, sf_dir):
    return language.identify(documents(spark, sf_dir))


@query
def op5_secret_scan(spark, sf_dir):
    return secrets.scan_secrets(documents(spark, sf_dir))


@query
def op6_best_fit_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir))


@query
def op7_quality_score(spark, sf_dir):
    return quality.score_quality(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    )


@query
def op8_line_dedup(spark, sf_dir):
    return lines.line_digest(documents(spark, sf_dir))


@query
def op9_exact_top_k(spark, sf_dir):
    return topk.every_twentieth(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op10_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


@query
def op11_prefix_trie(spark, sf_dir):
    return trie.rebuilt_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op12_conversation_repair(spark, sf_dir):
    return repair.damaged_and_repaired(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op13_html_text(spark, sf_dir):
    return html.page_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
