"""Registered queries of the numbered operators: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.llm import (decontaminate, filteraudit, forest, licences, neardup, packing, quality, secrets, sharding, substring,
                          tokencount, tokenfiles, trie)
from tabspark.llm.common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 20-word windows that occur earlier, over all documents."""
    return substring.remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text."""
    return tokencount.token_counts(table(spark, sf_dir, "documents"))


def op3_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th one by inner product."""
    return forest.nearest(table(spark, sf_dir, "embeddings"))


def op4_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text, learnt from labels outside the held-out quarter."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near duplicates."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).drop("node")


def op6_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item, with its best window."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_id")


def op7_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 24 shards of near-equal bytes."""
    return sharding.shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: base patterns and Markov spans."""
    return secrets.scan(table(spark, sf_dir, "documents")).drop("found")


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every whole document and the notices in its lines."""
    return licences.licence_scan(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 1024 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum in the Arrow token files, read back from them."""
    return tokenfiles.token_files(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from all documents, per language, order and step."""
    return filteraudit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_token_counts, op3_prefix_forest, op4_quality_scores,
                            op5_minhash_near_dedup, op6_simhash_decontamination, op7_histogram_sort,
                            op8_secret_scan, op9_licence_scan, op10_best_fit_packing, op11_prefix_trie,
                            op12_token_files, op13_filter_audit)
}

SQL: dict[str, str] = {"op9_licence_scan": licences.SCAN_SQL, "op11_prefix_trie": trie.TRIE_SQL,
                       "op13_filter_audit": filteraudit.AUDIT_SQL}
