"""One query per corpus operator, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewarden.llm import (block_tree, chat_format, chosen_path, diagonal_votes, gated_toxicity, itq_dedup,
                             jacobi_whitening, merkle_manifest, merge_rounds, pareto_mix, quality_cascade, suffix_dedup, token_counts)
from tracewarden.llm.common import table

WORD_VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary(WORD_VOCABULARY))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cascade.quality_report(table(spark, sf_dir, "documents"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_documents(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_tree.extract_pages(table(spark, sf_dir, "pages"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto_mix.pareto_mix(table(spark, sf_dir, "documents"), columns=["doc_id"]).select(
        "row.doc_id", "size", "source_size", "target", "taken")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gated_toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagonal_votes.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_rounds.bpe_round_trip(table(spark, sf_dir, "documents"), vocabulary(WORD_VOCABULARY))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    return chat_format.conversation_digests(rows.withColumn("turn", F.col("turn").cast("long")).unionByName(extra), vocabulary(BYTE_VOCABULARY))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jacobi_whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_quality_rules, op3_embedding_near_dedup, op4_minhash_near_dedup, op5_html_extraction,
    op6_source_mix, op7_toxicity, op8_license_scan, op9_bpe_round_trip, op10_chat_format, op11_merkle_manifest,
    op12_embedding_whitening, op13_suffix_array_dedup)}
SQL: dict[str, str] = {"op11_merkle_manifest": merkle_manifest.manifest_sql()}
