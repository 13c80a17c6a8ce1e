"""The corpus pipeline: rules, toxicity, near-duplicates, mix, encoding."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tracewarden.llm import chosen_path, gated_toxicity, merge_rounds, pareto_mix, quality_cascade
from tracewarden.llm.common import table
from tracewarden.llm.queries import WORD_VOCABULARY, vocabulary
from tracewarden.session import ensure_checkpoint_dir

# similarity of word shingles that counts as near in the pipeline (op4 has its own)
NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_cascade.quality_filter(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return gated_toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chosen_path.distinct_documents(docs, NEAR_PERCENT)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pareto_mix.mixed_documents(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return merge_rounds.bpe_round_trip(docs, vocabulary(WORD_VOCABULARY))


STAGES = [("quality_rules", quality_stage), ("toxicity", toxicity_stage), ("minhash_near_dedup", dedup_stage),
          ("source_mix", mix_stage), ("bpe_round_trip", encode_stage)]
# learnt scores and tree searches have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each is written below the checkpoint folder and read again."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
