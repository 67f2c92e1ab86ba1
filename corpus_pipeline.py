"""The corpus pipeline: raw documents to the token ids of a cleaned, mixed training set."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feira.llm import bpe, mixing, near, quality, substrings
from feira.llm.queries import RANKS
from feira.llm.tables import table
from feira.sources.scratch import new_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule go."""
    return quality.filter_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one document stays."""
    return near.without_near_copies(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has too go; a document without other words goes."""
    trimmed = substrings.without_repeats(docs).filter("n_removed = 0 OR n_removed < n_words")
    return trimmed.select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.expanded(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text they stand for."""
    return bpe.encoded(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn on `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
