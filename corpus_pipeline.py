"""From raw documents to token files, in stages that each take what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import decontaminate, mixing, near_dedup, quality_rules, token_files
from tidemill.llm.store import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

VOCABULARY = "word_bpe_49k.json"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned rules reject."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the least doc_id; copies share 80 percent."""
    return near_dedup.keep_one(docs, near_dedup.Settings(percent=80))


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: never, once or twice."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place and checksum of each document in the token files, read back from them."""
    return token_files.digest(docs, public_tokenizers.path(VOCABULARY))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", good_documents),
    ("near_dedup", distinct_documents),
    ("decontaminate", clean_documents),
    ("mix_sources", mixed_documents),
    ("token_files", token_output),
]

# Rules are learned and token ids come from a vocabulary file: SQL states neither. The
# stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
