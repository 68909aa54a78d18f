"""The operators of this package as queries over whole tables: (session, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import (
    decontaminate, language, mixing, near_dedup, quality_gam, quality_rules, resharding, spelling, token_counts, token_files, url_trust, vector_graph,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


@query
def op1_quality_rules(spark, sf_dir):
    return quality_rules.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_mix_sources(spark, sf_dir):
    return mixing.digest(table(spark, sf_dir, "documents"))


@query
def op4_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op10_token_files(spark, sf_dir):
    return token_files.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_reshard(spark, sf_dir):
    return resharding.digest(table(spark, sf_dir, "documents"))


@query
def op2_quality_gam(spark, sf_dir):
    return quality_gam.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_url_trust(spark, sf_dir):
    return url_trust.judged(table(spark, sf_dir, "pages"))


@query
def op9_language(spark, sf_dir):
    return language.identified(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


@query
def op11_spelling(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


@query
def op12_nearest(spark, sf_dir):
    return vector_graph.nearest(table(spark, sf_dir, "embeddings"))


@query
def op13_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))
