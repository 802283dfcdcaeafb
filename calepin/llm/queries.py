"""The operators over their whole tables, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from calepin.llm import (
    collocations,
    graph_search,
    language_id,
    licenses,
    lm_scoring,
    merkle,
    ngram_join,
    packing,
    quality_classifier,
    quality_rules,
    secrets,
    sentencepiece_codec,
    sharding,
)
from calepin.llm.common import table
from calepin.llm.oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents"))


def op2_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents")).selectExpr(
        "row.doc_id as doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op4_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.neighbours(table(spark, sf_dir, "embeddings"))


def op5_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(table(spark, sf_dir, "documents"))


def op6_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.codec_digests(
        table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model")
    )


def op8_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards_of(table(spark, sf_dir, "documents"))


def op9_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(table(spark, sf_dir, "documents"))


def op10_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op11_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mined(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_partenum_join,
        op2_ppm_scoring,
        op3_quality_rules,
        op4_pruned_graph,
        op5_ppm_language,
        op6_additive_quality,
        op7_sentencepiece,
        op8_sampled_splitters,
        op9_secret_novelty,
        op10_sum_of_squares,
        op11_license_index,
        op12_merkle_manifest,
        op13_collocations,
    )
}

__all__ = ["ORACLES", "QUERIES", "tokenizer_path"]
