"""Stages from raw documents to packed training sequences.

Each stage takes all that its predecessor kept. The first three drop documents,
the fourth masks what it finds, the last returns pieces and their places. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calepin.llm import ngram_join, packing, quality_classifier, quality_rules, secrets
from calepin.llm.common import shared_folder, ship, table
from calepin.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality_rules.keep_good(docs)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learned from the labels of those left, accepts."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near duplicates."""
    ship(spark)
    return ngram_join.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and ``n_chars`` counted anew."""
    ship(spark)
    clean = docs.withColumn("text", secrets.without_secrets(F.col("text")))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in training sequences."""
    ship(spark)
    return packing.packed(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", rules_stage),
    ("quality classifier", classifier_stage),
    ("n-gram Jaccard join", duplicates_stage),
    ("secret scans", secrets_stage),
    ("best-fit packing", packing_stage),
]

# A trained classifier, compression and a tokenizer take part: no SQL says the same.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each from the files of the one before."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark)
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
