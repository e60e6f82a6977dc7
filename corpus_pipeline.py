"""The corpus pipeline: raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame, which is written as Parquet and read
again as the documents of the next one. The tests compare the rows with a brute-force version, since
SQL can express neither the estimation of the rules nor the tokenizer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.mixing import training_order
from touchline.llm.ngram_join import deduplicated
from touchline.llm.packing import pack
from touchline.llm.pii import redacted
from touchline.llm.quality_rules import filtered
from touchline.llm.words import read, shipped, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rules reject go."""
    return filtered(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    shipped(spark)
    return deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the texts; every document stays, and ``n_chars`` counts the new text."""
    masked = redacted(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture uses them, in training order."""
    return training_order(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents at their places in training sequences."""
    shipped(spark)
    return pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("ngram join", ngram_join),
    ("personal data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each one's result written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
