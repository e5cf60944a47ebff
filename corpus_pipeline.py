"""From raw documents to packed training sequences, stage by stage.

Each stage takes all documents that the one before kept, with the columns of
``documents``, and returns them with its decisions applied; the last returns the
pieces of token sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fareweather.llm import decontamination, language, ngram_join, packing, pii, store
from fareweather.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is clear; those that are rejected go."""
    store.ship(spark)
    model = language.fit(docs)
    verdict = language.predictor(spark, model)
    return docs.where(~verdict(F.col("text"))["rejected"])


def one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies."""
    store.ship(spark)
    return ngram_join.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    store.ship(spark)
    return decontamination.clean(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets."""
    return pii.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token sequences of at most 2048 ids."""
    store.ship(spark)
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("ngram-join", one_of_each),
    ("decontamination", decontaminated),
    ("pii", redacted),
    ("packing", packed),
]

#: Tokenizing and models are beyond SQL; see tests/llm for the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        docs = store.written(stage(spark, docs, folder), f"pipeline-{name}")
    return docs
