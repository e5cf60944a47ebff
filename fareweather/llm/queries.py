"""The operators of this folder over the driver's tables, with the digests asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fareweather.llm import (
    decontamination, embeddings, language, language_model, ngram_join, packing, pii, quality,
    ranked_search, store, substring_dedup, suffix_dedup, toxicity, vector_codes,
)
from fareweather.llm.sql import SQL


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    store.ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = suffix_dedup.deduplicate(_table(spark, folder, "documents"), digest=True)
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept").cast("string").alias("kept_sha256"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = substring_dedup.deduplicate(_table(spark, folder, "documents"), digest=True)
    return done.select("doc_id", "n_words", "n_removed", F.col("kept").cast("string").alias("kept_sha256"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    done = packing.pack(_table(spark, folder, "documents"), tokenizer_path())
    return done.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = language.held_out(4, 2)
    model = language.fit(docs.where(~held_out))
    predicted = docs.select("doc_id", held_out.alias("held_out"), language.predictor(spark, model)("text").alias("p"))
    return predicted.select("doc_id", "held_out", "p.*")


def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_copies(_table(spark, folder, "documents"))


def op6_language_model(spark: SparkSession, folder: str) -> DataFrame:
    held_out = language.held_out(5, 1)
    scored = language_model.score(_table(spark, folder, "documents"), ~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.report(_table(spark, folder, "documents"))
    counts = [f"n_{kind}" for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op8_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_copies(_table(spark, folder, "embeddings"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    held_out = language.held_out(5, 0)
    model = toxicity.fit(docs, _table(spark, folder, "labels").where(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.scorer(spark, model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(_table(spark, folder, "embeddings"))


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "n_chars")
    held_out = language.held_out(4, 2)
    model = quality.fit(docs, _table(spark, folder, "labels").where(~held_out))
    score = quality.scorer(spark, model)(F.col("text"), quality.stated_length(docs))
    scored = docs.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_packing": op3_packing,
    "op4_language": op4_language,
    "op5_ngram_join": op5_ngram_join,
    "op6_language_model": op6_language_model,
    "op7_pii": op7_pii,
    "op8_embeddings": op8_embeddings,
    "op9_decontamination": op9_decontamination,
    "op10_toxicity": op10_toxicity,
    "op11_vector_codes": op11_vector_codes,
    "op12_ranked_search": op12_ranked_search,
    "op13_quality": op13_quality,
}
__all__ = ["QUERIES", "SQL"]
