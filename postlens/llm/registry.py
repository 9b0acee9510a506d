"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm import alignment, chat, hnsw, kneser_ney, langid, line_rules, mixing, ngram_join, oracle, packing, passages, sharding, source_audit, toxicity
from postlens.llm.common import id_remainder, table

#: The vocabulary file that the queries use; operators take the path as a parameter.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_remainder("doc_id", 5) == 0
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out & F.col("toxic").isNotNull())
    model = toxicity.train_toxicity(docs, labels)
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_remainder("doc_id", 7) == 2
    model = kneser_ney.train(docs.where(~held_out))
    return kneser_ney.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.vocabulary.tokens).cast("long").alias("train_tokens"),
        "base_score", "score")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.embedding_components(table(spark, sf_dir, "embeddings"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder("doc_id", 4) == 2
    model = langid.train_language_id(docs.where(~held_out))
    return langid.identify_language(docs.select("doc_id", "text"), model, keep=["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__lang_score").alias("score"),
        F.col("__ambiguous").alias("ambiguous"))


def op5_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_rules.clean_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *[F.col(f"__{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
                        F.col("__target").alias("target"), F.col("__taken").alias("taken"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair_conversations(table(spark, sf_dir, "conversations"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.source_divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), TOKENIZER, PIECES)


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_language_id": op4_language_id,
    "op5_line_rules": op5_line_rules,
    "op6_ngram_join": op6_ngram_join,
    "op7_source_mixing": op7_source_mixing,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_source_divergence": op11_source_divergence,
    "op12_sharding": op12_sharding,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

ORACLE: dict[str, str] = {
    "op3_embedding_dedup": oracle.EMBEDDING_DEDUP,
    "op5_line_rules": oracle.LINE_RULES,
    "op6_ngram_join": oracle.NGRAM_JOIN,
    "op7_source_mixing": oracle.SOURCE_MIXING,
    "op11_source_divergence": oracle.SOURCE_DIVERGENCE,
    "op12_sharding": oracle.SHARDING,
}
