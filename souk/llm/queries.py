"""Registered queries of this folder: thin wrappers that apply an operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, chunks, embeddings, jaccard, langid, lines, mixing, negatives, pii, quality, runs, toxicity
from .common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_ids(table(spark, sf_dir, "documents"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data_spans(table(spark, sf_dir, "documents"))


def op5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeated_passages(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.conversation_digests(chat.with_quoting_conversation(table(spark, sf_dir, "conversations")))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digests(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(runs.with_planted_runs(table(spark, sf_dir, "documents")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mined(negatives.relabelled(table(spark, sf_dir, "embeddings")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, str(sf_dir))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_near_vectors": op2_near_vectors,
    "op3_language_id": op3_language_id,
    "op4_personal_data": op4_personal_data,
    "op5_mixture": op5_mixture,
    "op6_toxicity": op6_toxicity,
    "op7_jaccard": op7_jaccard,
    "op8_repeated_passages": op8_repeated_passages,
    "op9_quality": op9_quality,
    "op10_chat": op10_chat,
    "op11_line_dedup": op11_line_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op5_mixture": mixing.MIXTURE_SQL,
    "op10_chat": chat.CONVERSATIONS_SQL,
    "op11_line_dedup": lines.LINES_SQL,
    "op13_hard_negatives": negatives.NEGATIVES_SQL,
}
