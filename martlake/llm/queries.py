"""The registered query of each operator, with its production parameters, over
the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession

from martlake.llm import (
    chat_hmm, column_dedup, decontam, line_dedup, mixing, nn_descent, parity_join, repetition, secret_ledger, spectrum_slicing,
    token_alignment, token_shortcut, weak_toxicity,
)
from martlake.llm.oracle import ORACLE_SQL
from martlake.llm.tables import documents, table

#: Vocabulary file of the token counts.
TOKENIZER = "byte_bpe_50k.json"
#: Piece vocabulary aligned with it.
PIECES = "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_hmm.formatted(table(spark, sf_dir, "conversations"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ledger.secret_report(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_path(TOKENIZER), encoding="utf-8") as f:
        return token_shortcut.token_counts(documents(spark, sf_dir), f.read())


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(documents(spark, sf_dir))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leak_report(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.similarity_components(documents(spark, sf_dir), parity_join.Join(n=3, num=90, den=100))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_dedup.removal_report(documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.verdict(repetition.repetition_measures(documents(spark, sf_dir)))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, sf_dir))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectrum_slicing.whitened(table(spark, sf_dir, "embeddings"))


def alignment_vocabularies() -> token_alignment.Vocabularies:
    with open(tokenizer_path(TOKENIZER), encoding="utf-8") as spec, open(tokenizer_path(PIECES), "rb") as model:
        return token_alignment.vocabularies(spec.read(), model.read())


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.aligned(documents(spark, sf_dir), alignment_vocabularies())


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(table(spark, sf_dir, "embeddings"), "id % 20 = 0")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_chat_format, op2_secret_scan, op3_toxicity, op4_token_counts, op5_source_mixing, op6_decontamination,
        op7_ngram_jaccard_join, op8_suffix_dedup, op9_quality_rules, op10_line_dedup,
        op11_embedding_whitening, op12_cross_tokenizer_alignment, op13_nearest_neighbours,
    )
}

__all__ = ["ORACLE_SQL", "QUERIES"]
