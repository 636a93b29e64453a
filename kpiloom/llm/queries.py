"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    embedding_dedup, exact_dedup, fingerprints, hard_negatives, html_text, jaccard_join, language_id, lm_scoring, mixing, packing,
    reversed_search, substring_dedup, toxicity)
from .common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_substrings(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_of(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversed_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op10_jaccard_join": op10_jaccard_join, "op1_substring_dedup": op1_substring_dedup,
           "op2_toxicity": op2_toxicity, "op3_mixing": op3_mixing, "op4_lm_scoring": op4_lm_scoring, "op5_embedding_dedup": op5_embedding_dedup,
           "op6_language_id": op6_language_id,
           "op7_exact_dedup": op7_exact_dedup,
           "op8_html_text": op8_html_text, "op9_packing": op9_packing, "op11_fingerprints": op11_fingerprints,
           "op12_hard_negatives": op12_hard_negatives, "op13_reversed_search": op13_reversed_search}
ORACLES = {"op3_mixing": mixing.ORACLE, "op5_embedding_dedup": embedding_dedup.ORACLE,
           "op10_jaccard_join": jaccard_join.ORACLE, "op7_exact_dedup": exact_dedup.ORACLE,
           "op11_fingerprints": fingerprints.ORACLE, "op12_hard_negatives": hard_negatives.ORACLE,
           "op13_reversed_search": reversed_search.ORACLE}
