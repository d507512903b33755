"""The operators as queries on the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook.llm.alignment import align
from rollbook.llm.exact_dedup import exact_duplicates
from rollbook.llm.language_model import score
from rollbook.llm.line_dedup import drop_shared_lines
from rollbook.llm.near_dedup import near_duplicates
from rollbook.llm.packing import pack
from rollbook.llm.quality_classifier import classify
from rollbook.llm.quality_rules import apply_rules
from rollbook.llm.sentence_pieces import encode_and_decode
from rollbook.llm.tables import table
from rollbook.llm.token_counts import token_counts
from rollbook.llm.toxicity import toxicity
from rollbook.llm.url_filters import judge
from rollbook.llm.whitening import whitened_components

# A document with more tokens does not fit one training sequence.
TOKEN_LIMIT = 2048


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    found = token_counts(table(spark, folder, "documents"))
    return found.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(spark, table(spark, folder, "documents"))


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(spark, table(spark, folder, "documents"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = apply_rules(spark, table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.drop("n_lines", "failed_rules")


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classify(table(spark, folder, "documents"))


def op7_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return judge(spark, table(spark, folder, "pages"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = drop_shared_lines(spark, table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(spark, table(spark, folder, "documents"))


def op10_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return encode_and_decode(table(spark, folder, "documents"))


def op11_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return score(spark, table(spark, folder, "documents"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened_components(table(spark, folder, "embeddings"))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align(spark, table(spark, folder, "documents"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_toxicity": op2_toxicity,
    "op3_near_dedup": op3_near_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_quality_rules": op5_quality_rules,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_url_filters": op7_url_filters,
    "op8_line_dedup": op8_line_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_sentence_pieces": op10_sentence_pieces,
    "op11_language_model": op11_language_model,
    "op12_whitening": op12_whitening,
    "op13_token_alignment": op13_token_alignment,
}
