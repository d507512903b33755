"""A corpus cleaned and packed: stages that each apply one operator to what the last kept.

Documents are known by doc_id. Rows that repeat an id are one document here: they stay or
go together. Every stage but the last returns the columns of its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook.llm.exact_dedup import exact_duplicates
from rollbook.llm.near_dedup import near_duplicates
from rollbook.llm.packing import pack
from rollbook.llm.quality_classifier import keep_good
from rollbook.llm.quality_rules import apply_rules
from rollbook.llm.tables import stage, table


def _keep(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """The rows of the documents that are marked as kept."""
    ids = judged.filter("kept").select(F.col("doc_id").alias("_kept_id"))
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_kept_id"]), "left_semi")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, trained on these, rejects."""
    return keep_good(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that a rule rejects; cutoffs come from the labelled ones here."""
    return _keep(docs, apply_rules(spark, docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text, the one with the smallest id."""
    return _keep(docs, exact_duplicates(spark, docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates that links join, the document with the smallest id."""
    return _keep(docs, near_duplicates(spark, docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences.

    Executors still hold memory of the earlier stages, so encoders remember fewer words.
    """
    return pack(spark, docs, remembered=200_000)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

# Classifiers, near duplicates and packing are beyond SQL; tests hold the run against
# plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied in turn to ``documents``, each result written and read again."""
    staged, docs = stage(spark), table(spark, sf_dir, "documents")
    for number, (_, apply) in enumerate(STAGES):
        docs = staged.table(str(number), apply(spark, docs, sf_dir))
    return docs
