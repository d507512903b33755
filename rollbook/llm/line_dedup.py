"""Lines that many documents share, dropped from all of them but one.

Lines are compared by keys: white space stripped at both ends, A-Z in lower case. Documents
are counted per hash of a key; each document counts once, and each task adds up its own
documents before anything is shuffled. Only hashes, ids and positions are joined with the
shared keys. Texts move once, to meet the positions of the lines they lose.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollbook.llm.tables import ascii_lower, join_groups, stage, texts

_ENDS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Sharing:
    """A key counts from ``least_length`` code points, and is shared from ``documents`` on."""

    least_length: int = 20
    documents: int = 3


def line_keys(lines: Column) -> Column:
    return F.transform(lines, lambda line: ascii_lower(F.btrim(line, F.lit(_ENDS))))


def _hashed(key: Column) -> Column:
    """128 bits: with 64, some of the lines of a very large corpus would coincide."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


def key_hashes(docs: DataFrame, sharing: Sharing) -> DataFrame:
    """doc_id, row (tells apart rows that repeat an id), keys: an array of (key, pos)."""
    keys = F.transform(
        line_keys(F.split("text", "\n")),
        lambda key, pos: F.struct(
            F.when(F.length(key) >= sharing.least_length, _hashed(key)).alias("key"), pos.alias("pos")
        ),
    )
    return texts(docs).select(
        "doc_id", F.xxhash64("text").alias("row"), F.filter(keys, lambda k: k["key"].isNotNull()).alias("keys")
    )


def shared_lines(docs: DataFrame, sharing: Sharing = Sharing()) -> DataFrame:
    """a, b (a key's hash), n (its documents), keep_id (the largest of them).

    Documents are ids: where ids repeat, their keys are made distinct first. The table of
    repeated ids is empty or small as a rule, and the keys of all others are counted as they
    come. Rows without an id are no documents.
    """
    once = F.array_distinct(F.transform("keys", lambda k: k["key"]))
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("_rows")).filter("_rows > 1 AND doc_id IS NOT NULL")
    keys = key_hashes(docs, sharing).filter("doc_id IS NOT NULL").select("doc_id", F.inline(once))
    marked = keys.join(repeated, "doc_id", "left")
    again = marked.filter("_rows IS NOT NULL").select("doc_id", "a", "b").distinct()
    return (
        marked.filter("_rows IS NULL").select("doc_id", "a", "b").unionByName(again)
        .groupBy("a", "b")
        .agg(F.count("*").alias("n"), F.max("doc_id").alias("keep_id"))
        .filter(F.col("n") >= sharing.documents)
    )


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sharing: Sharing = Sharing()) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_text.

    Texts are split at line feeds; a null or empty text is one empty line. Of each key of
    at least ``least_length`` code points that ``documents`` documents or more hold, all
    lines go except those in the largest doc_id. A line repeated within a document counts
    as one document, and goes or stays with all its repetitions. Rows that repeat a doc_id
    count as one document, and those with the largest id all keep the line. A row without an
    id is none, but loses every shared line. Other columns of ``docs`` are not read.
    """
    staged = stage(spark)
    shared = staged.table("shared", shared_lines(docs, sharing))
    lines = key_hashes(docs, sharing).select("doc_id", "row", F.inline("keys"))
    lines = lines.select("doc_id", "row", "key.a", "key.b", "pos")
    matched = join_groups(lines, shared, ["a", "b"], F.struct("doc_id", "pos"), "inner")
    lost = (
        matched.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row"))
        .agg(F.collect_set("pos").alias("_lost"))
    )
    own = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_row"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "_lost")
    return (
        texts(docs)
        .join(lost, own, "left")
        .select("doc_id", "text", F.split("text", "\n").alias("lines"), "_lost")
        .select("doc_id", "text", "lines", "_lost", stay.alias("_stay"))
        .select(
            "doc_id",
            F.size("lines").cast("long").alias("n_lines"),
            F.when(F.col("_lost").isNull(), 0).otherwise(F.size("_lost")).cast("long").alias("n_dropped"),
            F.when(F.col("_lost").isNull(), F.col("text"))
            .otherwise(F.array_join(F.transform("_stay", lambda pos: F.get("lines", pos)), "\n"))
            .alias("kept_text"),
        )
    )
