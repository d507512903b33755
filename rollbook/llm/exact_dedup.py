"""Exact duplicates of whole texts, found by recipes of content-defined chunks.

A text, its white space normalised, is cut where its own content says so. Equal chunks
become one chunk with one identifier, and a text becomes the ordered list of its chunks'
identifiers, its recipe. Two texts are equal exactly if their recipes are. Chunk texts are
shuffled once, and equal ones only once a task; from there on only recipes move, however
long the documents are.

Identifiers are hashes of chunks, verified on the chunks: all chunk texts under one hash
are compared, and where two differ, their rank tells them apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from rollbook.llm.tables import WHITE, join_groups, stage, texts


@dataclass(frozen=True)
class Chunking:
    """Chunks end after a cut mark, at ``least`` characters or more, at ``most`` at the latest.

    The mark is a pattern that about one in a few hundred places of prose matches.
    ``id_bits`` shortens the identifiers; only tests of collisions want that.
    """

    least: int = 256
    most: int = 8192
    mark: str = "[aeinrst][aeo] "
    id_bits: int = 64

    def chunks(self, text: Column) -> Column:
        """The chunks of a text in order; joined they are the text."""
        cut = f"(?s).{{{self.least},{self.most}}}?(?<={self.mark})|.{{1,{self.most}}}"
        return F.regexp_extract_all(text, F.lit(cut), F.lit(0))

    def identifier(self, chunk: Column) -> Column:
        return F.xxhash64(chunk).bitwiseAND(F.lit(-1 if self.id_bits == 64 else (1 << self.id_bits) - 1))


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITE, " ")


def chunk_store(docs: DataFrame, chunking: Chunking = Chunking()) -> DataFrame:
    """Each different chunk once: chunk_hash, chunk."""
    return (
        texts(docs)
        .select(F.explode(chunking.chunks(normalised(F.col("text")))).alias("chunk"))
        .select(chunking.identifier(F.col("chunk")).alias("chunk_hash"), "chunk")
        .distinct()
    )


def shared_hashes(docs: DataFrame, chunking: Chunking = Chunking()) -> DataFrame:
    """The hashes that stand for two or more different chunks: usually none."""
    return chunk_store(docs, chunking).groupBy("chunk_hash").count().filter("count > 1").select("chunk_hash")


def exact_duplicates(spark: SparkSession, docs: DataFrame, chunking: Chunking = Chunking()) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical after replacing every run of white space by one space; a
    null text is empty, and empty texts are equal. Of equal texts the row with the smallest
    doc_id stays (``kept``). Rows that repeat a doc_id and its text count as copies and get
    the same answer; null ids stand after all others. Other columns of ``docs`` are not read.
    """
    staged = stage(spark)
    recipes = staged.table("recipes", _recipes(spark, docs, chunking, staged))
    groups = recipes.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n"))
    several = staged.table("groups", groups.filter("n > 1"))
    joined = join_groups(recipes, several, ["recipe"], F.col("doc_id"), "left")
    keep_id = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )


def _recipes(spark: SparkSession, docs: DataFrame, chunking: Chunking, staged) -> DataFrame:
    """doc_id, recipe, text_sha256 of every row."""
    shared = staged.table("shared", shared_hashes(docs, chunking))
    rows = texts(docs).select("doc_id", normalised(F.col("text")).alias("text"))
    plain = rows.select(
        "doc_id",
        F.transform(chunking.chunks(F.col("text")), lambda c: chunking.identifier(c)).alias("ids"),
        F.sha2("text", 256).alias("text_sha256"),
    )
    if shared.isEmpty():
        return plain.select("doc_id", _binary(F.col("ids")).alias("recipe"), "text_sha256")
    # Some hash stands for several chunks: these chunks' ranks become part of the recipes.
    # A row is known by its id and digest here; rows alike in both have the same recipe.
    same_hash = Window.partitionBy("chunk_hash").orderBy("chunk")
    collided = chunk_store(docs, chunking).join(shared, "chunk_hash").withColumn("chunk_rank", F.row_number().over(same_hash))
    ranked = (
        rows.select("doc_id", F.sha2("text", 256).alias("text_sha256"), F.posexplode(chunking.chunks(F.col("text"))))
        .select("doc_id", "text_sha256", "pos", F.col("col").alias("chunk"), chunking.identifier(F.col("col")).alias("chunk_hash"))
        .join(collided, ["chunk_hash", "chunk"])
        .groupBy("doc_id", "text_sha256")
        .agg(F.sort_array(F.collect_set(F.struct("pos", "chunk_rank"))).alias("ranks"))
        .select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.to_json("ranks").alias("ranks"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_sha256") == F.col("_sha"))
    return plain.join(ranked, same, "left").select(
        "doc_id",
        F.concat(_binary(F.col("ids")), F.coalesce("ranks", F.lit("")).cast("binary")).alias("recipe"),
        "text_sha256",
    )


def _binary(ids: Column) -> Column:
    """Identifiers at eight bytes each, in order: a key that joins and groups take."""
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.lpad(F.hex(i), 16, "0")), ""))
