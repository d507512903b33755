"""What the operators share: their input columns, staged tables, hot groups in joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollbook.staging import Stage

# White space as every operator here means it, in a regular expression.
WHITE = "[\\x20\\x09-\\x0D]+"

# A group with more than 1 in HOT_SHARE of the rows is hot. There are fewer than HOT_SHARE
# such groups, whatever the data, so a table of them is small enough to broadcast.
HOT_SHARE = 1000
# Parts into which the rows of a hot group are dealt.
HOT_PARTS = 64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage(spark: SparkSession) -> Stage:
    """A new folder for staged tables below the session's shared folder."""
    return Stage(spark)


def texts(docs: DataFrame) -> DataFrame:
    """Ids and texts alone, whatever other columns there are; a null text is empty."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, lower))


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], deal: Column, how: str) -> DataFrame:
    """``rows`` joined with ``groups`` (one row a group, its row count in ``n``) on ``keys``.

    The rows of a hot group are dealt by ``deal``, an expression over a row's own columns,
    to HOT_PARTS parts, and the group's record is repeated for each part. So one shuffle
    serves all rows, and no task gets more than a small part of a group. Null keys match
    nothing; of ``how``, inner and left make sense. ``n`` stays.
    """
    total = groups.agg(F.sum("n").alias("_total"))
    hot = (
        groups.select(*keys, "n")
        .join(F.broadcast(total), F.expr(f"n * {HOT_SHARE} > _total"))
        .select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_hot"))
    )
    found = F.lit(True)
    for k in keys:
        found &= F.col(k) == F.col(f"_hot_{k}")
    part = F.when(F.col("_hot"), F.pmod(F.xxhash64(deal), F.lit(HOT_PARTS))).otherwise(0)
    dealt = rows.join(F.broadcast(hot), found, "left").select(*rows.columns, part.cast("int").alias("_part"))
    parts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(HOT_PARTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = groups.join(F.broadcast(hot), found, "left").select(
        *groups.columns, F.explode(parts).alias("_part")
    )
    return dealt.join(repeated, [*keys, "_part"], how).drop("_part")
