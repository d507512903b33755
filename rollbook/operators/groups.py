"""Rows of selected groups, when one group may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollbook.staging import Stage

# Groups with more than 1 in HEAVY_GROUPS of the rows are joined by broadcast: there are fewer
# than HEAVY_GROUPS of them, whatever the data.
HEAVY_GROUPS = 1000
# Bits of the filter that keeps rows of other groups out of the shuffle, a megabyte.
FILTER_BITS = 1 << 23
# Bits of one bitmap, as Spark's bitmap functions have it.
_BITMAP = 32_768


def rows_of_groups(
    rows: DataFrame,
    groups: DataFrame,
    key: str,
    keep: str,
    heavy_groups: int = HEAVY_GROUPS,
) -> DataFrame:
    """``rows`` inner-joined with the groups for which ``keep`` holds; null is a key too.

    ``groups`` is an aggregate with one row for each key in ``rows``, its row count in ``n``
    and the other columns to add. The kept and the heavy groups are staged, when this is
    called. Heavy groups are never shuffled: their rows meet a broadcast of those few group
    records where they lie. Of the other rows, only those whose key is in a Bloom filter of
    the kept keys are shuffled, and none if no such key is kept. Both parts cover all rows
    exactly once. ``rows`` is read up to three times: stage it if it is costly.
    """
    total = rows.count()
    flagged = groups.selectExpr("*", f"coalesce({keep}, false) AS _keep", f"n * {heavy_groups} > {total} AS _heavy")
    picked = Stage(rows.sparkSession).table("groups", flagged.filter("_keep OR _heavy"))
    heavy, light = picked.filter("_heavy").drop("_heavy"), picked.filter("_keep AND NOT _heavy").drop("_heavy")

    in_place = _join(rows, F.broadcast(heavy.filter("_keep")), key, "inner")
    if light.isEmpty():
        return in_place
    others = _join(rows, F.broadcast(heavy.select(key)), key, "left_anti")
    return in_place.unionByName(_join(_filtered(others, light, key), light, key, "inner"))


def _filtered(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """The rows whose key may be one of the groups: a Bloom filter with one hash.

    The filter is FILTER_BITS long however many keys there are, so it can be broadcast. With
    as many keys as bits it lets most rows pass, which costs their shuffle and nothing else.
    """
    bit = f"pmod(xxhash64({key}), {FILTER_BITS})"
    bitmaps = (
        groups.selectExpr(f"{bit} AS _bit")
        .groupBy(F.expr(f"CAST(_bit div {_BITMAP} AS INT) AS _block"))
        .agg(F.expr(f"bitmap_construct_agg(_bit % {_BITMAP}) AS _bits"))
    )
    byte = "CAST(conv(hex(substring(_bits, CAST(_at div 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    placed = rows.selectExpr("*", f"CAST({bit} div {_BITMAP} AS INT) AS _block", f"{bit} % {_BITMAP} AS _at")
    met = placed.join(F.broadcast(bitmaps), "_block")
    return met.filter(f"shiftright({byte}, CAST(_at % 8 AS INT)) & 1 = 1").select(rows.columns)


def _join(rows: DataFrame, groups: DataFrame, key: str, how: str) -> DataFrame:
    renamed = groups.withColumnRenamed(key, "_key")
    joined = rows.join(renamed, rows[key].eqNullSafe(renamed["_key"]), how)
    return joined if how == "left_anti" else joined.drop("_key", "_keep", "n")
