"""An inner equi-join whose groups may be large on both sides at once.

The pairs of one key grow with the product of its rows on the two sides, so a key can
be too much for one task long before its rows look large: adaptive skew handling, which
weighs bytes, does not see it. Such a key's pairs are laid out as a grid. Left rows are
dealt to grid rows and sent to every cell of their row, right rows to columns and every
cell of their column; each pair meets in exactly one cell. Cells are separate join keys,
and they are dealt to a fixed number of tasks, as adaptive execution would put cells of
few bytes together again, however many pairs they make.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rollbook.staging import Stage

# Rows of either side per grid cell: a cell has at most its square of pairs, four million.
CELL_ROWS = 2_000
# Tasks for each partition that the session's shuffles have.
TASKS_A_PARTITION = 4


def join_pairs(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: str,
    right_id: str,
    condition: str,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``left`` and ``right`` joined on the equally named ``keys`` and ``condition``.

    ``left_id`` and ``right_id`` are SQL expressions that tell rows of one key apart;
    they deal the rows to the grid, and being computed from the row itself they deal
    them alike in every retry. All keys take part; the grid only splits the large ones.
    ``condition`` must not equate a left and a right column: Spark would take these for
    further keys and shuffle once more; write ``x - y = 0``.
    """
    sizes = (
        left.selectExpr(*keys, "1L AS _l", "0L AS _r")
        .union(right.selectExpr(*keys, "0L AS _l", "1L AS _r"))
        .groupBy(*keys)
        .agg(F.expr("sum(_l) AS _l"), F.expr("sum(_r) AS _r"))
    )
    # Every key whose pairs exceed a cell gets a grid. Such keys have two cells' edges of
    # rows or more, so their table is that much shorter than the inputs; whether it is
    # small enough to broadcast is for Spark to measure.
    large = sizes.filter(f"CAST(_l AS DOUBLE) * _r > {cell_rows}D * {cell_rows}").selectExpr(
        *[f"{k} AS _grid_{k}" for k in keys],
        f"CAST(ceil(_l / {cell_rows}) AS INT) AS _rows",
        f"CAST(ceil(_r / {cell_rows}) AS INT) AS _columns",
    )
    cells = ["_row", "_column"]
    left = _dealt(left, large, keys, own="_row", dealt_by=left_id, others="_column")
    right = _dealt(right, large, keys, own="_column", dealt_by=right_id, others="_row")
    right = right.selectExpr(
        *[f"{c} AS _right_{c}" if c in (*keys, *cells) else c for c in right.columns]
    )
    same = " AND ".join(f"{c} = _right_{c}" for c in (*keys, *cells))
    spark = left.sparkSession
    tasks = TASKS_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    left = left.repartition(tasks, *keys, *cells)
    right = right.repartition(tasks, *[f"_right_{c}" for c in (*keys, *cells)])
    joined = left.join(right, F.expr(f"{same} AND ({condition})"))
    return joined.drop(*cells, *[f"_right_{c}" for c in (*keys, *cells)])


def join_counted_pairs(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: str,
    right_id: str,
    condition: str,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """The same, with the keys counted first, in jobs of their own.

    Without a key that needs a grid this is a plain join, which Spark may broadcast or shuffle
    as it sees fit; with some, only their rows go to the grid. Both sides are read twice:
    stage them if they are costly.
    """
    counted = (
        left.groupBy(*keys)
        .agg(F.expr("count(*) AS _l"))
        .join(right.groupBy(*keys).agg(F.expr("count(*) AS _r")), list(keys))
        .filter(f"CAST(_l AS DOUBLE) * _r > {cell_rows}D * {cell_rows}")
        .select(*keys)
    )
    large = Stage(left.sparkSession).table("large_keys", counted)
    plain_right = right.selectExpr(*[f"{c} AS _right_{c}" if c in keys else c for c in right.columns])
    same = " AND ".join(f"{c} = _right_{c}" for c in keys)

    def plainly(some: DataFrame) -> DataFrame:
        return some.join(plain_right, F.expr(f"{same} AND ({condition})")).drop(*[f"_right_{c}" for c in keys])

    if large.isEmpty():
        return plainly(left)
    gridded = join_pairs(
        left.join(large, list(keys), "left_semi"), right.join(large, list(keys), "left_semi"),
        keys, left_id, right_id, condition, cell_rows,
    )
    rest = plainly(left.join(large, list(keys), "left_anti"))
    return rest.unionByName(gridded.select(rest.columns))


def _dealt(
    side: DataFrame, large: DataFrame, keys: Sequence[str], own: str, dealt_by: str, others: str
) -> DataFrame:
    """Rows of large keys get their own grid line and are sent along all others."""
    counts = {"_row": "coalesce(_rows, 1)", "_column": "coalesce(_columns, 1)"}
    found = F.expr(" AND ".join(f"{k} = _grid_{k}" for k in keys))
    return side.join(large, found, "left").selectExpr(
        *side.columns,
        f"CAST(pmod(xxhash64({dealt_by}), {counts[own]}) AS INT) AS {own}",
        f"explode(sequence(0, {counts[others]} - 1)) AS {others}",
    )
