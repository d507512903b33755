"""Cross-company match candidates: same name or similar name, hired close together.

Candidates are only proposed for review; nothing is merged.

Both joins are band joins on the hire date. The date axis is cut into buckets twice as
wide as the band, so a left row reaches at most two buckets while a right row lies in
one, and a pair meets exactly once. Bucket and name together are the key of an
equi-join; a key with many rows on both sides is split (see ``pairs``).

Pairs grow with the square of a name's rows. ``sorted_matches`` puts them in the order of
their ids without shuffling them: rows equal in company, name and hire date have the same
partners, so it sends each task the partners of such a class once, in order, and unfolds
them beside each left row.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Window, functions as F

from rollbook.config import DEFAULT_SETTINGS
from rollbook.functions import similarity
from rollbook.functions.text import literal, sorted_tokens
from rollbook.functions.values import day_gap, day_number
from rollbook.operators.identity import repeated_keys
from rollbook.operators.pairs import CELL_ROWS, join_counted_pairs
from rollbook.staging import Stage

SAME_NAME = "same_full_name_hire_date_window"
SIMILAR_NAME = "fuzzy_name_hire_date_window"

# Partners of one left class in a row of its list.
LIST_ROWS = 1_000
# Pairs that make another task worth while, until there is one for each partition that the
# session's shuffles have, and pairs at which a task is full.
TASK_PAIRS, FULL_TASK_PAIRS = 250_000, 2_000_000
# Lists are sent instead of pairs if on average so many left rows share one.
SHARED_BY = 2

_KEYS = ("employee_id", "company_origin", "full_name")
_DETAILS = ("email", "hire_date")
# What a match depends on.
_CLASS = ("company_origin", "full_name", "hire_date")
_IDS = ("left_employee_id", "right_employee_id")
_GAP = day_gap("left_hire_date", "right_hire_date")


def _people(golden: DataFrame) -> DataFrame:
    return golden.select(*_KEYS, *_DETAILS).filter(
        "full_name IS NOT NULL AND hire_date IS NOT NULL"
    )


def _bucket(day: str, gap: int) -> str:
    return f"CAST(floor(({day}) / {2 * (gap + 1)}) AS INT)"


def _own_bucket(gap: int) -> str:
    return f"{_bucket(day_number('hire_date'), gap)} AS _bucket"


def _reached_buckets(gap: int) -> str:
    """One row for each bucket that holds any date within the band: one or two."""
    day = day_number("hire_date")
    first, last = _bucket(f"{day} - {gap + 1}", gap), _bucket(f"{day} + {gap}", gap)
    return f"explode(array_distinct(array({first}, {last}))) AS _bucket"


def _side(df: DataFrame, side: str) -> DataFrame:
    """Columns with the side's name in front; helper columns are keys and keep theirs."""
    return df.selectExpr(*[c if c[0] == "_" else f"{c} AS {side}_{c}" for c in df.columns])


def same_name_matches(
    golden: DataFrame,
    max_gap_days: int = DEFAULT_SETTINGS.max_hire_date_gap_days,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Pairs of rows with equal full names in two companies; left is the first company."""
    people = _people(golden).selectExpr("*", "full_name AS _name")
    pairs = join_counted_pairs(
        _side(people.selectExpr("*", _reached_buckets(max_gap_days)), "left"),
        _side(people.selectExpr("*", _own_bucket(max_gap_days)), "right"),
        keys=["_name", "_bucket"],
        left_id="left_employee_id",
        right_id="right_employee_id",
        condition=f"left_company_origin < right_company_origin AND {_GAP} <= {max_gap_days}",
        cell_rows=cell_rows,
    )
    return _pair_columns(pairs, SAME_NAME)


def similar_name_matches(
    golden: DataFrame,
    threshold: float = DEFAULT_SETTINGS.similarity_threshold,
    max_gap_days: int = DEFAULT_SETTINGS.max_hire_date_gap_days,
    left_company: str = "AcquiredCo",
    right_company: str = "GlobalTech",
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Pairs of rows of two companies whose names score at least ``threshold``.

    Names are compared once per (bucket, name), not once per pair of rows: rows with
    the same name in the same bucket collapse before the comparison and are expanded
    after it. Hire dates are compared as timestamps, both ends included.

    Runs jobs when called: what is used twice is staged in the shared folder.
    """
    stage = Stage(golden.sparkSession)
    people = _people(golden).selectExpr("*", f"{sorted_tokens('full_name')} AS _name")
    left = people.filter(f"company_origin = {literal(left_company)}").selectExpr(
        "*", _reached_buckets(max_gap_days)
    )
    right = people.filter(f"company_origin = {literal(right_company)}").selectExpr(
        "*", _own_bucket(max_gap_days)
    )
    similar = similar_names(
        left.select("_bucket", "_name").distinct(),
        right.select("_bucket", "_name").distinct(),
        threshold,
        stage,
        cell_rows,
    )
    # one left row per similar name, under that name; then the right rows of the name
    named = _side(left, "left").withColumnRenamed("_name", "_left")
    wanted = stage.table(
        "wanted",
        join_counted_pairs(
            named,
            similar,
            keys=["_bucket", "_left"],
            left_id="left_employee_id",
            right_id="_right",
            condition="true",
            cell_rows=cell_rows,
        )
        .withColumnRenamed("_right", "_name")
        .select("_name", "_bucket", "_score", *[c for c in named.columns if c[0] != "_"]),
    )
    band = f"INTERVAL '{int(max_gap_days)}' DAY"
    pairs = join_counted_pairs(
        wanted,
        _side(right, "right"),
        keys=["_name", "_bucket"],
        left_id="left_employee_id",
        right_id="right_employee_id",
        condition=f"right_hire_date BETWEEN left_hire_date - {band} AND left_hire_date + {band}",
        cell_rows=cell_rows,
    )
    return _pair_columns(pairs, SIMILAR_NAME, "_score AS name_similarity_score")


def similar_names(
    left: DataFrame,
    right: DataFrame,
    threshold: float,
    stage: Stage,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """All (_bucket, _left, _right, _score) with a token-sort score of at least ``threshold``.

    Inputs are distinct (_bucket, _name) with names already token-sorted. The candidate
    join is lossless: the threshold leaves two strings of given lengths a budget of d
    insertions and deletions; cut the right string into d + 1 pieces and at least one
    is found unchanged in the left one, at a known place. So each string yields a few
    keys per partner length it may have, and equal keys are the candidates: an
    equi-join, where comparing every pair in a bucket would grow with its square.
    """
    rule = similarity.Threshold(threshold)
    left_names = stage.table(
        "left_names",
        left.selectExpr(
            "_bucket", "_name AS _left", f"{similarity.character_masks('_name')} AS _masks"
        ),
    )
    right_names = stage.table(
        "right_names", right.selectExpr("_bucket AS _other_bucket", "_name AS _right")
    )
    # Keys are many times the names, so they are worked out once: the join counts them first.
    left_keys = _with_pieces(left_names, "_left", rule, _probes(rule)).selectExpr(
        "_bucket",
        "_left",
        "xxhash64(_bucket, _other, length(_left), _p, substr(_left, _from, _size)) AS _piece",
    )
    right_keys = _with_pieces(right_names, "_right", rule, _pieces(rule)).selectExpr(
        "_other_bucket",
        "_right",
        "xxhash64(_other_bucket, length(_right), _other, _p, substr(_right, _from, _size)) "
        "AS _piece",
    )
    left_keys = stage.table("left_keys", left_keys)
    right_keys = stage.table("right_keys", right_keys)
    # Levenshtein distance counts a substitution once where Indel distance counts it
    # twice, so it never exceeds it; Spark stops counting at the budget and returns -1
    budget = rule.budget("length(_left)", "length(_right)")
    candidates = join_counted_pairs(
        left_keys,
        right_keys,
        keys=["_piece"],
        left_id="_left",
        right_id="_right",
        condition=f"_bucket - _other_bucket = 0 AND levenshtein(_left, _right, {budget}) >= 0",
        cell_rows=cell_rows,
    )
    total = "length(_left) + length(_right)"
    lcs = similarity.lcs_length("_left", "_masks", "_right")
    # several pieces may have met: one row per pair of names
    pairs = candidates.select("_bucket", "_left", "_right").distinct()
    return (
        pairs.join(left_names, ["_bucket", "_left"])
        .selectExpr("_bucket", "_left", "_right", f"{lcs} AS _lcs")
        .filter(rule.reached(total, "_lcs"))
        .selectExpr("_bucket", "_left", "_right", f"{similarity.score(total, '_lcs')} AS _score")
    )


# Which pieces a name has depends on its length alone. Where both are small, length and
# edit budget, pieces are listed once per length and sent to the names: at the published
# threshold some ten thousand rows. Longer names, which are rare, work out their own.
LISTED_LENGTH = 64
LISTED_BUDGET = 16


def _with_pieces(
    names: DataFrame, name: str, rule: similarity.Threshold, layout: str
) -> DataFrame:
    """One row per piece: partner length, piece number, where it starts and its size."""
    longest = int(min(LISTED_LENGTH, rule.longest_within(LISTED_BUDGET)))
    lengths = names.sparkSession.range(1, longest + 1, 1, 1)
    listed = lengths.selectExpr("CAST(id AS INT) AS _length").selectExpr(
        "_length", f"inline({layout})"
    )
    own = names.selectExpr("*", f"length({name}) AS _length")
    short = own.join(F.broadcast(listed), "_length")
    long = own.filter(f"_length > {longest}").selectExpr("*", f"inline({layout})")
    return short.unionByName(long)


def _cut(length: str, budget: str) -> tuple[str, str]:
    """Start and size of piece ``p`` of a string cut into ``budget + 1`` even pieces."""
    start = f"CAST({length} * p div ({budget} + 1) AS INT)"
    end = f"CAST({length} * (p + 1) div ({budget} + 1) AS INT)"
    return start, f"({end} - {start})"


def _pieces(rule: similarity.Threshold) -> str:
    """For every partner length ``n``: the pieces of a (right) name of ``_length``."""
    budget = rule.budget("_length", "n")
    start, size = _cut("_length", budget)
    piece = f"struct(n AS _other, p AS _p, {start} + 1 AS _from, {size} AS _size)"
    every = f"transform(sequence(0, {budget}), p -> {piece})"
    return f"flatten(transform({rule.partner_lengths('_length')}, n -> {every}))"


def _probes(rule: similarity.Threshold) -> str:
    """For every partner length ``n``: where its pieces may reappear in a (left) name.

    Walk the pieces from the left and count errors: some untouched piece p has exactly
    p errors before it and at most d - p after it. Each error moves the text by one
    place, so the piece is shifted by -p, -p + 2, ... or p, and what remains of the
    length difference must fit the errors that remain.
    """
    budget = rule.budget("_length", "n")
    start, size = _cut("n", budget)
    fits = (
        f"abs(_length - n - s) <= {budget} - p AND {start} + s >= 0 "
        f"AND {start} + s + {size} <= _length"
    )
    shifts = f"filter(sequence(-p, p, 2), s -> {fits})"
    probe = f"struct(n AS _other, p AS _p, {start} + s + 1 AS _from, {size} AS _size)"
    every = f"transform(sequence(0, {budget}), p -> transform({shifts}, s -> {probe}))"
    return f"flatten(transform({rule.partner_lengths('_length')}, n -> flatten({every})))"


def _pair_columns(pairs: DataFrame, match_type: str, *score: str) -> DataFrame:
    def both(columns: tuple[str, ...]) -> list[str]:
        return [f"{side}_{c}" for c in columns for side in ("left", "right")]

    return pairs.selectExpr(
        f"{literal(match_type)} AS match_type",
        *both(_KEYS),
        *score,
        *both(_DETAILS),
        f"{_GAP} AS hire_date_gap_days",
        "true AS review_required",
    )


def probable_matches(
    same_name: DataFrame,
    similar_name: DataFrame,
    golden: DataFrame | None = None,
    max_gap_days: int = DEFAULT_SETTINGS.max_hire_date_gap_days,
) -> DataFrame:
    """Both kinds of match, one row per pair of records; the same-name finding wins.

    Give ``golden``, the table that both were found in with ``max_gap_days``: if no id comes
    twice in it, which a job of its own counts, the pairs are not shuffled. A pair of ids is
    then one pair of rows, and the pair itself tells whether it was found by equal names.
    """
    if golden is not None and repeated_keys(_people(golden), "employee_id").isEmpty():
        others = similar_name.filter(f"({_found_by_name(max_gap_days)}) IS NOT TRUE")
        return same_name.unionByName(others, allowMissingColumns=True)
    both = same_name.unionByName(similar_name, allowMissingColumns=True)
    # every column takes part, so that a pair found twice has one fixed winner
    order = [F.expr(f"IF(match_type = {literal(SAME_NAME)}, 1, 2)"), "hire_date_gap_days"]
    order += ["left_hire_date", "right_hire_date", "left_full_name", "right_full_name"]
    pair = Window.partitionBy("left_employee_id", "right_employee_id")
    first = F.row_number().over(pair.orderBy(*order, "left_email", "right_email"))
    return both.withColumn("_rank", first).filter("_rank = 1").drop("_rank")


def _found_by_name(max_gap_days: int) -> str:
    """Whether a pair of similar names is one of ``same_name_matches`` too."""
    return (
        "left_full_name = right_full_name AND left_company_origin < right_company_origin "
        f"AND hire_date_gap_days <= {max_gap_days}"
    )


def sorted_matches(
    golden: DataFrame,
    threshold: float = DEFAULT_SETTINGS.similarity_threshold,
    max_gap_days: int = DEFAULT_SETTINGS.max_hire_date_gap_days,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``probable_matches`` of both kinds in ``golden``, by left and right id across partitions.

    Matches are found between classes: rows equal in company, full name and hire date, on
    which alone a match depends. Lists of partners are shuffled, and no pair is. Only if an
    id comes twice are pairs themselves compared and sorted.

    Runs jobs when called. ``golden`` is read several times: stage it if it is costly.
    """

    def found(rows: DataFrame) -> DataFrame:
        return probable_matches(
            same_name_matches(rows, max_gap_days, cell_rows),
            similar_name_matches(rows, threshold, max_gap_days, cell_rows=cell_rows),
            rows,
            max_gap_days,
        )

    stage = Stage(golden.sparkSession)
    people = _people(golden)
    if not repeated_keys(people, "employee_id").isEmpty():
        return found(golden).orderBy(*_IDS)
    classes = people.select(*_CLASS).distinct().withColumn("_class", F.monotonically_increasing_id())
    classes = stage.table("classes", classes)
    pairs = stage.table(
        "class_pairs",
        found(classes.selectExpr("CAST(_class AS STRING) AS employee_id", *_CLASS, "CAST(NULL AS STRING) AS email")),
    )
    of_class = [c for c in pairs.columns if not c.startswith("left_") and c not in ("right_employee_id", "right_email")]
    linked = pairs.selectExpr(
        "CAST(left_employee_id AS BIGINT) AS _left",
        "CAST(right_employee_id AS BIGINT) AS _right",
        f"struct({', '.join(of_class)}) AS _match",
    )
    members = stage.table("members", people.join(classes, list(_CLASS)))
    lists = stage.table("lists", _partner_lists(linked, members))
    return _unfolded(lists, members, stage).select(pairs.columns)


def _partner_lists(linked: DataFrame, members: DataFrame) -> DataFrame:
    """The partners of each left class by their ids, LIST_ROWS a row, numbered by ``_chunk``.

    What all members of a partner's class share is held once, in ``_matches``: a partner has
    its place there, from 1, in ``_at``.
    """
    partners = members.selectExpr("employee_id AS right_employee_id", "email AS right_email", "_class AS _right")
    by_id = Window.partitionBy("_left").orderBy("right_employee_id")
    # as many tasks as shuffles have: adaptive execution would go by bytes sent, which are few
    partitions = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = (
        linked.join(partners, "_right")
        .repartition(partitions, "_left")
        .withColumn("_number", F.row_number().over(by_id))
        .withColumn("_chunk", F.expr(f"CAST((_number - 1) div {LIST_ROWS} AS INT)"))
    )
    rows = numbered.groupBy("_left", "_chunk").agg(
        F.expr("count(*) AS _size"),
        F.expr("sort_array(collect_list(struct(right_employee_id, right_email, _right))) AS _partners"),
        F.expr("sort_array(collect_set(struct(_right, _match))) AS _classes"),
    )
    rows = rows.withColumn("_rights", F.expr("_classes._right"))
    at = "CAST(array_position(_rights, p._right) AS INT)"
    placed = f"transform(_partners, p -> struct(p.right_employee_id, p.right_email, {at} AS _at))"
    return rows.selectExpr(
        "_left", "_chunk", "_size", f"struct({placed} AS _partners, _classes._match AS _matches) AS _list"
    )


def _unfolded(lists: DataFrame, members: DataFrame, stage: Stage) -> DataFrame:
    """Every left row with every partner, by their ids; a task holds a range of them.

    Left rows come once for each row of their class's list, which ranges of ids and row
    numbers deal to the tasks. Each task is sent every list row it needs once, fills it in at
    its left rows, sorts these and unfolds the list rows, whose partners are in order.
    """
    lengths = lists.groupBy("_left").agg(F.expr("max(_chunk) AS _last"), F.expr("sum(_size) AS _size"))
    lefts = _side(members, "left").withColumnRenamed("_class", "_left")
    left_columns = [c for c in lefts.columns if c != "_left"]
    lefts = lefts.join(lengths, "_left")
    pairs = lefts.selectExpr("coalesce(sum(CAST(_size AS DOUBLE)), 0)").first()[0]
    partitions = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(partitions, ceil(pairs / TASK_PAIRS)), ceil(pairs / FULL_TASK_PAIRS))
    needed = stage.table(
        "needed",
        lefts.selectExpr(*left_columns, "_left", "explode(sequence(0, _last)) AS _chunk")
        .repartitionByRange(tasks, "left_employee_id", "_chunk")
        .withColumn("_task", F.spark_partition_id()),
    )
    keys = ["_task", "_left", "_chunk"]
    sent = lists.drop("_size").join(needed.select(keys).distinct(), ["_left", "_chunk"])
    both = needed.unionByName(sent, allowMissingColumns=True).repartitionById(tasks, "_task")
    list_first = Window.partitionBy(*keys).orderBy(F.expr("_list IS NULL"))
    so_far = list_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = both.withColumn("_found", F.first("_list", ignorenulls=True).over(so_far)).filter("_list IS NULL")
    return (
        filled.sortWithinPartitions("left_employee_id", "_chunk")
        .selectExpr(*left_columns, "_found._matches AS _matches", "inline(_found._partners)")
        .selectExpr(*left_columns, "right_employee_id", "right_email", "_matches[_at - 1] AS _match")
        .select(*left_columns, "right_employee_id", "right_email", "_match.*")
    )
