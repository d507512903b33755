import datetime as dt
import gzip
import os
import random

import pytest
from pyspark.sql import functions as F
from test_functions import lcs, score

from rollbook import queries
from rollbook.operators import export, matching
from rollbook.operators.pairs import join_pairs
from rollbook.queries import REGISTRY
from rollbook.staging import Stage

SCHEMA = (
    "employee_id string, company_origin string, full_name string, email string, "
    "hire_date timestamp_ntz"
)
DAY = dt.datetime(2020, 1, 1)


def people(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def random_people(seed, n, letters="abc", length=12):
    rng = random.Random(seed)
    names = []
    for _ in range(n):
        if names and rng.random() < 0.6:
            name = list(rng.choice(names))
            for _ in range(rng.randint(0, 3)):
                i = rng.randrange(len(name) + 1)
                if rng.random() < 0.5 and len(name) > 1:
                    del name[min(i, len(name) - 1)]
                else:
                    name.insert(i, rng.choice(letters))
            name = "".join(name).strip() or "a"
        else:
            name = " ".join(
                "".join(rng.choices(letters, k=rng.randint(1, length)))
                for _ in range(rng.randint(1, 3))
            )
        names.append(name)
    rows = []
    for i, name in enumerate(names):
        company = rng.choice(["AcquiredCo", "GlobalTech"])
        hired = DAY + dt.timedelta(hours=12 * rng.randint(0, 400))
        rows.append((f"{company[:1]}-{i:05d}", company, name, f"{i}@x.com", hired))
    return rows


def gap(left, right):
    return abs((left[4] - right[4]).days)


def expected_same(rows, days):
    return sorted(
        (a[0], b[0], gap(a, b))
        for a in rows
        for b in rows
        if a[1] < b[1] and a[2] == b[2] and gap(a, b) <= days
    )


def expected_similar(rows, threshold, days):
    band = dt.timedelta(days=days)
    found = []
    for a in rows:
        for b in rows:
            if a[1] == "AcquiredCo" and b[1] == "GlobalTech" and abs(a[4] - b[4]) <= band:
                value = score(*(" ".join(sorted(x[2].split())) for x in (a, b)))
                if value >= threshold:
                    found.append((a[0], b[0], value, gap(a, b)))
    return sorted(found)


@pytest.mark.parametrize("cell_rows", [2, 20_000])
@pytest.mark.parametrize("days", [0, 30])
def test_same_name_against_brute_force(spark, days, cell_rows):
    rows = random_people(1, 400, letters="ab", length=1)
    found = matching.same_name_matches(people(spark, rows), days, cell_rows).collect()
    pairs = sorted(
        (r["left_employee_id"], r["right_employee_id"], r["hire_date_gap_days"]) for r in found
    )
    assert pairs == expected_same(rows, days)
    assert pairs


@pytest.mark.parametrize(
    "threshold, days, cell_rows, letters",
    [(88, 30, 20_000, "abc"), (75, 30, 3, "ab"), (92.5, 10, 5, "abcé"), (100, 30, 20_000, "ab"),
     (40, 5, 4, "abcdef")],
)
def test_similar_names_against_brute_force(spark, threshold, days, cell_rows, letters):
    rows = random_people(int(threshold), 220, letters)
    golden = people(spark, rows)
    found = matching.similar_name_matches(golden, threshold, days, cell_rows=cell_rows).collect()
    pairs = sorted(
        (r["left_employee_id"], r["right_employee_id"], r["name_similarity_score"],
         r["hire_date_gap_days"])
        for r in found
    )
    assert pairs == expected_similar(rows, threshold, days)
    assert pairs


def test_long_names(spark):
    base = "x" * 30 + " " + "y" * 45
    rows = [
        ("A-1", "AcquiredCo", base, None, DAY),
        ("G-1", "GlobalTech", base.replace("xxxx", "xzx", 1), None, DAY),
        ("G-2", "GlobalTech", "z" * 76, None, DAY),
    ]
    found = matching.similar_name_matches(people(spark, rows)).collect()
    assert [(r["right_employee_id"], r["name_similarity_score"]) for r in found] == [
        ("G-1", score(rows[0][2], rows[1][2]))
    ]


def test_hire_date_limits(spark):
    """The same-name window counts floored days, the similar-name window exact time."""
    half = dt.timedelta(days=30, hours=12)
    rows = [
        ("A-1", "AcquiredCo", "Ann Lee", None, DAY),
        ("G-1", "GlobalTech", "Ann Lee", None, DAY + half),
        ("G-2", "GlobalTech", "Ann Lee", None, DAY - half),
        ("G-3", "GlobalTech", "Ann Lee", None, DAY + dt.timedelta(days=30)),
        ("G-4", "GlobalTech", "Ann Lee", None, DAY - dt.timedelta(days=30)),
        ("G-5", "GlobalTech", "Ann Lee", None, None),
        ("G-6", "GlobalTech", None, None, DAY),
    ]
    golden = people(spark, rows)
    same = {r["right_employee_id"] for r in matching.same_name_matches(golden).collect()}
    similar = {r["right_employee_id"] for r in matching.similar_name_matches(golden).collect()}
    assert same == {"G-2", "G-3", "G-4"}
    assert similar == {"G-3", "G-4"}


def test_one_name_for_a_third_of_all_rows(spark):
    rows = [
        (f"{c[:1]}-{i}", c, "Jo Doe" if i % 3 == 0 else f"Name {i}", None, DAY)
        for c in ("AcquiredCo", "GlobalTech")
        for i in range(90)
    ]
    found = matching.same_name_matches(people(spark, rows), cell_rows=7)
    jo = found.filter("left_full_name = 'Jo Doe'")
    assert jo.count() == 30 * 30
    assert jo.select("left_employee_id", "right_employee_id").distinct().count() == 30 * 30


def test_a_name_common_on_both_sides_is_spread_over_tasks(spark):
    """At the defaults, without help from a broadcast: no task gets most of the pairs."""
    n = 10_000
    side = spark.range(n).selectExpr("CAST(id div 100000 AS STRING) AS k", "id", "id % 7 AS x")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_pairs(
            side.withColumnRenamed("x", "a").withColumnRenamed("id", "left_id"),
            side.withColumnRenamed("x", "b").withColumnRenamed("id", "right_id"),
            ["k"], "left_id", "right_id", "a - b = 0 AND left_id % 50 = 0",
        )
        tasks = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    found = sorted(r["count"] for r in tasks)
    assert sum(found) == sum(len(range(i % 7, n, 7)) for i in range(0, n, 50))
    assert len(found) >= 6 and found[-1] <= sum(found) / 2


def test_probable_matches_keep_one_row_per_pair(spark):
    rows = [
        ("A-1", "AcquiredCo", "Ann Lee", "a@x", DAY),
        ("G-1", "GlobalTech", "Ann Lee", "g@x", DAY),
        ("G-2", "GlobalTech", "Lee Ann", None, DAY + dt.timedelta(days=2)),
    ]
    golden = people(spark, rows)
    both = matching.probable_matches(
        matching.same_name_matches(golden), matching.similar_name_matches(golden)
    )
    exported = export.match_export(both).orderBy("record_2_id")
    assert exported.columns == list(export.MATCH_EXPORT_COLUMNS)
    found = [
        (r["record_2_id"], r["match_type"], r["similarity_score"], r["hire_date_diff_days"],
         r["recommended_action"])
        for r in exported.collect()
    ]
    assert found == [
        ("G-1", matching.SAME_NAME, 100.0, 0, "HR_REVIEW"),
        ("G-2", matching.SIMILAR_NAME, 100.0, 2, "HR_REVIEW"),
    ]


@pytest.mark.parametrize("repeat", [None, "A-1", "G-2", ""])
def test_probable_matches_with_their_golden_table(spark, repeat):
    """Same rows as without it, also where an id comes twice or is missing twice."""
    rows = random_people(5, 60, letters="ab", length=4)
    rows += [(f"G-{i}x", "GlobalTech", n, None, d) for i, (_, _, n, _, d) in enumerate(rows[:20])]
    rows += [(None, "AcquiredCo", *rows[0][2:]), ("X-1", None, *rows[0][2:]), ("Z-1", "Zeta", *rows[0][2:])]
    if repeat is not None:
        for company, days in (("AcquiredCo", 0), ("AcquiredCo", 2), ("GlobalTech", 1), ("GlobalTech", 1)):
            rows.append((repeat or None, company, rows[0][2], None, rows[0][4] + dt.timedelta(days=days)))
    golden = people(spark, rows)
    for days in (3, 30):
        found = matching.same_name_matches(golden, days), matching.similar_name_matches(golden, 70, days)
        wanted = matching.probable_matches(*found)
        got = matching.probable_matches(*found, golden, days)
        assert got.columns == wanted.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
        assert 0 < got.count() < found[0].count() + found[1].count()
        assert ("Window" in got._jdf.queryExecution().toString()) == (repeat is not None)


@pytest.mark.parametrize("repeat", [None, "A-1", ""])
def test_sorted_matches_are_the_matches_in_order(spark, monkeypatch, repeat):
    """In lists of a few rows and tasks of a few pairs, with rows equal but for id and email."""
    monkeypatch.setattr(matching, "LIST_ROWS", 3)
    monkeypatch.setattr(matching, "FULL_TASK_PAIRS", 150)
    rows = random_people(5, 24, letters="ab", length=4)
    rows += [(f"{r[0]}-{i}", *r[1:3], None if i else "c@x", r[4]) for r in rows for i in range(5)]
    rows += [(f"G-{i}x", "GlobalTech", n, None, d) for i, (_, _, n, _, d) in enumerate(rows[:12])]
    rows += [(None, "AcquiredCo", *rows[0][2:]), ("X-1", None, *rows[0][2:]), ("Z-1", "Zeta", *rows[0][2:])]
    rows += [("X-2", "AcquiredCo", None, None, DAY), ("X-3", "GlobalTech", rows[0][2], None, None)]
    if repeat is not None:
        for company, days in (("AcquiredCo", 3), ("AcquiredCo", 2), ("GlobalTech", 1)):
            rows.append((repeat or None, company, rows[0][2], None, rows[0][4] + dt.timedelta(days=days)))
    golden = people(spark, rows)
    both = matching.same_name_matches(golden, 20), matching.similar_name_matches(golden, 70, 20)
    wanted = matching.probable_matches(*both, golden, 20)
    got = matching.sorted_matches(golden, 70, 20)
    assert got.columns == wanted.columns
    found = got.withColumn("_task", F.spark_partition_id()).collect()
    assert sorted(str(r[:-1]) for r in found) == sorted(str(tuple(r)) for r in wanted.collect())
    ids = [tuple(x or "" for x in (r["left_employee_id"], r["right_employee_id"])) for r in found]
    assert ids == sorted(ids) and len(ids) > 200
    if repeat is None:
        assert len(set(ids)) == len(ids) and len({r["_task"] for r in found}) >= 3


def test_sorted_matches_shuffle_lists_instead_of_pairs(spark, monkeypatch):
    """A hundred equal rows of either company make ten thousand pairs, and lists of ten rows."""
    monkeypatch.setattr(matching, "LIST_ROWS", 10)
    rows = [(f"{c[:1]}-{i:03d}", c, "Jo Doe", None, DAY) for c in ("AcquiredCo", "GlobalTech") for i in range(100)]
    got = matching.sorted_matches(people(spark, rows))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange rangepartitioning" not in plan and "Python" not in plan and "NestedLoop" not in plan
    assert len(got.collect()) == 100 * 100


def test_sink_of_matches_writes_all_pairs_in_few_bytes(spark, monkeypatch):
    """The file has every pair, in order, in a tenth of the two hundred bytes a plain line takes."""
    monkeypatch.setattr(matching, "TASK_PAIRS", 500)
    rows = [(f"{c[:1]}-{i:03d}", c, "Jo  Doe, \"x\"", f" {i}@x.com", DAY) for c in ("AcquiredCo", "GlobalTech") for i in range(40)]
    golden = people(spark, rows)
    monkeypatch.setattr(queries, "_people", lambda *_: golden)
    back = REGISTRY["q_sink_matches"](spark, "")
    files = sorted(f.removeprefix("file://") for f in back.inputFiles())
    assert len(files) >= 3 and all(f.endswith(".csv.gz") for f in files)
    lines = []
    for f in files:
        with gzip.open(f, "rt") as text:
            header, *of_file = text.read().splitlines()
        assert header.split(",") == list(export.MATCH_EXPORT_COLUMNS)
        lines += [tuple(line.split(",")[:2]) for line in of_file]
    assert lines == [(f"A-{i:03d}", f"G-{j:03d}") for i in range(40) for j in range(40)]
    assert sum(os.path.getsize(f) for f in files) < 20 * len(lines)
    wanted = REGISTRY["q_match_export"](spark, "")
    assert back.dtypes == wanted.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, wanted.collect()))


def test_no_people_no_matches(spark):
    golden = people(spark, [])
    both = matching.probable_matches(
        matching.same_name_matches(golden), matching.similar_name_matches(golden)
    )
    assert export.match_export(both).collect() == []


def test_no_people_no_sorted_matches(spark):
    found = matching.sorted_matches(people(spark, []))
    assert found.collect() == [] and export.match_export(found).columns == list(export.MATCH_EXPORT_COLUMNS)


def test_candidates_are_an_equi_join(spark):
    stage = Stage(spark)
    names = spark.createDataFrame([(1, "ann lee")], "_bucket int, _name string")
    plan = matching.similar_names(names, names, 88, stage)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scores_of_next_parts_are_spread_over_tasks(spark, tmp_path):
    rng = random.Random(8)
    rows = [(k, "".join(rng.choices("abc", k=rng.randint(1, 90))), "t" * rng.randint(1, 9), "Brand#1", k % 50) for k in range(200)]
    parts = spark.createDataFrame(rows, "p_partkey long, p_name string, p_type string, p_brand string, p_size int")
    parts.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    for name in ("q_token_sort_scores", "q_token_sort_long_texts"):
        found = REGISTRY[name](spark, str(tmp_path)).withColumn("_task", F.spark_partition_id()).collect()
        assert len(found) == 199
        sizes = [sum(r["_task"] == task for r in found) for task in {r["_task"] for r in found}]
        assert len(sizes) >= 3 and max(sizes) < 100  # the shuffles of this session have four tasks
    names = {k: name for k, name, *_ in rows}
    for r in REGISTRY["q_token_sort_scores"](spark, str(tmp_path)).collect():
        a, b = names[r["p_partkey"]], names[r["p_partkey"] + 1]
        assert (r["a"], r["b"], r["lcs"], r["score"]) == (a, b, lcs(a, b), score(a, b))
