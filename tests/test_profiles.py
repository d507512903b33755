import datetime as dt
import random

import numpy as np
import pytest

from rollbook.operators import profiles

AS_OF = dt.date(2024, 12, 31)


def salaries_table(spark, groups):
    rows = [(kind, float(v)) for kind, values in groups.items() for v in values]
    return spark.createDataFrame(rows, "employment_type string, salary_usd_annual double")


@pytest.mark.parametrize("items, slack", [(4096, 0.002), (8, 0.0)])
def test_salary_box_against_numpy(spark, monkeypatch, items, slack):
    """Also where the sketches are so small that their brackets miss."""
    monkeypatch.setattr(profiles, "SKETCH_ITEMS", items)
    monkeypatch.setattr(profiles, "RANK_SLACK", slack)
    rng = random.Random(3)
    groups = {
        "Full-Time": [round(rng.lognormvariate(11, 1), 2) for _ in range(501)],
        "Part-Time": [round(rng.uniform(-500, 90000), 2) for _ in range(98)],
        "Contractor": [1, 2, 3, 1000],
        "One": [5.55],
        "Same": [7.0] * 9,
        "Two": [0.01, 0.02],
    }
    table = salaries_table(spark, groups)
    nothing = spark.createDataFrame([(None, 1.0), ("Full-Time", None)], table.schema)
    found = {r["employment_type"]: r for r in profiles.salary_box(table.union(nothing)).collect()}
    assert set(found) == set(groups)
    for kind, values in groups.items():
        x = np.array(values)
        q1, median, q3 = np.percentile(x, [25, 50, 75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = x[(x >= low) & (x <= high)]
        row = found[kind]
        want = (q1, median, q3, min(inside.min(), q1), max(inside.max(), q3))
        have = [row[c] for c in ("q1", "median", "q3", "whisker_low", "whisker_high")]
        assert have == pytest.approx(want, abs=1e-6)
        assert (row["employee_count"], row["outlier_count"]) == (len(x), len(x) - len(inside))


def test_salary_box_of_many_types_and_large_amounts(spark):
    groups = {f"type {i}": [i, i + 1.5, i + 4] for i in range(1200)}
    groups["large"] = [50_000, 60_000, 70_000, 2e16, 1e17]
    found = {r["employment_type"]: r for r in profiles.salary_box(salaries_table(spark, groups)).collect()}
    assert len(found) == 1201
    assert (found["type 7"]["q1"], found["type 7"]["median"]) == (7.75, 8.5)
    assert (found["large"]["median"], found["large"]["q3"]) == (70_000, 2e16)
    assert found["large"]["outlier_count"] == 1


def test_salary_box_of_amounts_beyond_decimals(spark):
    groups = {"a": [1.0, 2.0, 1e28], "b": [1.0, 2.0, 3.0, 1e300, -1e300], "c": [5e-324, 1.7e308]}
    found = {r["employment_type"]: r for r in profiles.salary_box(salaries_table(spark, groups)).collect()}
    assert {k: r["employee_count"] for k, r in found.items()} == {"a": 3, "b": 5, "c": 2}
    # the median and the quartile above it lie between 2 and 1e28
    assert (found["a"]["median"], found["a"]["q3"], found["a"]["outlier_count"]) == (2.0, 5e27, 0)
    assert (found["b"]["q1"], found["b"]["median"], found["b"]["q3"], found["b"]["outlier_count"]) == (1.0, 2.0, 3.0, 2)
    many = {"d": [float(i) for i in range(100)] + [1e28]}
    row = profiles.salary_box(salaries_table(spark, many)).first()
    assert (row["employee_count"], row["median"], row["outlier_count"], row["whisker_high"]) == (101, 50.0, 1, 99.0)


def test_tenure_histogram_against_numpy(spark):
    rng = random.Random(4)
    dates = [
        dt.datetime(2000, 1, 1) + dt.timedelta(days=rng.randint(0, 9000), hours=rng.choice([0, 9]))
        for _ in range(700)
    ]
    table = spark.createDataFrame([(d,) for d in dates] + [(None,)], "hire_date timestamp_ntz")
    found = profiles.tenure_histogram(table, AS_OF).collect()
    today = dt.datetime(2024, 12, 31)
    counts, edges = np.histogram([(today - d).days / 365.25 for d in dates], bins=30)
    assert [r["employee_count"] for r in found] == list(counts)
    assert [r["bin"] for r in found] == list(range(30))
    assert [r["from_years"] for r in found] == pytest.approx(edges[:-1], abs=1e-6)
    assert [r["to_years"] for r in found] == pytest.approx(edges[1:], abs=1e-6)


def test_tenure_histogram_of_one_day_and_of_nothing(spark):
    day = dt.datetime(2020, 1, 1)
    table = spark.createDataFrame([(day,), (day,)], "hire_date timestamp_ntz")
    found = profiles.tenure_histogram(table, AS_OF).collect()
    counts, _ = np.histogram([(dt.datetime(2024, 12, 31) - day).days / 365.25] * 2, bins=30)
    assert [r["employee_count"] for r in found] == list(counts)
    assert profiles.tenure_histogram(table.limit(0), AS_OF).collect() == []


def test_headcounts_and_rates(spark):
    rows = [("IT", "US", True), ("IT", "US", None), ("HR", "UK", False), (None, None, True)]
    table = spark.createDataFrame(
        rows, "department_standardized string, country string, benefits_enrolled boolean"
    )
    departments = [tuple(r) for r in profiles.headcount_by_department(table).collect()]
    assert departments == [("HR", 1), ("Unknown", 1), ("IT", 2)]
    countries = [tuple(r) for r in profiles.headcount_by_country(table, 2).collect()]
    assert countries == [("UK", 1), ("US", 2)]
    rates = [tuple(r) for r in profiles.benefits_rate_by_department(table).collect()]
    assert rates == [("HR", 0.0), ("IT", 0.5)]
