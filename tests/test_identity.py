import datetime as dt

import pytest

from rollbook.operators import clean, duplicates, identity
from rollbook.schema import CLEANED_SCHEMA, GOLDEN_COLUMNS, IDENTITY_COLUMNS

D = dt.datetime


def frame(spark, rows):
    """Cleaned records from partial dicts; ``row_ord`` follows the list order."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CLEANED_SCHEMA)
    data = [
        (*[r.get(c) for c in CLEANED_SCHEMA.names], i) for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(data, f"{schema}, row_ord bigint")


def person(id, source="globaltech_hris", **more):
    company = "AcquiredCo" if source == "acquiredco_hris" else "GlobalTech"
    return {"employee_id": id, "source_system": source, "company_origin": company, **more}


def pay(id, **more):
    return person(id, "payroll", **more)


def enrolled(id, date=None):
    return person(id, "benefits", benefits_enrolled=True, benefits_enrollment_date=date)


@pytest.fixture(scope="module")
def combined(spark):
    return frame(
        spark,
        [
            person("GT-000001", full_name="Ann", email="a@x.com"),
            person("GT-000001", full_name="Ann", email="a@x.com", country="US"),
            person("GT-000001", full_name="Ann", email="a@x.com", country="US", hire_date=None),
            person("GT-000002", full_name="Bob", job_title="first"),
            person("GT-000002", full_name="Bob", job_title="second"),
            person("AC-000001", "acquiredco_hris", full_name="Cy"),
            person(None, full_name="No Id"),
            person(None, full_name="No Id", email="n@x.com"),
            pay("GT-000001", salary_original="1", compensation_effective_date=D(2020, 1, 1)),
            pay("GT-000001", salary_original="2", compensation_effective_date=D(2021, 1, 1)),
            pay("GT-000001", salary_original="3", compensation_effective_date=D(2021, 1, 1)),
            pay("GT-000001", salary_original="4"),
            pay("GT-000009", salary_original="5"),
            pay(None, salary_original="6"),
            enrolled("GT-000001", D(2019, 5, 1)),
            enrolled("GT-000001", D(2018, 5, 1)),
            enrolled("GT-000001"),
            enrolled("GT-000008"),
            enrolled(None),
        ],
    )


def by(rows, *columns):
    return sorted(tuple(r[c] for c in columns) for r in rows)


def test_survivor_is_fullest_then_first(spark, combined):
    kept = identity.surviving_identities(identity.identity_records(combined))
    assert kept.columns == list(IDENTITY_COLUMNS)
    rows = {r["employee_id"]: r for r in kept.collect()}
    assert set(rows) == {"GT-000001", "GT-000002", "AC-000001", None}
    assert rows["GT-000001"]["country"] == "US"
    assert rows["GT-000002"]["job_title"] == "first"
    assert rows[None]["email"] == "n@x.com"


@pytest.mark.parametrize("heavy", [0, 1, 1000])
def test_duplicate_review_marks_rows_equal_to_the_survivor(combined, heavy):
    records = identity.identity_records(combined)
    review = identity.duplicate_identity_review(records, heavy)
    assert review.columns == [*IDENTITY_COLUMNS, "duplicate_check", "kept_in_golden", "is_survivor"]
    rows = review.collect()
    assert len(rows) == 7
    kept = [(r["employee_id"], r["email"], r["kept_in_golden"]) for r in rows]
    assert kept.count(("GT-000001", "a@x.com", True)) == 3
    assert (None, "n@x.com", True) in kept and (None, None, False) in kept


def test_golden(combined):
    golden = identity.golden_records(combined)
    assert golden.columns == list(GOLDEN_COLUMNS)
    rows = {r["employee_id"]: r for r in golden.collect()}
    assert set(rows) == {"GT-000001", "GT-000002", "AC-000001", None}
    ann = rows["GT-000001"]
    assert ann["salary_original"] == "2"
    assert ann["benefits_enrolled"] is True
    assert ann["benefits_enrollment_date"] == D(2018, 5, 1)
    assert ann["source_systems"] == "benefits|globaltech_hris|payroll"
    assert ann["dedup_method"] == "exact_employee_id"
    bob = rows["GT-000002"]
    assert (bob["benefits_enrolled"], bob["source_systems"]) == (False, "globaltech_hris")
    nobody = rows[None]
    assert (nobody["salary_original"], nobody["benefits_enrolled"]) == (None, False)
    assert nobody["source_systems"] == "globaltech_hris"


def test_golden_equals_the_join_of_its_parts(combined):
    """The one-pass aggregate against the summaries joined one by one."""
    records = identity.identity_records(combined)
    joined = (
        identity.surviving_identities(records)
        .join(identity.latest_payroll(combined), "employee_id", "left")
        .join(identity.benefits_summary(combined), "employee_id", "left")
        .join(identity.source_systems(combined), "employee_id", "left")
        .selectExpr(
            "*",
            "coalesce(benefits_enrolled, false) AS enrolled",
            "coalesce(source_systems, source_system) AS feeds",
        )
        .drop("benefits_enrolled", "source_systems")
        .withColumnsRenamed({"enrolled": "benefits_enrolled", "feeds": "source_systems"})
        .selectExpr("*", "'exact_employee_id' AS dedup_method")
        .select(*GOLDEN_COLUMNS)
    )
    golden = identity.golden_records(combined)
    assert golden.exceptAll(joined).isEmpty() and joined.exceptAll(golden).isEmpty()


def test_every_part_is_unique_and_checked(combined):
    for part in (
        identity.golden_records(combined),
        identity.latest_payroll(combined),
        identity.benefits_summary(combined),
        identity.source_systems(combined),
    ):
        rows, seen = identity.observed_unique(part, "employee_id")
        assert rows.columns == part.columns
        rows.write.format("noop").mode("overwrite").save()
        identity.assert_unique(seen, "employee_id", "part")
        assert identity.repeated_keys(part, "employee_id").isEmpty()
    rows, seen = identity.observed_unique(combined, "employee_id")
    rows.write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError, match="combined contains duplicate employee_id"):
        identity.assert_unique(seen, "employee_id", "combined")


def test_golden_needs_no_second_shuffle_for_the_check(combined):
    rows, _ = identity.observed_unique(identity.golden_records(combined), "employee_id")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_exactly_one_row_of_an_id_is_the_survivor(spark, combined):
    records = identity.identity_records(combined)
    copies = records.unionByName(records).unionByName(records.limit(7)).drop("row_ord")
    review = identity.duplicate_identity_review(copies)
    per_id = review.groupBy("employee_id").agg({"*": "count", "employee_id": "max"}).count()
    marked = review.filter("is_survivor")
    assert marked.count() == marked.select("employee_id").distinct().count() == per_id
    assert review.count() == copies.count()
    best = identity.surviving_identities(copies)
    assert marked.select(best.columns).exceptAll(best).isEmpty()
    assert review.filter("is_survivor AND NOT kept_in_golden").isEmpty()


@pytest.mark.parametrize("heavy", [0, 1, 1000])
def test_ghosts_and_matched_enrichment_split_the_feeds(combined, heavy):
    ghosts = identity.ghost_records(combined, heavy)
    matched = identity.matched_enrichment(combined, heavy)
    assert ghosts.columns == list(CLEANED_SCHEMA.names)
    found = [(r["employee_id"], r["source_system"]) for r in ghosts.collect()]
    assert sorted(found, key=str) == sorted(
        [("GT-000009", "payroll"), (None, "payroll"), ("GT-000008", "benefits"), (None, "benefits")],
        key=str,
    )
    assert matched.count() == 7
    both = ghosts.unionByName(matched)
    feeds = identity.enrichment_records(combined).drop("row_ord")
    assert both.exceptAll(feeds).isEmpty() and feeds.exceptAll(both).isEmpty()


def test_ties_do_not_depend_on_input_order(spark):
    rows = [
        pay("GT-000001", salary_original=str(i), compensation_effective_date=D(2020, 1, 1))
        for i in range(20)
    ]
    picks = set()
    for order in (rows, rows[::-1]):
        feed = frame(spark, order).drop("row_ord").repartition(5)
        picks.add(identity.latest_payroll(feed).first()["salary_original"])
    assert len(picks) == 1


def test_duplicate_ids_and_emails(spark):
    golden = frame(
        spark,
        [
            person("GT-000001", email="same@x.com"),
            person("AC-000001", "acquiredco_hris", email="same@x.com"),
            person("GT-000002", email="one@x.com"),
            person("GT-000003", email="one@x.com"),
            person("GT-000003", email=None),
            person(None),
            person(None),
        ],
    ).drop("row_ord")
    for heavy in (0, 1, 1000):
        emails = duplicates.duplicate_emails(golden, heavy).collect()
        assert by(emails, "employee_id", "duplicate_check") == [
            ("AC-000001", "cross_company_email"),
            ("GT-000001", "cross_company_email"),
        ]
        ids = duplicates.duplicate_ids(golden, heavy).collect()
        assert sorted(str(r["employee_id"]) for r in ids) == [
            "GT-000003", "GT-000003", "None", "None",
        ]
        assert {r["duplicate_check"] for r in ids} == {"employee_id"}


def test_a_third_of_all_rows_in_one_group(spark):
    """The largest group is joined where it lies; only the rest is shuffled."""
    rows = spark.range(30_000).selectExpr(
        "IF(id % 3 = 0, 'GT-000000', concat('GT-', id)) AS employee_id", "id AS v"
    )
    found = duplicates.duplicate_ids(rows)
    assert found.agg({"v": "sum"}).first()[0] == sum(range(0, 30_000, 3))
    assert found.count() == 10_000


def test_department_lookup(spark):
    people = frame(
        spark,
        [
            person("GT-000001", department=" it "),
            person("GT-000002", department="Skunk "),
            person("GT-000003"),
            person("AC-000001", "acquiredco_hris", department="IT"),
        ],
    )
    mapping = spark.createDataFrame(
        [(" GlobalTech_HRIS", "IT ", "Information Technology")],
        "source_system string, source_department string, standard_department string",
    )
    mapped = clean.map_departments(people, mapping)
    assert mapped.columns == people.columns
    assert by(mapped.filter("department_standardized is not null").collect(),
              "employee_id", "department_standardized") == [
        ("GT-000001", "Information Technology")
    ]
    unknown = clean.unmapped_departments(people, mapping).collect()
    assert [tuple(r) for r in unknown] == [("acquiredco_hris", "IT"), ("globaltech_hris", "Skunk")]
    assert clean.map_departments(people, mapping.limit(0)).count() == 4
    with pytest.raises(Exception, match="department mapping repeats globaltech_hris/it"):
        clean.map_departments(people, mapping.union(mapping)).collect()
