import datetime as dt

import pytest

from rollbook.config import Settings
from rollbook.operators import quality
from rollbook.operators.quality import ReferenceRule, RowRule, UniqueRule, Validator

SETTINGS = Settings(as_of=dt.date(2024, 12, 31))
SCHEMA = (
    "employee_id string, full_name string, email string, company_origin string, "
    "employment_type string, department_standardized string, hire_date timestamp_ntz, "
    "salary_usd_annual double, manager_id string, benefits_enrolled boolean"
)
GOOD = ("GT-000001", "Ann Lee", "a@x.com", "GlobalTech", "Full-Time", "IT",
        dt.datetime(2020, 1, 1), 50000.0, None, True)
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def rows(spark, *changes):
    data = [tuple(change.get(c, v) for c, v in zip(COLUMNS, GOOD)) for change in changes]
    return spark.createDataFrame(data, SCHEMA)


def failing(spark, *changes):
    report = Validator(settings=SETTINGS).run(rows(spark, *changes)).collect()
    assert all(r["passed"] + r["failed"] == r["total"] == len(changes) for r in report)
    return {r["check"]: r["failed"] for r in report if r["status"] == "FAIL"}


def test_fourteen_rules_pass_on_a_good_row(spark):
    report = Validator(settings=SETTINGS).run(rows(spark, {}))
    assert tuple(report.columns) == quality.REPORT_COLUMNS
    found = report.collect()
    assert [r["check"] for r in found] == [r.name for r in quality.standard_rules()]
    assert {(r["total"], r["pass_rate"], r["status"]) for r in found} == {(1, 100.0, "PASS")}
    assert len(found) == 14


@pytest.mark.parametrize(
    "change, broken",
    [
        ({"employee_id": None}, {"employee_id_not_null", "employee_id_format"}),
        ({"employee_id": "GT-1234567"}, {"employee_id_format"}),
        ({"employee_id": "XX-000001"}, {"employee_id_format"}),
        ({"full_name": None}, {"full_name_not_null"}),
        ({"email": None}, {"email_not_null", "email_format"}),
        ({"email": "a@b"}, {"email_format"}),
        ({"email": "a b@c.d"}, {"email_format"}),
        ({"company_origin": None}, {"company_origin_allowed"}),
        ({"company_origin": "Other"}, {"company_origin_allowed"}),
        ({"employment_type": None}, set()),
        ({"employment_type": "Intern"}, {"employment_type_allowed"}),
        ({"department_standardized": None}, {"department_standardized_not_null"}),
        ({"hire_date": None}, {"hire_date_not_null", "hire_date_plausible_range"}),
        ({"hire_date": dt.datetime(1989, 12, 31)}, {"hire_date_plausible_range"}),
        ({"hire_date": dt.datetime(1990, 1, 1)}, set()),
        ({"hire_date": dt.datetime(2024, 12, 31)}, set()),
        ({"hire_date": dt.datetime(2025, 1, 1)}, {"hire_date_plausible_range"}),
        ({"salary_usd_annual": None}, set()),
        ({"salary_usd_annual": 20000.0}, set()),
        ({"salary_usd_annual": 19999.99}, {"salary_usd_annual_range"}),
        ({"salary_usd_annual": 2000000.01}, {"salary_usd_annual_range"}),
        ({"manager_id": "GT-000001"}, set()),
        ({"manager_id": "GT-000002"}, {"manager_id_referential_integrity"}),
        ({"benefits_enrolled": None}, {"benefits_enrolled_boolean"}),
    ],
)
def test_each_rule(spark, change, broken):
    assert set(failing(spark, change)) == broken


def test_uniqueness_counts_every_row_of_a_repeated_id(spark):
    failed = failing(spark, {}, {}, {"employee_id": None}, {"employee_id": None},
                     {"employee_id": "GT-000009"})
    assert failed["employee_id_unique"] == 4


def test_empty_table_passes_with_rate_zero(spark):
    report = Validator(settings=SETTINGS).run(rows(spark).limit(0)).collect()
    assert {(r["total"], r["pass_rate"], r["status"]) for r in report} == {(0, 0.0, "PASS")}


def test_pass_rate_is_rounded_half_up(spark):
    table = spark.range(18001).selectExpr("id < 14997 AS ok")
    rule = RowRule("r", "d", "ok")
    assert Validator([rule]).run(table).first()["pass_rate"] == 83.31
    table = spark.range(800).selectExpr("id < 1 AS ok")
    assert Validator([rule]).run(table).first()["pass_rate"] == 0.13


def test_gate_allows_two_failed_rules(spark):
    validator = Validator(settings=SETTINGS)
    two = validator.run(rows(spark, {"salary_usd_annual": 1.0, "manager_id": "x"}))
    validator.gate(two)
    three = validator.run(
        rows(spark, {"salary_usd_annual": 1.0, "manager_id": "x", "full_name": None})
    )
    with pytest.raises(quality.QualityGateError, match="3 checks failed.*full_name_not_null"):
        validator.gate(three)


@pytest.mark.parametrize("heavy", [0, 1, 1000])
def test_failed_rows(spark, heavy):
    table = rows(
        spark,
        {"employee_id": "GT-000001"},
        {"employee_id": "GT-000001", "manager_id": "GT-000404"},
        {"employee_id": "GT-000002", "manager_id": "GT-000404", "salary_usd_annual": 1.0},
        {"employee_id": None, "manager_id": "GT-000001"},
    )
    validator = Validator(settings=SETTINGS)

    def ids(check):
        failed = validator.failed_rows(table, check, heavy)
        assert failed.columns == [*COLUMNS, "failed_check", "failed_check_description"]
        return sorted(str(r["employee_id"]) for r in failed.collect())

    assert ids("salary_usd_annual_range") == ["GT-000002"]
    assert ids("employee_id_format") == ["None"]
    assert ids("employee_id_unique") == ["GT-000001", "GT-000001"]
    assert ids("manager_id_referential_integrity") == ["GT-000001", "GT-000002"]
    with pytest.raises(ValueError, match="unknown validation check"):
        validator.failed_rows(table, "nothing")


def test_own_rules(spark):
    table = spark.createDataFrame([(1, None), (2, 1), (2, 9)], "id int, parent int")
    rules = [
        UniqueRule("u", "unique", "id"),
        ReferenceRule("p", "parent exists", "parent", "id"),
        RowRule("r", "small", "id < 2"),
    ]
    report = Validator(rules).run(table).collect()
    assert [(r["check"], r["passed"], r["failed"]) for r in report] == [
        ("u", 1, 2), ("p", 2, 1), ("r", 1, 2),
    ]
