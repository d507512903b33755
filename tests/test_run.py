import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rollbook.config import Settings
from rollbook.plans import build, sinks
from rollbook.operators.quality import QualityGateError
from rollbook.schema import GOLDEN_COLUMNS
from rollbook.sources.readers import SourceSpec

SETTINGS = Settings(as_of=dt.date(2024, 12, 31))


@pytest.fixture
def inputs(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    header = ("employee_id,first_name,last_name,email,department,job_title,hire_date,country,"
              "employment_type,manager_id\n")  # fmt: skip
    (raw / "a.csv").write_text(
        header
        + "1,ann,LEE,Ann@A.com,IT,Dev,2020-01-05,US,FT,\n"
        + "2,bob,RAY,shared@x.com,it,Dev,01/20/2021,US,pt,1.0\n"
        + "2,bob,RAY,shared@x.com,it,,01/20/2021,US,pt,1.0\n"
    )
    (raw / "b.json").write_text(
        json.dumps(
            {
                "employees": [
                    {
                        "employee_identifier": "ACQ_00001",
                        "name": {"first": "Ann", "last": "Lee", "full": "Ann Lee"},
                        "contact": {"email": "shared@x.com"},
                        "assignment": {
                            "department": "Engineering",
                            "role": "Dev",
                            "location": "UK",
                            "hire_timestamp": "2020-01-20T00:00:00Z",
                        },
                        "employment": {"type": "Full Time", "status": "active"},
                        "manager_employee_id": "ACQ_00001",
                    }
                ]
            }
        )
    )
    (raw / "pay.csv").write_text(
        "employee_id,source,base_salary,currency,pay_frequency,bonus_target_pct,effective_date\n"
        '1,GlobalTech,"$85,000",USD,Annual,5,2020-01-01\n'
        "ACQ_00001,AcquiredCo,100,EUR,Monthly,5,2020-01-01\n"
        "99,GlobalTech,1,USD,Annual,5,2020-01-01\n"
    )
    (raw / "ben.xml").write_text(
        "<e><enrollment><employee_id>1</employee_id>"
        "<enrollment_date>2020-02-01</enrollment_date></enrollment></e>"
    )
    (raw / "map.csv").write_text(
        "source_system,source_department,standard_department\n"
        "globaltech_hris,IT,Information Technology\n"
        "acquiredco_hris,Engineering,Engineering\n"
    )
    sources = {
        "globaltech_hris": SourceSpec(str(raw / "a.csv"), "csv"),
        "acquiredco_hris": SourceSpec(str(raw / "b.json"), "json"),
        "payroll": SourceSpec(str(raw / "pay.csv"), "csv"),
        "benefits": SourceSpec(str(raw / "ben.xml"), "xml"),
    }
    return sources, str(raw / "map.csv"), str(tmp_path / "out")


def read(spark, outputs, name):
    return spark.read.option("header", True).csv(outputs.report(name))


def test_full_run(spark, inputs):
    sources, mapping, out = inputs
    tables = build.run(spark, sources, mapping, out, SETTINGS)
    outputs = build.Outputs(out)

    golden = sinks.read_golden(spark, outputs.golden)
    assert set(golden.columns) == set(GOLDEN_COLUMNS)
    assert dict(golden.dtypes)["salary_original"] == "double"
    rows = {r["employee_id"]: r for r in golden.collect()}
    assert set(rows) == {"GT-000001", "GT-000002", "AC-000001"}
    ann = rows["GT-000001"]
    assert (ann["full_name"], ann["email"], ann["salary_original"]) == ("Ann Lee", "ann@a.com", 85000.0)
    assert ann["source_systems"] == "benefits|globaltech_hris|payroll"
    assert rows["GT-000002"]["manager_id"] == "GT-000001"
    assert rows["GT-000002"]["hire_date"] == dt.datetime(2021, 1, 20)
    assert rows["AC-000001"]["salary_usd_annual"] == 1296.0

    report = read(spark, outputs, "data_quality_validation_report.csv").collect()
    assert len(report) == 14
    assert [r["check"] for r in report if r["status"] == "FAIL"] == ["salary_usd_annual_range"]
    failures = read(spark, outputs, "salary_usd_annual_range_failures.csv").collect()
    assert [r["employee_id"] for r in failures] == ["AC-000001"]
    ghosts = read(spark, outputs, "ghost_employee_records.csv").collect()
    assert [(r["employee_id"], r["salary_original"]) for r in ghosts] == [("GT-000099", "1")]
    review = read(spark, outputs, "duplicate_hris_records.csv")
    assert review.count() == 2
    emails = read(spark, outputs, "duplicate_email_records.csv")
    assert emails.count() == 2
    matches = read(spark, outputs, "probable_match_review.csv").collect()
    assert [(r["record_1_id"], r["record_2_id"], r["hire_date_diff_days"]) for r in matches] == [
        ("AC-000001", "GT-000001", "15")
    ]
    # an empty table still has its header
    ids = read(spark, outputs, "duplicate_employee_id_records.csv")
    assert ids.columns == [*GOLDEN_COLUMNS, "duplicate_check"] and ids.count() == 0
    assert read(spark, outputs, "figures/tenure_distribution").count() == 30
    assert tables["golden"].count() == 3


def test_gate_stops_publication_but_leaves_the_report(spark, inputs):
    sources, mapping, out = inputs
    strict = Settings(as_of=SETTINGS.as_of, max_failed_checks=0)
    with pytest.raises(QualityGateError):
        build.run(spark, sources, mapping, out, strict)
    outputs = build.Outputs(out)
    assert read(spark, outputs, "data_quality_validation_report.csv").count() == 14
    assert read(spark, outputs, "salary_usd_annual_range_failures.csv").count() == 1
    with pytest.raises(FileNotFoundError):
        sinks.read_golden(spark, outputs.golden)


def test_a_run_that_dies_leaves_the_published_table(spark, inputs, monkeypatch):
    sources, mapping, out = inputs
    golden = build.run(spark, sources, mapping, out, SETTINGS)["golden"]
    path = build.Outputs(out).golden
    before = sorted(map(tuple, sinks.read_golden(spark, path).collect()), key=repr)

    # in the middle of the files
    broken = golden.withColumn("full_name", F.expr("IF(employee_id = 'GT-000002', raise_error('lost'), full_name)"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_golden(broken, path)
    assert sorted(map(tuple, sinks.read_golden(spark, path).collect()), key=repr) == before

    # and between the files and the list of versions
    with monkeypatch.context() as patched:
        patched.setattr(sinks, "_PUBLISHED", "no schema")
        with pytest.raises(Exception):
            sinks.write_golden(golden.limit(1), path)
    assert sorted(map(tuple, sinks.read_golden(spark, path).collect()), key=repr) == before

    sinks.write_golden(golden.limit(1), path)
    assert sinks.read_golden(spark, path).count() == 1
    versions = [sinks.write_golden(golden, path) for _ in range(3)]
    assert sinks.read_golden(spark, path).count() == 3
    # the last two are kept
    assert spark.read.parquet(f"{path}/versions/{versions[1]}").count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{path}/versions/{versions[0]}")


def test_run_goes_on_without_a_feed(spark, inputs, tmp_path):
    sources, mapping, out = inputs
    sources["payroll"] = SourceSpec(str(tmp_path / "gone.csv"), "csv")
    tables = build.run(spark, sources, mapping, out, SETTINGS)
    assert tables["golden"].filter("salary_usd_annual IS NOT NULL").count() == 0
    assert tables["golden"].count() == 3
