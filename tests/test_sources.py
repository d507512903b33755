import json

import pytest

from rollbook.schema import ALIGNED_SCHEMA, CANONICAL_COLUMNS, conform
from rollbook.sources import align, readers
from rollbook.sources.readers import SourceSpec

PERSON = {
    "employee_identifier": "ACQ_00007",
    "name": {"first": "Ann", "last": "Lee", "full": "Ann Lee"},
    "contact": {"email": "A@x.com"},
    "assignment": {
        "department": "IT",
        "role": "Dev",
        "location": "UK",
        "hire_timestamp": "2020-01-05T00:00:00Z",
    },
    "employment": {"type": "FT", "status": "active"},
    "manager_employee_id": None,
}


def write(tmp_path, name, content):
    path = tmp_path / name
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_csv_by_header_name_with_missing_texts(spark, tmp_path):
    path = write(
        tmp_path,
        "hris.csv",
        "first_name,employee_id,extra,last_name,email\n"
        '"Ann, ""A""",007,x,NA,\n'
        "Élodie,2,y,Null Island,e@x.com\n",
    )
    df = readers.read_csv_identity(spark, path)
    assert df.columns == [*readers.CSV_IDENTITY_SCHEMA.names, "source_system"]
    rows = df.orderBy("employee_id").collect()
    assert (rows[0]["employee_id"], rows[0]["first_name"]) == ("007", 'Ann, "A"')
    assert (rows[0]["last_name"], rows[0]["email"], rows[0]["country"]) == (None, None, None)
    assert (rows[1]["first_name"], rows[1]["last_name"]) == ("Élodie", "Null Island")
    assert {r["source_system"] for r in rows} == {"globaltech_hris"}


@pytest.mark.parametrize(
    "document, ids",
    [
        ({"employees": [PERSON, {"employee_identifier": "2", "name": "not an object"}]},
         ["2", "ACQ_00007"]),
        ([PERSON, {"employee_identifier": "3"}], ["3", "ACQ_00007"]),
        ({"employees": []}, []),
        ({"staff": [PERSON]}, []),
        ([], []),
        (5, []),
    ],
)
def test_json_document_shapes(spark, tmp_path, document, ids):
    path = write(tmp_path, "hris.json", json.dumps(document, indent=1))
    df = readers.read_json_identity(spark, path)
    assert sorted(r["employee_identifier"] for r in df.collect()) == ids


def test_json_malformed_document_gives_no_rows(spark, tmp_path):
    write(tmp_path, "a.json", '{"employees": [{"employee_identifier": ')
    write(tmp_path, "b.json", json.dumps([PERSON]))
    assert readers.read_json_identity(spark, str(tmp_path)).count() == 1


def test_json_lines_of_records_and_of_pages(spark, tmp_path):
    lines = [PERSON, {"employees": [PERSON, PERSON]}]
    path = write(tmp_path, "hris.jsonl", "\n".join(map(json.dumps, lines)) + "\nbroken\n")
    assert readers.read_json_identity(spark, path, lines=True).count() == 3


def test_xml_rows_at_any_depth_stay_text(spark, tmp_path):
    path = write(
        tmp_path,
        "benefits.xml",
        "<root><enrollment><employee_id>007</employee_id><plan_type>A</plan_type></enrollment>"
        "<group><inner><enrollment><employee_id>8</employee_id>"
        "<enrollment_date>2020-01-01</enrollment_date></enrollment></inner></group></root>",
    )
    rows = readers.read_benefits(spark, path).orderBy("employee_id").collect()
    assert [r["employee_id"] for r in rows] == ["007", "8"]
    assert [r["enrollment_date"] for r in rows] == [None, "2020-01-01"]


def test_payroll_from_csv_and_parquet(spark, tmp_path):
    text = "employee_id,source,base_salary,currency,pay_frequency,effective_date\n"
    path = write(tmp_path, "payroll.csv", text + '1,GlobalTech,"$85,000",USD,Annual,2020-01-01\n')
    from_csv = readers.read_payroll(spark, path)
    stored = str(tmp_path / "payroll.parquet")
    from_csv.drop("source_system").selectExpr("CAST(employee_id AS DOUBLE) employee_id",
                                              "source", "base_salary").write.parquet(stored)
    from_parquet = readers.read_payroll(spark, stored, "parquet")
    assert from_csv.columns == from_parquet.columns
    assert from_csv.first()["base_salary"] == "$85,000"
    spec = align.ALIGN_SPECS["payroll"]
    assert align.align(from_parquet, spec).first()["employee_id"] == "1.0"


def test_missing_files_give_empty_frames_of_the_right_shape(spark, tmp_path):
    gone = str(tmp_path / "gone")
    frames = readers.load_sources(
        spark,
        {
            "globaltech_hris": SourceSpec(gone, "csv"),
            "acquiredco_hris": SourceSpec(gone, "json"),
            "payroll": SourceSpec(gone, "parquet"),
            "benefits": SourceSpec(gone, "xml"),
            "unknown": SourceSpec(gone, "csv"),
        },
    )
    assert list(frames) == ["globaltech_hris", "acquiredco_hris", "payroll", "benefits"]
    for df in align.align_sources(frames).values():
        assert df.schema.names == list(CANONICAL_COLUMNS) and df.count() == 0
    assert readers.read_department_mapping(spark, gone).count() == 0


def test_department_mapping_needs_its_columns(spark, tmp_path):
    path = write(tmp_path, "map.csv", "source_system,department\na,b\n")
    with pytest.raises(ValueError, match="source_department"):
        readers.read_department_mapping(spark, path)


def test_conform_adds_drops_and_orders(spark):
    df = spark.createDataFrame([("x", 1.5e9, 1)], "extra string, employee_id double, manager_id int")
    out = conform(df)
    assert out.schema.names == ALIGNED_SCHEMA.names
    row = out.first()
    assert (row["employee_id"], row["manager_id"], row["email"]) == ("1500000000.0", "1", None)


def test_alignment_of_nested_records(spark, tmp_path):
    path = write(tmp_path, "hris.json", json.dumps([PERSON]))
    raw = {"acquiredco_hris": readers.read_json_identity(spark, path), "other": spark.range(1)}
    aligned = align.align_sources(raw)
    assert list(aligned) == ["acquiredco_hris"]
    row = aligned["acquiredco_hris"].first()
    assert row["employee_id"] == row["source_employee_id"] == "ACQ_00007"
    assert (row["company_origin"], row["full_name"], row["country"]) == ("AcquiredCo", "Ann Lee", "UK")
    assert row["jurisdiction"] is None


def test_csv_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("employee_id,first_name,last_name\n1,Ann,Lee\n")
    (tmp_path / "b.csv").write_text("first_name,employee_id,last_name\nBob,2,Ray\n")
    (tmp_path / "c.csv").write_text("employee_id,first_name,last_name\n3,Cy,Fox\n")
    found = readers.read_csv_identity(spark, str(tmp_path)).select("employee_id", "first_name", "last_name")
    assert sorted(tuple(r) for r in found.collect()) == [("1", "Ann", "Lee"), ("2", "Bob", "Ray"), ("3", "Cy", "Fox")]


def test_csv_values_with_line_breaks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('employee_id,first_name,last_name\n1,"Ann\nMarie",Lee\n')
    spec = readers.SourceSpec(str(path), "csv", multi_line=True)
    rows = readers.load_sources(spark, {"globaltech_hris": spec})["globaltech_hris"].collect()
    assert [(r["employee_id"], r["first_name"], r["last_name"]) for r in rows] == [("1", "Ann\nMarie", "Lee")]


def test_unknown_formats_are_refused(spark):
    with pytest.raises(ValueError, match="parquet"):
        readers.load_sources(spark, {"globaltech_hris": readers.SourceSpec("x", "parquet")})


def test_malformed_json_lines_are_listed(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('{"employee_identifier": "1"}\n{"employee_identifier": \n{"employee_identifier": "3"}\n')
    sources = {"acquiredco_hris": readers.SourceSpec(str(path), "json_lines")}
    rows = readers.load_sources(spark, sources)["acquiredco_hris"].collect()
    assert [r["employee_identifier"] for r in rows] == ["1", "3"]
    rejected = readers.malformed_records(spark, sources).collect()
    assert [(r["source_system"], r["reason"], r["record"]) for r in rejected] == [
        ("acquiredco_hris", "unreadable", '{"employee_identifier": ')
    ]
    assert rejected[0]["file"].endswith("/a.json")


ODD_PEOPLE = [
    {"employee_identifier": "1", "name": "Bob"},
    {"employee_identifier": "2", "name": ["x"], "contact": 5, "assignment": None, "employment": True},
    {"employee_identifier": 3, "name": {"first": {"a": 1}, "last": 1.5}, "contact": {"email": None}},
]
ODD_ROWS = [("1", None, None), ("2", None, None), ("3", '{"a":1}', "1.5")]


@pytest.mark.parametrize("form", ["lines", "line of a page", "document", "list"])
def test_json_records_of_any_shape_stay(spark, tmp_path, form):
    text = {
        "lines": "\n".join(map(json.dumps, ODD_PEOPLE)),
        "line of a page": json.dumps({"employees": ODD_PEOPLE}),
        "document": json.dumps({"employees": ODD_PEOPLE}, indent=1),
        "list": json.dumps(ODD_PEOPLE, indent=1),
    }[form]
    path = write(tmp_path, "people.json", text)
    lines = form.startswith("line")
    people = readers.read_json_identity(spark, path, lines=lines)
    rows = people.select("employee_identifier", "name.first", "name.last").collect()
    assert sorted(tuple(r) for r in rows) == ODD_ROWS
    # the same records whatever columns are asked for
    assert people.count() == len([r for r in people.select("contact.email").collect()]) == 3
    spec = {"acquiredco_hris": SourceSpec(path, "json_lines" if lines else "json")}
    assert readers.malformed_records(spark, spec).count() == 0


def test_json_elements_that_are_no_records_are_listed(spark, tmp_path):
    path = write(tmp_path, "people.json", json.dumps({"employees": [PERSON, 5, None, ["x"], "y"]}))
    spec = {"acquiredco_hris": SourceSpec(path, "json")}
    assert readers.load_sources(spark, spec)["acquiredco_hris"].count() == 1
    rows = readers.malformed_records(spark, spec).collect()
    assert sorted((r["reason"], r["record"]) for r in rows) == [("not a record", t) for t in ('"y"', "5", '["x"]', "null")]


def test_csv_rows_that_do_not_fit_their_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'employee_id,first_name,last_name\n1,Ann\n2,Bob,Lee,EXTRA\n3,"Cy,Fox\n4,"a ""q"", b",Z\n5,x,\n\n6,x,y,\n'
    )
    (tmp_path / "b.csv").write_text("last_name,employee_id\nRay,7\nRay\n")
    spec = {"globaltech_hris": SourceSpec(str(tmp_path), "csv")}
    feed = readers.load_sources(spark, spec)["globaltech_hris"]
    rows = feed.select("employee_id", "first_name", "last_name").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(
        [("1", "Ann", None), ("3", "Cy,Fox", None), ("4", 'a "q", b', "Z"), ("5", "x", None), ("7", None, "Ray"), (None, None, "Ray")],
        key=repr,
    )
    assert feed.count() == feed.select("source_system").count() == len(rows)
    listed = readers.malformed_records(spark, spec).collect()
    assert sorted((r["file"][-5:], r["reason"], r["record"]) for r in listed) == [
        ("a.csv", "open quote", '3,"Cy,Fox'), ("a.csv", "too few values", "1,Ann"),
        ("a.csv", "too many values", "2,Bob,Lee,EXTRA"), ("a.csv", "too many values", "6,x,y,"),
        ("b.csv", "too few values", "Ray"),
    ]
    assert readers.malformed_records(spark, spec).groupBy("reason").count().count() == 3


def test_missing_files_list_nothing(spark, tmp_path):
    gone = str(tmp_path / "gone")
    spec = {n: SourceSpec(gone, f) for n, f in (("globaltech_hris", "csv"), ("acquiredco_hris", "json"), ("benefits", "xml"))}
    assert readers.malformed_records(spark, spec).count() == 0


def test_rejected_values_are_counted(spark):
    import datetime as dt

    from rollbook.config import Settings
    from rollbook.operators import clean
    from rollbook.schema import conform

    rows = [
        ("GlobalTech", "1", "intern", "soon", "tbd", "JPY", "weekly"),
        ("GlobalTech", "none", " intern ", "2999-01-01", "$5", "usd", "Annual"),
        ("Other", "7", "FT", " ", None, None, None),
    ]
    names = "company_origin employee_id employment_type hire_date salary_original currency pay_frequency".split()
    aligned = conform(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).selectExpr("*", "'x' AS source_system"))
    got = clean.rejected_values(aligned, Settings(as_of=dt.date(2024, 12, 31))).collect()
    assert {tuple(r)[1:] for r in got} == {
        ("employee_id", "no digits", "none", 1), ("employee_id", "unknown company", "7", 1),
        ("employment_type", "unknown", "intern", 2), ("hire_date", "unparsed", "soon", 1),
        ("hire_date", "out of range", "2999-01-01", 1), ("salary_original", "unparsed", "tbd", 1),
        ("currency", "unknown", "JPY", 1), ("pay_frequency", "unknown", "weekly", 1),
    }
