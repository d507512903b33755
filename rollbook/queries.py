"""Every operator as a query over the test tables: (spark, folder) to DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook import fixtures
from rollbook.config import IDENTITY_SOURCES
from rollbook.fixtures import AS_OF, SETTINGS
from rollbook.functions import similarity, text, values
from rollbook.operators import (
    clean,
    duplicates,
    export,
    identity,
    matching,
    profiles,
    quality,
)
from rollbook.plans import build, sinks
from rollbook.staging import Stage
from rollbook.schema import ORDINAL
from rollbook.sources import align, readers

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[f"q_{fn.__name__}"] = fn
    return fn


def _aligned(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    raw = fixtures.raw_sources(spark, sf_dir, *names)
    return clean.combine_sources(align.align_sources(raw))


def _golden(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """The golden table; of ``names`` alone where only their columns are wanted. The
    identity feeds decide on its rows."""
    return identity.golden_records(fixtures.combined(spark, sf_dir, *names))


def _staged(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """For queries that read the cleaned feeds more than once: written, then read back."""
    return Stage(spark).table("combined", fixtures.combined(spark, sf_dir, *names))


def _staged_golden(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """For queries that read the golden table more than once: written, then read back."""
    golden = _golden(spark, sf_dir)
    return Stage(spark).table("golden", golden.select(*columns) if columns else golden)


# --- alignment and cleaning -------------------------------------------------------


@query
def align_hris(spark, sf_dir):
    return _aligned(spark, sf_dir, *IDENTITY_SOURCES).drop(ORDINAL)


@query
def align_payroll(spark, sf_dir):
    return _aligned(spark, sf_dir, "payroll").drop(ORDINAL)


@query
def align_benefits(spark, sf_dir):
    return _aligned(spark, sf_dir, "benefits").drop(ORDINAL)


@query
def clean_ids(spark, sf_dir):
    return fixtures.messy_ids(spark, sf_dir).selectExpr(
        "row_id",
        f"{values.employee_key('raw_id', 'company')} AS employee_id",
        f"{values.employee_key('raw_manager', 'company')} AS manager_id",
    )


@query
def clean_names(spark, sf_dir):
    named = fixtures.messy_names(spark, sf_dir).selectExpr(
        "row_id",
        f"{text.person_name('first')} AS first_name",
        f"{text.person_name('last')} AS last_name",
        f"{text.strip_lower('email')} AS email",
    )
    return named.selectExpr("*", f"{text.full_name('first_name', 'last_name')} AS full_name")


@query
def clean_types_dates(spark, sf_dir):
    return fixtures.messy_dates(spark, sf_dir).selectExpr(
        "row_id",
        f"{values.employment_type('raw_type')} AS employment_type",
        f"{values.standard_date('raw_date', SETTINGS)} AS hire_date",
    )


@query
def salary_usd(spark, sf_dir):
    usd = values.salary_usd_annual("base_salary", "currency", "pay_frequency")
    return fixtures.messy_salaries(spark, sf_dir).selectExpr(
        "row_id",
        f"{values.salary_amount('base_salary')} AS salary_amount",
        f"{usd} AS salary_usd_annual",
    )


@query
def clean_records(spark, sf_dir):
    aligned = _aligned(spark, sf_dir, "globaltech_hris")
    return clean.clean(aligned, fixtures.department_mapping(spark), SETTINGS).drop(ORDINAL)


@query
def department_map(spark, sf_dir):
    both = _aligned(spark, sf_dir, *IDENTITY_SOURCES)
    mapped = clean.map_departments(both, fixtures.department_mapping(spark))
    return mapped.select(
        "source_system", "source_employee_id", "department", "department_standardized"
    )


@query
def unmapped_departments(spark, sf_dir):
    both = _aligned(spark, sf_dir, *IDENTITY_SOURCES)
    return clean.unmapped_departments(both, fixtures.department_mapping(spark))


@query
def rejected_values(spark, sf_dir):
    return clean.rejected_values(_aligned(spark, sf_dir), SETTINGS)


@query
def union_sources(spark, sf_dir):
    return fixtures.combined(spark, sf_dir).drop(ORDINAL)


# --- survivorship and enrichment --------------------------------------------------


@query
def hris_survivor(spark, sf_dir):
    records = fixtures.identities(spark, sf_dir)
    return identity.surviving_identities(records)


@query
def hris_duplicate_review(spark, sf_dir):
    records = identity.identity_records(_staged(spark, sf_dir, *IDENTITY_SOURCES))
    return identity.duplicate_identity_review(records)


@query
def repeated_ids(spark, sf_dir):
    """The ids that several identity rows have, before survivorship."""
    return identity.repeated_keys(fixtures.identities(spark, sf_dir), "employee_id")


@query
def payroll_latest(spark, sf_dir):
    return identity.latest_payroll(fixtures.combined(spark, sf_dir, "payroll"))


@query
def benefits_summary(spark, sf_dir):
    return identity.benefits_summary(fixtures.combined(spark, sf_dir, "benefits"))


@query
def source_systems(spark, sf_dir):
    return identity.source_systems(fixtures.combined(spark, sf_dir))


@query
def golden(spark, sf_dir):
    return _golden(spark, sf_dir)


@query
def golden_export(spark, sf_dir):
    return export.golden_export(_golden(spark, sf_dir))


@query
def ghosts(spark, sf_dir):
    return identity.ghost_records(_staged(spark, sf_dir))


@query
def matched_enrichment(spark, sf_dir):
    return identity.matched_enrichment(_staged(spark, sf_dir))


# --- duplicate checks and match candidates ----------------------------------------


@query
def duplicate_ids(spark, sf_dir):
    """On the golden table, where ids are unique: empty by construction."""
    return duplicates.duplicate_ids(_staged_golden(spark, sf_dir))


@query
def duplicate_ids_in_feeds(spark, sf_dir):
    """The same check where it finds something: before survivorship."""
    records = identity.identity_records(_staged(spark, sf_dir, *IDENTITY_SOURCES)).drop(ORDINAL)
    return duplicates.duplicate_ids(records)


@query
def duplicate_emails(spark, sf_dir):
    return duplicates.duplicate_emails(_staged_golden(spark, sf_dir))


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged_golden(
        spark, sf_dir, "employee_id", "company_origin", "full_name", "email", "hire_date"
    )


@query
def same_name_matches(spark, sf_dir):
    return matching.same_name_matches(_people(spark, sf_dir))


@query
def fuzzy_matches(spark, sf_dir):
    return matching.similar_name_matches(_people(spark, sf_dir))


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _people(spark, sf_dir)
    return matching.probable_matches(
        matching.same_name_matches(people), matching.similar_name_matches(people), people
    )


@query
def probable_matches(spark, sf_dir):
    return _matches(spark, sf_dir)


@query
def match_export(spark, sf_dir):
    return export.match_export(_matches(spark, sf_dir))


def _next_part_scores(spark: SparkSession, texts: DataFrame) -> DataFrame:
    """The score of every text (p_partkey, words) against the next one's.

    A score costs far more than the bytes it is made from, and by bytes the reader, a broadcast
    and adaptive execution would all leave the texts to one task; so they are dealt to as many
    tasks as shuffles have, and what costs is worked out after the join.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    left = texts.select("p_partkey", "words").repartition(tasks, "p_partkey")
    right = texts.selectExpr("p_partkey - 1 AS p_partkey", "words AS next_words")
    pairs = left.join(right.hint("merge"), "p_partkey").selectExpr(
        "p_partkey", f"{text.sorted_tokens('words')} AS a", f"{text.sorted_tokens('next_words')} AS b"
    )
    lcs = similarity.lcs_length("a", "_masks", "b")
    measured = pairs.selectExpr("*", f"{similarity.character_masks('a')} AS _masks").selectExpr(
        "p_partkey", "a", "b", f"CAST({lcs} AS INT) AS lcs"
    )
    return measured.selectExpr("*", f"{similarity.score('length(a) + length(b)', 'lcs')} AS score")


@query
def token_sort_scores(spark, sf_dir):
    """The score itself, for every part name against the next one."""
    parts = fixtures.table(spark, sf_dir, "part")
    return _next_part_scores(spark, parts.selectExpr("p_partkey", "p_name AS words"))


@query
def token_sort_long_texts(spark, sf_dir):
    """The score of texts that take several words: descriptions of every part and the next."""
    parts = fixtures.table(spark, sf_dir, "part").selectExpr("p_partkey", f"{fixtures.LONG_TEXT} AS words")
    scores = _next_part_scores(spark, parts)
    return scores.selectExpr("p_partkey", "length(a) AS length_a", "length(b) AS length_b", "lcs", "score")


# --- quality ----------------------------------------------------------------------

_REPORT_INPUT = (
    "employee_id", "full_name", "email", "company_origin", "employment_type",
    "department_standardized", "hire_date", "salary_usd_annual", "manager_id",
    "benefits_enrolled",
)


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    golden = _staged_golden(spark, sf_dir, *_REPORT_INPUT)
    return quality.Validator(settings=SETTINGS).run(golden)


@query
def validation_report(spark, sf_dir):
    return _report(spark, sf_dir)


@query
def salary_failures(spark, sf_dir):
    rules = quality.Validator(settings=SETTINGS)
    return rules.failed_rows(_golden(spark, sf_dir), "salary_usd_annual_range")


@query
def manager_failures(spark, sf_dir):
    rules = quality.Validator(settings=SETTINGS)
    golden = _staged_golden(spark, sf_dir)
    return rules.failed_rows(golden, "manager_id_referential_integrity")


@query
def unique_failures(spark, sf_dir):
    """The uniqueness rule where it finds something: before survivorship."""
    rules = quality.Validator(settings=SETTINGS)
    records = identity.identity_records(_staged(spark, sf_dir, *IDENTITY_SOURCES)).drop(ORDINAL)
    return rules.failed_rows(records, "employee_id_unique")


# --- profiles ---------------------------------------------------------------------


@query
def headcount_department(spark, sf_dir):
    return profiles.headcount_by_department(_golden(spark, sf_dir, *IDENTITY_SOURCES))


@query
def headcount_country_top15(spark, sf_dir):
    return profiles.headcount_by_country(_golden(spark, sf_dir, *IDENTITY_SOURCES))


@query
def salary_box(spark, sf_dir):
    return profiles.salary_box(_golden(spark, sf_dir, *IDENTITY_SOURCES, "payroll"))


@query
def tenure_histogram(spark, sf_dir):
    return profiles.tenure_histogram(_golden(spark, sf_dir, *IDENTITY_SOURCES), AS_OF)


@query
def benefits_rate(spark, sf_dir):
    return profiles.benefits_rate_by_department(_golden(spark, sf_dir, *IDENTITY_SOURCES, "benefits"))


@query
def dq_series(spark, sf_dir):
    return profiles.quality_series(_report(spark, sf_dir))


# --- sources and sinks, through files in the shared folder ------------------------


# blanks around a value are part of it
_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


@query
def source_csv(spark, sf_dir):
    path = Stage(spark).path("hris.csv")
    raw = fixtures.raw_sources(spark, sf_dir, "globaltech_hris")["globaltech_hris"]
    raw.drop(ORDINAL).write.options(**_CSV).csv(path)
    return readers.read_csv_identity(spark, path)


_PERSON = (
    "employee_identifier", "name.first", "name.last", "name.full", "contact.email",
    "assignment.department", "assignment.role", "assignment.location",
    "assignment.hire_timestamp", "employment.type", "employment.status",
    "manager_employee_id", "source_system",
)


@query
def source_json(spark, sf_dir):
    """JSON Lines, the form that Spark splits; tests cover whole documents."""
    path = Stage(spark).path("hris.json")
    raw = fixtures.raw_sources(spark, sf_dir, "acquiredco_hris")["acquiredco_hris"]
    raw.write.json(path)
    people = readers.read_json_identity(spark, path, lines=True)
    return people.selectExpr(*[f"{c} AS {c.replace('.', '_')}" for c in _PERSON])


def _untidy_files(spark: SparkSession, sf_dir: str) -> dict[str, readers.SourceSpec]:
    """Files whose records have every shape; feeds by name."""
    stage = Stage(spark)

    def lines(name: str, sql: str, header: str | None = None) -> str:
        rows = fixtures.lines(spark, sf_dir, sql)
        if header is None:
            rows.write.text(stage.path(name))
        else:  # one column of whole lines, under a header line
            rows.toDF(header).write.options(header=True, sep="\x01", quote="").csv(stage.path(name))
        return stage.path(name)

    spec = readers.SourceSpec
    return {
        "acquiredco_hris": spec(lines("people.json", fixtures.JSON_LINES), "json_lines"),
        "globaltech_hris": spec(lines("people.csv", fixtures.CSV_LINES, "employee_id,first_name,last_name"), "csv"),
        "payroll": spec(lines("pay.csv", fixtures.PAYROLL_LINES, "base_salary,employee_id"), "csv"),
    }


@query
def source_json_shapes(spark, sf_dir):
    """Records whose fields are not of the shape expected, pages and lists of records."""
    people = readers.load_sources(spark, _untidy_files(spark, sf_dir))["acquiredco_hris"]
    return people.selectExpr(*[f"{c} AS {c.replace('.', '_')}" for c in _PERSON])


@query
def source_json_documents(spark, sf_dir):
    """Whole documents, one file each: the people of a company below one key."""
    path = Stage(spark).path("people")
    raw = fixtures.raw_sources(spark, sf_dir, "acquiredco_hris")["acquiredco_hris"]
    pages = raw.groupBy("assignment.location").agg(F.collect_list(F.struct(*raw.columns)).alias("employees"))
    pages.select("location", F.to_json(F.struct("employees")).alias("value")).write.partitionBy("location").text(path)
    people = readers.read_json_identity(spark, path)
    return people.selectExpr(*[f"{c} AS {c.replace('.', '_')}" for c in _PERSON])


@query
def source_csv_ragged(spark, sf_dir):
    """Rows with too few values, with quotes, and with too many, which are left out."""
    feeds = readers.load_sources(spark, _untidy_files(spark, sf_dir))
    people = feeds["globaltech_hris"].select("source_system", "employee_id", "first_name", "last_name", F.lit(None).cast("string").alias("base_salary"))
    pay = feeds["payroll"].select("source_system", "employee_id", F.lit(None).cast("string").alias("first_name"), F.lit(None).cast("string").alias("last_name"), "base_salary")
    return people.unionByName(pay)


@query
def source_rejects(spark, sf_dir):
    """Every record that a reader left out or read in part, and whether its file is known."""
    listed = readers.malformed_records(spark, _untidy_files(spark, sf_dir))
    return listed.select("source_system", "reason", "record", F.col("file").isNotNull().alias("has_file"))


@query
def source_all(spark, sf_dir):
    """All feeds from their files at once, by the formats the run names: rows of each."""
    stage = Stage(spark)
    raw = fixtures.raw_sources(spark, sf_dir)
    raw["globaltech_hris"].drop(ORDINAL).write.options(**_CSV).csv(stage.path("hris"))
    raw["acquiredco_hris"].write.json(stage.path("people"))
    raw["payroll"].drop(ORDINAL).write.parquet(stage.path("payroll"))
    raw["benefits"].drop(ORDINAL).write.format("xml").options(rowTag="enrollment", rootTag="enrollments").save(stage.path("benefits"))
    spec = readers.SourceSpec
    feeds = readers.load_sources(
        spark,
        {
            "globaltech_hris": spec(stage.path("hris"), "csv"),
            "acquiredco_hris": spec(stage.path("people"), "json_lines"),
            "payroll": spec(stage.path("payroll"), "parquet"),
            "benefits": spec(stage.path("benefits"), "xml"),
            "unknown": spec(stage.path("hris"), "csv"),
        },
    )
    aligned = clean.combine_sources(align.align_sources(feeds))
    return aligned.groupBy("source_system").agg(
        F.count("*").alias("n"), F.count_distinct("employee_id").alias("ids"), F.max("employee_id").alias("last_id")
    )


@query
def source_missing(spark, sf_dir):
    """A feed whose file is not there is empty, and the run goes on with the others."""
    stage = Stage(spark)
    raw = fixtures.raw_sources(spark, sf_dir, "payroll")["payroll"]
    raw.drop(ORDINAL).write.options(**_CSV).csv(stage.path("payroll"))
    spec = readers.SourceSpec
    sources = {
        "globaltech_hris": spec(stage.path("gone"), "csv"),
        "acquiredco_hris": spec(stage.path("gone"), "json"),
        "payroll": spec(stage.path("payroll"), "csv"),
        "benefits": spec(stage.path("gone"), "xml"),
    }
    aligned = clean.combine_sources(align.align_sources(readers.load_sources(spark, sources)))
    return aligned.select("source_system", "employee_id", "company_origin", "salary_original", "currency", "compensation_effective_date")


@query
def source_lookup(spark, sf_dir):
    """The department lookup read from its file, applied to the identity feeds."""
    path = Stage(spark).path("department_mapping.csv")
    fixtures.department_mapping(spark).write.options(header=True).csv(path)
    mapping = readers.read_department_mapping(spark, path)
    mapped = clean.map_departments(_aligned(spark, sf_dir, *IDENTITY_SOURCES), mapping)
    return mapped.groupBy("source_system", "department", "department_standardized").agg(F.count("*").alias("n"))


@query
def source_xml(spark, sf_dir):
    path = Stage(spark).path("benefits.xml")
    raw = fixtures.raw_sources(spark, sf_dir, "benefits")["benefits"]
    rows = raw.select("employee_id", "enrollment_date")
    rows.write.format("xml").options(rowTag="enrollment", rootTag="enrollments").save(path)
    return readers.read_benefits(spark, path).select(
        "employee_id", "enrollment_date", "source_system"
    )


@query
def source_payroll(spark, sf_dir):
    path = Stage(spark).path("payroll")
    raw = fixtures.raw_sources(spark, sf_dir, "payroll")["payroll"]
    raw.drop(ORDINAL).write.parquet(path)
    return readers.read_payroll(spark, path, "parquet").drop("bonus_target_pct")


@query
def sink_golden(spark, sf_dir):
    path = Stage(spark).path("golden_employee_dataset")
    sinks.write_golden(_golden(spark, sf_dir), path)
    return sinks.read_golden(spark, path)


@query
def sink_review(spark, sf_dir):
    path = Stage(spark).path("ghost_employee_records.csv")
    sinks.write_review(identity.ghost_records(_staged(spark, sf_dir)), path)
    review = spark.read.options(header=True, escape='"').csv(path)
    return review.select(
        "employee_id", "source_employee_id", "company_origin", "source_system", "salary_original"
    )


def _read_back(spark: SparkSession, name: str, table: DataFrame, *order_by: str) -> DataFrame:
    """A review table as its file gives it, every column of it."""
    path = Stage(spark).path(name)
    sinks.write_review(table, path, order_by, build.REVIEW_COMPRESSION.get(name, "none"))
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return spark.read.schema(table.schema).options(header=True, escape='"', **blanks).csv(path)


@query
def sink_duplicate_emails(spark, sf_dir):
    table = REGISTRY["q_duplicate_emails"](spark, sf_dir)
    return _read_back(spark, "duplicate_email_records.csv", table, "email", "employee_id")


@query
def sink_duplicate_hris(spark, sf_dir):
    table = REGISTRY["q_hris_duplicate_review"](spark, sf_dir)
    return _read_back(spark, "duplicate_hris_records.csv", table)


@query
def sink_matches(spark, sf_dir):
    return _read_back(spark, build.MATCH_REVIEW, build.match_review(_people(spark, sf_dir)))


@query
def sink_salary_failures(spark, sf_dir):
    table = REGISTRY["q_salary_failures"](spark, sf_dir)
    return _read_back(spark, "salary_usd_annual_range_failures.csv", table)


@query
def sink_report(spark, sf_dir):
    table = _report(spark, sf_dir).coalesce(1)
    return _read_back(spark, "data_quality_validation_report.csv", table)


@query
def gate_failures(spark, sf_dir):
    """The rules that the gate counts against a run."""
    return _report(spark, sf_dir).filter("status = 'FAIL'").select("check", "failed")
