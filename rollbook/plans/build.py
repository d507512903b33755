"""The full run: read, align, clean, integrate, check, match, publish."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rollbook.config import DEFAULT_SETTINGS, Settings
from rollbook.operators import (
    clean,
    duplicates,
    export,
    identity,
    matching,
    profiles,
    quality,
)
from rollbook.plans import sinks
from rollbook.staging import Stage
from rollbook.sources import align, readers


# Order of the rows in the review files; the others keep the order they come in.
REVIEW_ORDER = {"duplicate_email_records.csv": ("email", "employee_id")}
MATCH_REVIEW = "probable_match_review.csv"
# Its rows grow with the square of a name's and tell of each record many times over, so its files
# are compressed. The other review files stay plain.
REVIEW_COMPRESSION = {MATCH_REVIEW: "gzip"}


@dataclass(frozen=True)
class Outputs:
    """Folders of one published run."""

    root: str

    @property
    def golden(self) -> str:
        return f"{self.root}/processed/golden_employee_dataset"

    def report(self, name: str) -> str:
        return f"{self.root}/reports/{name}"


def combine(
    raw: Mapping[str, DataFrame],
    department_mapping: DataFrame | None,
    settings: Settings = DEFAULT_SETTINGS,
) -> DataFrame:
    """Aligned, stacked and cleaned feeds. One pass over each feed, no shuffle."""
    aligned = clean.combine_sources(align.align_sources(raw))
    return clean.clean(aligned, department_mapping, settings)


def exception_tables(combined: DataFrame, golden: DataFrame) -> dict[str, DataFrame]:
    """Every exception table but the match candidates, by the name of its file."""
    return {
        "ghost_employee_records.csv": identity.ghost_records(combined),
        "duplicate_hris_records.csv": identity.duplicate_identity_review(
            identity.identity_records(combined)
        ),
        "duplicate_employee_id_records.csv": duplicates.duplicate_ids(golden),
        "duplicate_email_records.csv": duplicates.duplicate_emails(golden),
    }


def match_review(golden: DataFrame, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """The match candidates as they are published, by the ids of both records."""
    threshold, gap = settings.similarity_threshold, settings.max_hire_date_gap_days
    return export.match_export(matching.sorted_matches(golden, threshold, gap))


def review_tables(
    combined: DataFrame, golden: DataFrame, settings: Settings = DEFAULT_SETTINGS
) -> dict[str, DataFrame]:
    """Every exception table, by the name of its file; match candidates in no order."""
    gap = settings.max_hire_date_gap_days
    matches = matching.probable_matches(
        matching.same_name_matches(golden, gap),
        matching.similar_name_matches(golden, settings.similarity_threshold, gap),
        golden,
        gap,
    )
    return {**exception_tables(combined, golden), MATCH_REVIEW: export.match_export(matches)}


def profile_tables(
    golden: DataFrame, report: DataFrame, settings: Settings = DEFAULT_SETTINGS
) -> dict[str, DataFrame]:
    """The data of every chart, by the chart's name."""
    return {
        "headcount_by_department": profiles.headcount_by_department(golden),
        "headcount_by_country": profiles.headcount_by_country(golden),
        "salary_by_employment_type": profiles.salary_box(golden),
        "tenure_distribution": profiles.tenure_histogram(golden, settings.as_of),
        "benefits_enrollment_rate_by_department": profiles.benefits_rate_by_department(golden),
        "data_quality_summary": profiles.quality_series(report),
    }


def run(
    spark: SparkSession,
    sources: Mapping[str, readers.SourceSpec],
    mapping_path: str,
    output_root: str,
    settings: Settings = DEFAULT_SETTINGS,
) -> dict[str, DataFrame]:
    """Read the feeds, publish every output and return the tables.

    The report and the failed rows are written before the gate is checked; a run the
    gate stops publishes no golden table.
    """
    stage, outputs = Stage(spark), Outputs(output_root)
    raw = readers.load_sources(spark, sources)
    mapping = readers.read_department_mapping(spark, mapping_path)
    combined = stage.table("combined", combine(raw, mapping, settings))
    watched, unique = identity.observed_unique(identity.golden_records(combined), "employee_id")
    golden = stage.table("golden", watched)
    identity.assert_unique(unique, "employee_id", "golden table")
    sinks.write_review(
        readers.malformed_records(spark, sources), outputs.report("malformed_records.csv")
    )
    sinks.write_review(
        clean.rejected_values(clean.combine_sources(align.align_sources(raw)), settings),
        outputs.report("rejected_values.csv"),
    )
    if mapping is not None:
        sinks.write_review(
            clean.unmapped_departments(clean.combine_sources(align.align_sources(raw)), mapping),
            outputs.report("unmapped_departments.csv"),
        )

    validator = quality.Validator(settings=settings)
    report = stage.table("report", validator.run(golden).coalesce(1))
    salary_failures = validator.failed_rows(golden, "salary_usd_annual_range")
    sinks.write_report(report, outputs.report("data_quality_validation_report.csv"))
    sinks.write_review(salary_failures, outputs.report("salary_usd_annual_range_failures.csv"))
    validator.gate(report)

    sinks.write_golden(golden, outputs.golden)
    tables = {"combined": combined, "golden": golden, "report": report}
    reviews = {**exception_tables(combined, golden), MATCH_REVIEW: match_review(golden, settings)}
    for name, table in reviews.items():
        codec = REVIEW_COMPRESSION.get(name, "none")
        sinks.write_review(table, outputs.report(name), REVIEW_ORDER.get(name, ()), codec)
        tables[name.removesuffix(".csv")] = table
    for name, table in profile_tables(golden, report, settings).items():
        sinks.write_review(table, outputs.report(f"figures/{name}"))
        tables[name] = table
    return tables
