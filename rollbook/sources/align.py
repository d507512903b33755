"""Each feed's columns expressed in the canonical record."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from rollbook.functions.text import strip
from rollbook.schema import ORDINAL, as_text, conform

# Canonical column to the feed's SQL expression for it, per feed.
AlignSpec = Mapping[str, str]

ALIGN_SPECS: dict[str, AlignSpec] = {
    "globaltech_hris": {
        "employee_id": "employee_id",
        "source_employee_id": "employee_id",
        "company_origin": "'GlobalTech'",
        "first_name": "first_name",
        "last_name": "last_name",
        "full_name": f"concat_ws(' ', {strip('first_name')}, {strip('last_name')})",
        "email": "email",
        "department": "department",
        "job_title": "job_title",
        "hire_date": "hire_date",
        "country": "country",
        "employment_type": "employment_type",
        "manager_id": "manager_id",
        "source_system": "'globaltech_hris'",
    },
    "acquiredco_hris": {
        "employee_id": "employee_identifier",
        "source_employee_id": "employee_identifier",
        "company_origin": "'AcquiredCo'",
        "first_name": "name.first",
        "last_name": "name.last",
        "full_name": "name.full",
        "email": "contact.email",
        "department": "assignment.department",
        "job_title": "assignment.role",
        "country": "assignment.location",
        "hire_date": "assignment.hire_timestamp",
        "employment_type": "employment.type",
        "manager_id": "manager_employee_id",
        "source_system": "'acquiredco_hris'",
    },
    "payroll": {
        "employee_id": "employee_id",
        "source_employee_id": "employee_id",
        "company_origin": "source",
        "salary_original": "base_salary",
        "currency": "currency",
        "pay_frequency": "pay_frequency",
        "compensation_effective_date": "effective_date",
        "source_system": "'payroll'",
    },
    # every enrollment is taken to belong to the first company; pass another spec where
    # the feed states the company
    "benefits": {
        "employee_id": "employee_id",
        "source_employee_id": "employee_id",
        "company_origin": "'GlobalTech'",
        "benefits_enrolled": "true",
        "benefits_enrollment_date": "enrollment_date",
        "source_system": "'benefits'",
    },
}


def align(df: DataFrame, spec: AlignSpec) -> DataFrame:
    mapped = [
        f"{as_text(df, value) if value in df.columns else value} AS {name}"
        for name, value in spec.items()
    ]
    if ORDINAL in df.columns:
        mapped.append(ORDINAL)
    return conform(df.selectExpr(*mapped))


def align_sources(
    raw: Mapping[str, DataFrame], specs: Mapping[str, AlignSpec] = ALIGN_SPECS
) -> dict[str, DataFrame]:
    """Feeds without a spec are left out."""
    return {name: align(df, specs[name]) for name, df in raw.items() if name in specs}
