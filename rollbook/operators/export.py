"""The shapes in which golden records and matches leave the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rollbook.functions.values import salary_amount
from rollbook.schema import DATE_COLUMNS, GOLDEN_COLUMNS

# The columns of the match review file, in order.
MATCH_EXPORT_COLUMNS = (
    "record_1_id",
    "record_2_id",
    "similarity_score",
    "hire_date_diff_days",
    "recommended_action",
    "match_type",
    "left_company_origin",
    "right_company_origin",
    "left_full_name",
    "right_full_name",
    "left_email",
    "right_email",
    "left_hire_date",
    "right_hire_date",
)


def golden_export(golden: DataFrame) -> DataFrame:
    """Stable column types: text, timestamp, number, boolean. Bad values become null."""
    special = {
        **{c: f"try_cast({c} AS TIMESTAMP_NTZ)" for c in DATE_COLUMNS},
        "salary_original": salary_amount("CAST(salary_original AS STRING)"),
        "salary_usd_annual": "try_cast(salary_usd_annual AS DOUBLE)",
        "benefits_enrolled": "coalesce(benefits_enrolled, false)",
    }
    columns = [c for c in GOLDEN_COLUMNS if c in golden.columns]
    return golden.selectExpr(
        *[f"{special.get(c, f'CAST({c} AS STRING)')} AS {c}" for c in columns]
    )


def match_export(matches: DataFrame) -> DataFrame:
    values = {
        "record_1_id": "left_employee_id",
        "record_2_id": "right_employee_id",
        "similarity_score": "coalesce(name_similarity_score, 100D)",
        "hire_date_diff_days": "hire_date_gap_days",
        "recommended_action": "'HR_REVIEW'",
    }
    return matches.selectExpr(*[f"{values.get(c, c)} AS {c}" for c in MATCH_EXPORT_COLUMNS])
