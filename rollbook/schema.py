"""The canonical record, in its aligned (raw text) and cleaned (typed) forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

# The 23 canonical columns in their published order.
CANONICAL_COLUMNS = (
    "employee_id",
    "source_employee_id",
    "company_origin",
    "first_name",
    "last_name",
    "full_name",
    "email",
    "department",
    "department_standardized",
    "job_title",
    "manager_id",
    "employment_type",
    "country",
    "jurisdiction",
    "hire_date",
    "salary_original",
    "currency",
    "pay_frequency",
    "compensation_effective_date",
    "salary_usd_annual",
    "benefits_enrolled",
    "benefits_enrollment_date",
    "source_system",
)

PAYROLL_COLUMNS = (
    "salary_original",
    "currency",
    "pay_frequency",
    "compensation_effective_date",
    "salary_usd_annual",
)
BENEFITS_COLUMNS = ("benefits_enrolled", "benefits_enrollment_date")
IDENTITY_COLUMNS = tuple(
    c for c in CANONICAL_COLUMNS if c not in PAYROLL_COLUMNS + BENEFITS_COLUMNS
)
GOLDEN_COLUMNS = (
    IDENTITY_COLUMNS + PAYROLL_COLUMNS + BENEFITS_COLUMNS + ("source_systems", "dedup_method")
)
COMPLETENESS_COLUMNS = (
    "full_name",
    "email",
    "department",
    "job_title",
    "manager_id",
    "employment_type",
    "country",
    "hire_date",
)
DATE_COLUMNS = ("hire_date", "compensation_effective_date", "benefits_enrollment_date")

# Optional column a feed may carry: its row order, used only to break ties.
ORDINAL = "row_ord"

_CLEAN_TYPES: dict[str, T.DataType] = {
    **{c: T.TimestampNTZType() for c in DATE_COLUMNS},
    "salary_usd_annual": T.DoubleType(),
    "benefits_enrolled": T.BooleanType(),
}

ALIGNED_SCHEMA = T.StructType(
    [
        T.StructField(c, T.BooleanType() if c == "benefits_enrolled" else T.StringType())
        for c in CANONICAL_COLUMNS
    ]
)
CLEANED_SCHEMA = T.StructType(
    [T.StructField(c, _CLEAN_TYPES.get(c, T.StringType())) for c in CANONICAL_COLUMNS]
)


def as_text(df: DataFrame, name: str) -> str:
    """A column as text; fractional numbers keep a plain (never exponent) notation."""
    if name in df.columns and isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        plain = f"CAST(try_cast({name} AS DECIMAL(38, 6)) AS STRING)"
        return rf"regexp_replace({plain}, r'(\.\d+?)0+$', '$1')"
    return f"CAST({name} AS STRING)"


def conform(df: DataFrame, schema: T.StructType = ALIGNED_SCHEMA) -> DataFrame:
    """Exactly the columns of ``schema``, in order; absent ones are null, extras go.

    The row-order column survives when the input has it.
    """
    columns = []
    for field in schema:
        kind = field.dataType.simpleString()
        if field.name not in df.columns:
            value = f"CAST(NULL AS {kind})"
        elif isinstance(field.dataType, T.StringType):
            value = as_text(df, field.name)
        else:
            value = f"CAST({field.name} AS {kind})"
        columns.append(f"{value} AS {field.name}")
    if ORDINAL in df.columns:
        columns.append(f"CAST({ORDINAL} AS BIGINT) AS {ORDINAL}")
    return df.selectExpr(*columns)
