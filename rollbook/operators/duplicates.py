"""Exact duplicate checks on the golden table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollbook.operators.groups import HEAVY_GROUPS, rows_of_groups


def duplicate_ids(golden: DataFrame, heavy_groups: int = HEAVY_GROUPS) -> DataFrame:
    """Rows whose employee id occurs more than once; missing ids equal each other."""
    groups = golden.groupBy("employee_id").agg(F.expr("count(*) AS n"))
    rows = rows_of_groups(golden, groups, "employee_id", "n > 1", heavy_groups)
    return rows.withColumn("duplicate_check", F.lit("employee_id"))


def duplicate_emails(golden: DataFrame, heavy_groups: int = HEAVY_GROUPS) -> DataFrame:
    """Rows whose email is used in at least two companies."""
    rows = golden.filter("email IS NOT NULL")
    groups = rows.groupBy("email").agg(
        F.expr("count(*) AS n"),
        F.expr("min(company_origin) < max(company_origin) AS _shared"),
    )
    shared = rows_of_groups(rows, groups, "email", "_shared", heavy_groups)
    return shared.drop("_shared").withColumn("duplicate_check", F.lit("cross_company_email"))
