"""Rule-based validation, the quality gate and the rows behind each failure.

A rule looks at one row, at one column's uniqueness, or at a reference between two
columns. All row rules are counted in one pass; the other two are counted from grouped
keys, so no row is joined to anything to produce the report.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from rollbook.config import DEFAULT_SETTINGS, Settings
from rollbook.functions.text import literal
from rollbook.functions.values import as_of_date
from rollbook.operators.groups import HEAVY_GROUPS, rows_of_groups

REPORT_COLUMNS = ("check", "description", "total", "passed", "failed", "pass_rate", "status")


@dataclass(frozen=True)
class RowRule:
    """Passes where the SQL ``predicate`` is true; null counts as a failure."""

    name: str
    description: str
    predicate: str


@dataclass(frozen=True)
class UniqueRule:
    """Passes where no other row has the same value; nulls equal each other."""

    name: str
    description: str
    column: str


@dataclass(frozen=True)
class ReferenceRule:
    """Passes where ``column`` is null or occurs in ``target`` of the same table."""

    name: str
    description: str
    column: str
    target: str


Rule = RowRule | UniqueRule | ReferenceRule


def standard_rules(as_of: dt.date | None = None) -> list[Rule]:
    """The fourteen published rules. Names, texts and limits are fixed values."""
    earliest, latest = "TIMESTAMP_NTZ'1990-01-01'", as_of_date(as_of)
    return [
        RowRule(
            "employee_id_not_null",
            "employee_id must not be null",
            "employee_id IS NOT NULL",
        ),
        UniqueRule(
            "employee_id_unique",
            "employee_id should be unique across the dataset",
            "employee_id",
        ),
        RowRule(
            "employee_id_format",
            "employee_id must match GT-000001 or AC-000001 format",
            "employee_id RLIKE '^(GT|AC)-[0-9]{6}$'",
        ),
        RowRule(
            "full_name_not_null",
            "full_name must not be null",
            "full_name IS NOT NULL",
        ),
        RowRule(
            "email_not_null",
            "email must not be null",
            "email IS NOT NULL",
        ),
        RowRule(
            "email_format",
            "email must be in a valid format",
            r"email RLIKE r'(?U)^[^@\s]+@[^@\s]+\.[^@\s]+$'",
        ),
        RowRule(
            "company_origin_allowed",
            "company_origin must be GlobalTech or AcquiredCo",
            "company_origin IN ('GlobalTech', 'AcquiredCo')",
        ),
        RowRule(
            "employment_type_allowed",
            "employment_type must be Full-Time, Part-Time, or Contractor",
            "employment_type IS NULL "
            "OR employment_type IN ('Full-Time', 'Part-Time', 'Contractor')",
        ),
        RowRule(
            "department_standardized_not_null",
            "department_standardized must not be null",
            "department_standardized IS NOT NULL",
        ),
        RowRule(
            "hire_date_not_null",
            "hire_date must not be null",
            "hire_date IS NOT NULL",
        ),
        RowRule(
            "hire_date_plausible_range",
            "hire_date must be between 1990-01-01 and today",
            f"hire_date BETWEEN {earliest} AND {latest}",
        ),
        RowRule(
            "salary_usd_annual_range",
            "salary_usd_annual must be between 20,000 and 2,000,000 when present",
            "salary_usd_annual IS NULL OR salary_usd_annual BETWEEN 20000 AND 2000000",
        ),
        ReferenceRule(
            "manager_id_referential_integrity",
            "manager_id must refer to an employee_id in the golden dataset when present",
            "manager_id",
            "employee_id",
        ),
        RowRule(
            "benefits_enrolled_boolean",
            "benefits_enrolled must be boolean",
            "benefits_enrolled IS NOT NULL",
        ),
    ]


class QualityGateError(ValueError):
    """More rules failed than the gate allows."""


class Validator:
    def __init__(
        self,
        rules: Sequence[Rule] | None = None,
        settings: Settings = DEFAULT_SETTINGS,
    ):
        self.rules = list(standard_rules(settings.as_of) if rules is None else rules)
        self.max_failed_checks = settings.max_failed_checks

    def run(self, df: DataFrame) -> DataFrame:
        """One row per rule, in rule order. Reads ``df`` once per kind of rule."""
        row_rules = [(i, r) for i, r in enumerate(self.rules) if isinstance(r, RowRule)]
        counted = [
            _count_key_rule(df, i, r)
            for i, r in enumerate(self.rules)
            if not isinstance(r, RowRule)
        ]
        if row_rules:
            counted.append(_count_row_rules(df, row_rules))
        return self._report(reduce(DataFrame.unionByName, counted))

    def _report(self, counts: DataFrame) -> DataFrame:
        names = ", ".join(literal(r.name) for r in self.rules)
        descriptions = ", ".join(literal(r.description) for r in self.rules)
        # per cent to two places in whole numbers: the share times 10,000, rounded half up
        rate = "((passed * 20000 + total) div (total * 2)) / 100D"
        return counts.orderBy("ord").selectExpr(
            f"get(array({names}), ord) AS check",
            f"get(array({descriptions}), ord) AS description",
            "total",
            "passed",
            "total - passed AS failed",
            f"IF(total > 0, {rate}, 0D) AS pass_rate",
            "IF(total = passed, 'PASS', 'FAIL') AS status",
        )

    def gate(self, report: DataFrame) -> None:
        """Raise when more rules failed than allowed. Collects one row per failed rule."""
        failed = [r["check"] for r in report.filter("status = 'FAIL'").select("check").collect()]
        if len(failed) > self.max_failed_checks:
            raise QualityGateError(
                f"data quality gate failed: {len(failed)} checks failed, "
                f"at most {self.max_failed_checks} allowed: {failed}"
            )

    def failed_rows(
        self, df: DataFrame, check: str, heavy_groups: int = HEAVY_GROUPS
    ) -> DataFrame:
        """The rows that fail one rule, with the rule's name and description."""
        rule = next((r for r in self.rules if r.name == check), None)
        if rule is None:
            raise ValueError(f"unknown validation check: {check}")
        if isinstance(rule, RowRule):
            rows = df.filter(f"NOT coalesce({rule.predicate}, false)")
        else:
            groups = _key_counts(df, rule)
            rows = rows_of_groups(df, groups, rule.column, "_failed", heavy_groups)
        return rows.drop("_failed").selectExpr(
            "*",
            f"{literal(rule.name)} AS failed_check",
            f"{literal(rule.description)} AS failed_check_description",
        )


def _count_row_rules(df: DataFrame, rules: list[tuple[int, RowRule]]) -> DataFrame:
    """All row rules in one pass: a count per rule, then one row per count."""
    totals = df.agg(
        F.expr("count(*) AS total"),
        *[F.expr(f"count_if({r.predicate}) AS passed_{i}") for i, r in rules],
    )
    each = ", ".join(f"struct({i} AS ord, passed_{i} AS passed)" for i, _ in rules)
    return totals.selectExpr("total", f"inline(array({each}))")


def _count_key_rule(df: DataFrame, ord: int, rule: UniqueRule | ReferenceRule) -> DataFrame:
    return _key_counts(df, rule).agg(
        F.expr("coalesce(sum(n), 0) AS total"),
        F.expr(f"{ord} AS ord"),
        F.expr("coalesce(sum(n) FILTER (WHERE NOT _failed), 0) AS passed"),
    )


def _key_counts(df: DataFrame, rule: UniqueRule | ReferenceRule) -> DataFrame:
    """For each value of the rule's column: its rows ``n`` and whether they fail."""
    if isinstance(rule, UniqueRule):
        counts = df.groupBy(rule.column).agg(F.expr("count(*) AS n"))
        return counts.selectExpr("*", "n > 1 AS _failed")
    uses = df.selectExpr(rule.column, "1 AS _used")
    targets = df.selectExpr(f"{rule.target} AS {rule.column}", "0 AS _used")
    keys = uses.union(targets).groupBy(rule.column).agg(
        F.expr("sum(_used) AS n"), F.expr("bool_or(_used = 0) AS _exists")
    )
    return keys.filter("n > 0").selectExpr(
        rule.column, "n", f"{rule.column} IS NOT NULL AND NOT _exists AS _failed"
    )
