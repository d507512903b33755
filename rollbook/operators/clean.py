"""Cleaning of aligned records and the department lookup."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame

from rollbook.config import DEFAULT_SETTINGS, Settings
from rollbook.functions import text, values
from rollbook.schema import CLEANED_SCHEMA, DATE_COLUMNS, ORDINAL


def clean(
    aligned: DataFrame,
    department_mapping: DataFrame | None = None,
    settings: Settings = DEFAULT_SETTINGS,
) -> DataFrame:
    """Apply every normalisation to an aligned frame: projections only, no shuffle.

    Each projection uses what the one before computed, so that no costly step is
    repeated within a row. Names come last: Spark moves the projections before them
    below the union of the feeds, where the columns a feed lacks cost nothing.
    """
    ids = ("employee_id", "manager_id")
    names = ("first_name", "last_name")
    lowered = f"lower({text.strip_column('employment_type')})"
    steps = [
        {
            **{c: text.strip_column(c) for c in (*ids, *DATE_COLUMNS)},
            "email": f"lower({text.strip_column('email')})",
            "employment_type": values.type_of(lowered, settings),
            "_prefix": values.company_prefix(text.strip_column("company_origin"), settings),
            "_amount": values.without_signs("salary_original"),
            "_factor": values.salary_factor(
                text.strip_column("currency"), text.strip_column("pay_frequency"), settings
            ),
        },
        {
            **{c: values.id_digits(c) for c in ids},
            **{c: values.parsed_date(c, settings) for c in DATE_COLUMNS},
            "salary_usd_annual": values.annual_usd(text.strip_column("_amount"), "_factor"),
            "_prefix": "_prefix",
        },
        {
            **{c: values.padded_key("_prefix", c) for c in ids},
            **{c: values.date_in_range(c, settings) for c in DATE_COLUMNS},
        },
        {c: text.tidy(c) for c in names},
        {c: text.title_or_null(c) for c in names},
        {"full_name": text.full_name(*names)},
    ]
    extra = [ORDINAL] if ORDINAL in aligned.columns else []
    result = aligned
    for step in steps:
        columns = dict.fromkeys((*CLEANED_SCHEMA.names, *step, *extra))
        result = result.selectExpr(*[f"{step.get(c, c)} AS {c}" for c in columns])
    if department_mapping is None:
        return result
    return map_departments(result, department_mapping)


def combine_sources(frames: Mapping[str, DataFrame]) -> DataFrame:
    """All feeds as one long table."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), list(frames.values())
    )


def _keyed(mapping: DataFrame) -> DataFrame:
    """The lookup by normalised key; a key given twice fails the query, naming the key."""
    keys = mapping.selectExpr(
        f"{text.strip_lower('source_system')} AS _system",
        f"{text.strip_lower('source_department')} AS _name",
        "standard_department",
    )
    counted = keys.groupBy("_system", "_name").agg({"*": "count", "standard_department": "min"})
    repeated = "concat('department mapping repeats ', _system, '/', _name)"
    return counted.selectExpr(
        "_system",
        "_name",
        f"IF(`count(1)` > 1, CAST(raise_error({repeated}) AS STRING), "
        "`min(standard_department)`) AS _standard",
    )


def map_departments(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Fill ``department_standardized`` from the lookup; unmapped departments stay null.

    No broadcast is forced: Spark compares the lookup's size with its broadcast limit
    and ships the usual few dozen rows to the scan, without a shuffle of ``df``.
    """
    found = df.selectExpr(
        "*",
        f"lower({text.strip_column('source_system')}) AS _system",
        f"lower({text.strip_column('department')}) AS _name",
    )
    joined = found.join(_keyed(mapping), ["_system", "_name"], "left")
    return joined.selectExpr(
        [f"_standard AS {c}" if c == "department_standardized" else c for c in df.columns]
    )


def unmapped_departments(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Distinct (source, department) pairs the lookup does not know, sorted.

    Pairs are made distinct before the join, so a popular department is one row there.
    """
    pairs = (
        df.filter("department IS NOT NULL")
        .selectExpr(
            f"{text.strip('source_system')} AS source_system",
            f"{text.strip('department')} AS department",
        )
        .distinct()
        .selectExpr("*", "lower(source_system) AS _system", "lower(department) AS _name")
    )
    unknown = pairs.join(_keyed(mapping), ["_system", "_name"], "left_anti")
    return unknown.select("source_system", "department").orderBy("source_system", "department")


def rejected_values(aligned: DataFrame, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """(source_system, column, reason, raw_value, n): every value that ``clean`` turns to
    null, or leaves out of the annual salary, though it is not blank. Equal values of a
    source and column are counted; blanks at the ends do not make them different."""
    texts = (
        "employee_id", "manager_id", "employment_type", *DATE_COLUMNS,
        "salary_original", "currency", "pay_frequency",
    )
    bare = aligned.selectExpr(
        "source_system",
        f"{values.company_prefix(text.strip('company_origin'), settings)} AS _prefix",
        *[f"nullif({text.strip(c)}, '') AS {c}" for c in texts],
    )
    parsed = bare.selectExpr("*", *[f"{values.parsed_date(c, settings)} AS _{c}" for c in DATE_COLUMNS])

    def known(entries: Mapping[str, object]) -> str:
        return ", ".join(text.literal(e) for e in entries)

    reasons = {
        **{
            c: f"CASE WHEN _prefix IS NULL THEN 'unknown company' WHEN {values.id_digits(c)} IS NULL THEN 'no digits' END"
            for c in ("employee_id", "manager_id")
        },
        "employment_type": f"IF({values.type_of('lower(employment_type)', settings)} IS NULL, 'unknown', NULL)",
        **{
            c: f"CASE WHEN _{c} IS NULL THEN 'unparsed' WHEN {values.date_in_range(f'_{c}', settings)} IS NULL THEN 'out of range' END"
            for c in DATE_COLUMNS
        },
        "salary_original": f"IF(try_cast({values.bare_amount('salary_original')} AS DECIMAL(24, 6)) IS NULL, 'unparsed', NULL)",
        "currency": f"IF(upper(currency) NOT IN ({known(settings.usd_rates)}), 'unknown', NULL)",
        "pay_frequency": f"IF(lower(pay_frequency) NOT IN ({known(settings.pay_periods)}), 'unknown', NULL)",
    }
    pairs = ", ".join(
        f"named_struct('column', '{c}', 'reason', {reason}, 'raw_value', {c})" for c, reason in reasons.items()
    )
    found = parsed.selectExpr(
        "source_system",
        f"inline(filter(array({pairs}), x -> x.raw_value IS NOT NULL AND x.reason IS NOT NULL))",
    )
    return found.groupBy("source_system", "column", "reason", "raw_value").count().withColumnRenamed("count", "n")
