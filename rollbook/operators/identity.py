"""Survivorship, enrichment by exact id, and the audit tables around them.

The golden table is one grouped aggregate: each feed is scanned once, rows are reduced
to one per id before the only shuffle, and nothing is joined. Reducing before the
shuffle also means that an id held by a third of all rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, Window, functions as F

from rollbook.config import ENRICHMENT_SOURCES, IDENTITY_SOURCES
from rollbook.functions.text import literal
from rollbook.operators.groups import HEAVY_GROUPS, rows_of_groups
from rollbook.schema import (
    COMPLETENESS_COLUMNS,
    GOLDEN_COLUMNS,
    IDENTITY_COLUMNS,
    ORDINAL,
    PAYROLL_COLUMNS,
)

ID = "employee_id"
_SURVIVOR_KEY = ("source_system", "email", "hire_date")


def _from(sources: Sequence[str]) -> str:
    return f"source_system IN ({', '.join(map(literal, sources))})"


def identity_records(combined: DataFrame) -> DataFrame:
    rows = combined.filter(_from(IDENTITY_SOURCES))
    return rows.select(*IDENTITY_COLUMNS, *_ordinal(combined))


def enrichment_records(combined: DataFrame) -> DataFrame:
    return combined.filter(_from(ENRICHMENT_SOURCES))


def completeness(columns: Iterable[str]) -> str:
    """How many of the identity columns are filled in."""
    present = [c for c in COMPLETENESS_COLUMNS if c in set(columns)]
    return " + ".join(f"CAST({c} IS NOT NULL AS INT)" for c in present) or "0"


def _ordinal(df: DataFrame) -> list[str]:
    return [ORDINAL] if ORDINAL in df.columns else []


def _preference(df: DataFrame, columns: Sequence[str]) -> str:
    """A record whose smallest value is the survivor.

    Fuller rows first, then the source name, then the row order where a feed has one,
    then all other columns, so that no tie is left to chance.
    """
    rest = [c for c in columns if c not in (ID, "source_system")]
    fields = ["source_system", *_ordinal(df), *rest]
    return f"struct(-({completeness(columns)}) AS _emptiness, {', '.join(fields)})"


def _latest_pay(df: DataFrame) -> str:
    """A record whose largest value is the latest payroll row.

    Null is the smallest value, so undated rows come last; among equal dates the
    earlier row wins where the feed has a row order.
    """
    earlier = [f"-{c} AS _earlier" for c in _ordinal(df)]
    rest = [c for c in PAYROLL_COLUMNS if c != "compensation_effective_date"]
    return f"struct({', '.join(['compensation_effective_date', *earlier, *rest])})"


def surviving_identities(identities: DataFrame) -> DataFrame:
    """One identity row per employee id; rows without an id form one group."""
    columns = [c for c in identities.columns if c != ORDINAL]
    best = identities.groupBy(ID).agg(F.expr(f"min({_preference(identities, columns)}) AS _best"))
    return best.selectExpr([c if c == ID else f"_best.{c}" for c in columns])


def duplicate_identity_review(
    identities: DataFrame, heavy_groups: int = HEAVY_GROUPS
) -> DataFrame:
    """All rows of ids that occur more than once, and what became of them.

    ``kept_in_golden``: the row has the survivor's source, email and hire date, so several rows
    of an id may have it. ``is_survivor``: the row is the survivor; exactly one of an id is. Of
    rows that are equal word for word one has the mark, whichever, as nothing tells them
    apart: equal rows are counted together and written out again.
    """
    columns = [c for c in identities.columns if c != ORDINAL]
    groups = identities.groupBy(ID).agg(
        F.expr("count(*) AS n"),
        F.expr(f"min({_preference(identities, columns)}) AS _best"),
    )
    rows = rows_of_groups(identities.select(columns), groups, ID, "n > 1", heavy_groups)
    kept = " AND ".join(f"{c} <=> _best.{c}" for c in _SURVIVOR_KEY)
    survives = " AND ".join(f"{c} <=> _best.{c}" for c in columns if c != ID)
    marked = rows.selectExpr(*columns, f"({kept}) AS kept_in_golden", f"({survives}) AS _equal")
    alike = marked.groupBy(*columns, "kept_in_golden", "_equal").agg(F.expr("count(*) AS _n"))
    each = alike.selectExpr("*", "explode(sequence(1L, _n)) AS _copy")
    return each.selectExpr(
        *columns, "'hris_employee_id' AS duplicate_check", "kept_in_golden", "(_equal AND _copy = 1) AS is_survivor"
    )


def latest_payroll(enrichment: DataFrame) -> DataFrame:
    """The payroll row with the latest effective date for each id."""
    payroll = enrichment.filter("source_system = 'payroll'")
    latest = payroll.groupBy(ID).agg(F.expr(f"max({_latest_pay(payroll)}) AS _pay"))
    return latest.selectExpr(ID, *[f"_pay.{c}" for c in PAYROLL_COLUMNS])


def benefits_summary(enrichment: DataFrame) -> DataFrame:
    """Enrolled flag and earliest enrollment date for each id."""
    benefits = enrichment.filter(f"source_system = 'benefits' AND {ID} IS NOT NULL")
    return benefits.groupBy(ID).agg(
        F.expr("bool_or(true) AS benefits_enrolled"),
        F.expr("min(benefits_enrollment_date) AS benefits_enrollment_date"),
    )


def source_systems(combined: DataFrame) -> DataFrame:
    """Sorted, pipe-separated feeds in which each id occurs.

    Repeats are dropped before the shuffle; what is collected per id is the handful of
    feed names.
    """
    named = combined.select(ID, "source_system").dropna()
    return named.groupBy(ID).agg(
        F.expr("concat_ws('|', array_sort(collect_set(source_system))) AS source_systems")
    )


def golden_records(combined: DataFrame) -> DataFrame:
    """One trusted record per identity, enriched from payroll and benefits.

    ``combined`` holds the four configured feeds. An id found only in payroll or
    benefits makes no record; a record without an id is not enriched.
    """
    feeds = sorted(IDENTITY_SOURCES + ENRICHMENT_SOURCES)
    who = f"IF({_from(IDENTITY_SOURCES)}, {_preference(combined, IDENTITY_COLUMNS)}, NULL)"
    pay = f"IF(source_system = 'payroll', {_latest_pay(combined)}, NULL)"
    enrolled = "IF(source_system = 'benefits', benefits_enrollment_date, NULL)"
    grouped = combined.groupBy(ID).agg(
        F.expr(f"min({who}) AS _who"),
        F.expr(f"max({pay}) AS _pay"),
        F.expr(f"min({enrolled}) AS _enrolled"),
        *[F.expr(f"bool_or(source_system = {literal(f)}) AS _in_{f}") for f in feeds],
    )
    found_in = ", ".join(f"IF(_in_{f}, {literal(f)}, NULL)" for f in feeds)
    values = {
        ID: ID,
        **{c: f"_who.{c}" for c in IDENTITY_COLUMNS if c != ID},
        **{c: f"IF({ID} IS NULL, NULL, _pay.{c})" for c in PAYROLL_COLUMNS},
        "benefits_enrolled": f"{ID} IS NOT NULL AND _in_benefits",
        "benefits_enrollment_date": f"IF({ID} IS NULL, NULL, _enrolled)",
        "source_systems": f"IF({ID} IS NULL, _who.source_system, concat_ws('|', {found_in}))",
        "dedup_method": "'exact_employee_id'",
    }
    return grouped.filter("_who IS NOT NULL").selectExpr(
        *[f"{values[c]} AS {c}" for c in GOLDEN_COLUMNS]
    )


def ghost_records(combined: DataFrame, heavy_groups: int = HEAVY_GROUPS) -> DataFrame:
    """Enrichment rows whose id is missing or unknown to the identity feeds."""
    return _enrichment_rows(combined, "NOT _known", heavy_groups)


def matched_enrichment(combined: DataFrame, heavy_groups: int = HEAVY_GROUPS) -> DataFrame:
    """Enrichment rows whose id an identity feed knows."""
    return _enrichment_rows(combined, "_known", heavy_groups)


def _enrichment_rows(combined: DataFrame, keep: str, heavy_groups: int) -> DataFrame:
    # for each id: its enrichment rows, and whether an identity feed knows it
    groups = (
        combined.groupBy(ID)
        .agg(
            F.expr(f"count_if({_from(ENRICHMENT_SOURCES)}) AS n"),
            F.expr(f"bool_or({_from(IDENTITY_SOURCES)}) AS _identity"),
        )
        .filter("n > 0")
        .selectExpr(ID, "n", f"{ID} IS NOT NULL AND _identity AS _known")
    )
    rows = rows_of_groups(enrichment_records(combined), groups, ID, keep, heavy_groups)
    return rows.drop("_known", ORDINAL)


def observed_unique(df: DataFrame, key: str) -> tuple[DataFrame, Observation]:
    """``df``, and how many of its rows share their key with another (two missing keys are
    equal), counted while something else writes the rows.

    After an aggregate by the key the count needs no shuffle of its own.
    """
    seen = Observation()
    copies = F.count("*").over(Window.partitionBy(key))
    counted = df.withColumn("_copies", copies).observe(seen, F.expr("count_if(_copies > 1) AS repeated"))
    return counted.drop("_copies"), seen


def assert_unique(seen: Observation, key: str, name: str) -> None:
    """Raise when a key occurred twice in the rows that ``seen`` watched, which are written."""
    if seen.get["repeated"]:
        raise ValueError(f"{name} contains duplicate {key} values")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys that occur more than once, and how often."""
    return df.groupBy(key).agg(F.expr("count(*) AS occurrences")).filter("occurrences > 1")
