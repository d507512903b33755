"""The tables behind the published charts. Each is an aggregate of the golden table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from rollbook.functions.values import as_of_date
from rollbook.staging import Stage

# Accuracy of the sketches that bracket quartiles: with this many items a rank is off by less
# than a thousandth of all rows, almost always.
SKETCH_ITEMS = 4096
RANK_SLACK = 0.002
# Amounts below are exact in decimals, cents and their small multiples included.
EXACT_BELOW = 1e28


def headcount_by_department(golden: DataFrame) -> DataFrame:
    return _headcount(golden, "department_standardized").orderBy(
        "employee_count", "department_standardized"
    )


def headcount_by_country(golden: DataFrame, top_n: int = 15) -> DataFrame:
    """The ``top_n`` largest countries; names break ties."""
    counts = _headcount(golden, "country")
    largest = counts.orderBy(F.desc("employee_count"), "country").limit(top_n)
    return largest.orderBy("employee_count", F.desc("country"))


def _headcount(golden: DataFrame, column: str) -> DataFrame:
    named = F.expr(f"coalesce({column}, 'Unknown') AS {column}")
    return golden.groupBy(named).agg(F.expr("count(*) AS employee_count"))


def benefits_rate_by_department(golden: DataFrame) -> DataFrame:
    rate = "avg(CAST(coalesce(benefits_enrolled, false) AS INT)) AS enrollment_rate"
    return (
        golden.filter("department_standardized IS NOT NULL")
        .groupBy("department_standardized")
        .agg(F.expr(rate))
        .orderBy("enrollment_rate", "department_standardized")
    )


def salary_box(golden: DataFrame) -> DataFrame:
    """Exact quartiles, 1.5 IQR whiskers and outlier count of salary by employment type.

    A first pass over the salaries, which are staged, makes a sketch per type; it brackets the
    values at the ranks that the quartiles need. A second pass counts what lies below each
    bracket and the different values within, some thousandths of the rows, and so settles
    the ranks. If a sketch missed, which the counts show, a further pass takes the whole side
    that the rank lies on. No type's salaries are ever gathered or sorted in one place, and
    the brackets stay tables, joined by type, however many types there are.

    Any amount counts. Quartiles between two values are interpolated in whole cents, as
    decimals, where all salaries of the type are below EXACT_BELOW, and as doubles otherwise.
    """
    stage = Stage(golden.sparkSession)
    salaries = stage.table(
        "salaries",
        golden.selectExpr("employment_type", "CAST(salary_usd_annual AS DOUBLE) AS _salary").filter(
            "_salary IS NOT NULL AND NOT isnan(_salary) AND employment_type IS NOT NULL"
        ),
    )
    sketched = salaries.groupBy("employment_type").agg(
        F.expr("count(*) AS employee_count"),
        F.expr("min(_salary) AS _min"),
        F.expr("max(_salary) AS _max"),
        F.expr(f"kll_sketch_agg_double(_salary, {SKETCH_ITEMS}) AS _sketch"),
    )
    fenced = stage.table("quartiles", _with_fences(_quartiles(salaries, stage.table("sketched", sketched), stage)))
    inside = "IF(_exact, 8 * try_cast(_salary AS DECIMAL(30, 2)) BETWEEN _floor AND _ceiling, 8 * _salary BETWEEN _floor_d AND _ceiling_d)"
    box = (
        salaries.join(fenced, "employment_type")
        .groupBy("employment_type", "employee_count", "_q1", "_q2", "_q3")
        .agg(
            F.expr(f"min(_salary) FILTER (WHERE {inside}) AS _low"),
            F.expr(f"max(_salary) FILTER (WHERE {inside}) AS _high"),
            F.expr(f"count_if(NOT ({inside})) AS outlier_count"),
        )
    )
    return box.selectExpr(
        "employment_type",
        "employee_count",
        "_q1 AS q1",
        "_q2 AS median",
        "_q3 AS q3",
        # a whisker never ends inside the box
        "least(_low, _q1) AS whisker_low",
        "greatest(_high, _q3) AS whisker_high",
        "outlier_count",
    ).orderBy("employment_type")


def _quartiles(salaries: DataFrame, sketched: DataFrame, stage: Stage) -> DataFrame:
    """For each type and quarter the values at the rank below it and at the next one."""
    position = "_quarter * (employee_count - 1)"
    # sketches are asked for given ranks only; of few rows the whole range is the bracket
    few = f"employee_count <= {SKETCH_ITEMS}"

    def asked(sign: int, otherwise: str) -> str:
        at = [f"kll_sketch_get_quantile_double(_sketch, {q / 4 + sign * RANK_SLACK}D)" for q in (1, 2, 3)]
        return f"IF({few}, {otherwise}, CASE _quarter WHEN 1 THEN {at[0]} WHEN 2 THEN {at[1]} ELSE {at[2]} END)"

    low, high = asked(-1, "_min"), asked(1, "_max")
    wanted = stage.table(
        "wanted",
        sketched.selectExpr("*", "explode(array(1, 2, 3)) AS _quarter")
        .selectExpr("*", f"{position} % 4 AS _part", f"{position} div 4 AS _rank", f"least({position} div 4 + 1, employee_count - 1) AS _next")
        .selectExpr(
            "employment_type", "employee_count", "_min", "_max", "_quarter", "_part", "_rank", "_next",
            f"greatest({low}, _min) AS _from", f"least({high}, _max) AS _to",
        ),
    )
    settled = stage.table("settled", _settle(salaries, wanted))
    missed = settled.filter("_value IS NULL OR _value_next IS NULL")
    if not missed.isEmpty():
        # the whole range of the few types whose bracket missed
        again = wanted.join(missed.select("employment_type", "_quarter"), ["employment_type", "_quarter"], "left_semi")
        again = again.withColumn("_from", F.col("_min")).withColumn("_to", F.col("_max"))
        found = settled.filter("_value IS NOT NULL AND _value_next IS NOT NULL")
        settled = stage.table("settled_again", found.unionByName(_settle(salaries, again)))
    return settled


def _settle(salaries: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` with the values at its ranks; null for a rank outside of its bracket."""
    brackets = wanted.groupBy("employment_type").agg(
        F.expr("collect_list(struct(_quarter, _from, _to)) AS _brackets")  # three at most
    )
    cells = (
        salaries.join(brackets, "employment_type")
        .selectExpr("employment_type", "_salary", "inline(_brackets)")
        .filter("_salary <= _to")
        .groupBy("employment_type", "_quarter", F.expr("IF(_salary < _from, NULL, _salary) AS _cell"))
        .agg(F.expr("count(*) AS _n"))
    )
    upward = Window.partitionBy("employment_type", "_quarter").orderBy(F.asc_nulls_first("_cell"))
    ranked = cells.withColumn("_upto", F.sum("_n").over(upward)).filter("_cell IS NOT NULL")
    holds = "{r} < _upto AND {r} >= _upto - _n"
    keys = ["employment_type", "_quarter"]
    columns = wanted.columns
    return (
        wanted.join(ranked, keys, "left")
        .groupBy(*columns)
        .agg(
            F.expr(f"max(_cell) FILTER (WHERE {holds.format(r='_rank')}) AS _value"),
            F.expr(f"max(_cell) FILTER (WHERE {holds.format(r='_next')}) AS _value_next"),
        )
    )


def _with_fences(quartiles: DataFrame) -> DataFrame:
    """One row per type: the quartiles, and the bounds of what is no outlier, times 8.

    In decimals the quartiles are whole quarter cents, so nothing is rounded before the end.
    """
    kind = "DECIMAL(33, 2)"
    exact = f"abs(_min) < {EXACT_BELOW}D AND abs(_max) < {EXACT_BELOW}D"
    as_cents = "CAST(try_cast({v} AS DECIMAL(30, 2)) AS DECIMAL(33, 2))"
    quarters = (
        f"CAST(4 * {as_cents.format(v='_value')} + ({as_cents.format(v='_value_next')} - {as_cents.format(v='_value')}) * _part AS {kind})"
    )
    each = quartiles.selectExpr(
        "employment_type", "employee_count", "_quarter", f"({exact}) AS _exact",
        f"IF({exact}, {quarters}, NULL) AS _quarters",
        "_value + (_value_next - _value) * (_part / 4D) AS _double",
    )
    pick = "max({v}) FILTER (WHERE _quarter = {q}) AS {n}{q}"
    wide = each.groupBy("employment_type", "employee_count", "_exact").agg(
        *[F.expr(pick.format(v="_quarters", q=q, n="_k")) for q in (1, 2, 3)],
        *[F.expr(pick.format(v="_double", q=q, n="_d")) for q in (1, 2, 3)],
    )
    return wide.selectExpr(
        "employment_type",
        "employee_count",
        "_exact",
        # dollars: four hundred of the whole number of quarter cents
        *[f"IF(_exact, CAST(_k{q} * 100 AS DOUBLE) / 400, _d{q}) AS _q{q}" for q in (1, 2, 3)],
        "2 * _k1 - 3 * (_k3 - _k1) AS _floor",
        "2 * _k3 + 3 * (_k3 - _k1) AS _ceiling",
        "8 * (_d1 - 1.5D * (_d3 - _d1)) AS _floor_d",
        "8 * (_d3 + 1.5D * (_d3 - _d1)) AS _ceiling_d",
    )


def tenure_histogram(
    golden: DataFrame, as_of: dt.date | None = None, bins: int = 30
) -> DataFrame:
    """Counts in ``bins`` equal-width bins of tenure years; the last bin is closed.

    Tenure is a whole number of days, so rows shrink to one per day of the calendar (a
    few ten thousand for cleaned dates); their range is an aggregate of that table, one row.
    Bin membership is decided in whole days, without rounding.
    """
    # a hire later in the day leaves one whole day less
    late = "CAST(hire_date > CAST(CAST(hire_date AS DATE) AS TIMESTAMP_NTZ) AS INT)"
    days = f"datediff(CAST({as_of_date(as_of)} AS DATE), CAST(hire_date AS DATE)) - {late}"
    daily = (
        golden.filter("hire_date IS NOT NULL")
        .groupBy(F.expr(f"{days} AS _days"))
        .agg(F.expr("count(*) AS _n"))
    )
    ranged = daily.withColumns(
        {"_low": daily.agg(F.min("_days")).scalar(), "_high": daily.agg(F.max("_days")).scalar()}
    )
    # with a single value the range is taken as half a year to each side of it
    place = f"IF(_low = _high, {bins // 2}, (_days - _low) * {bins} div (_high - _low))"
    filled = ranged.groupBy(
        "_low", "_high", F.expr(f"CAST(least({place}, {bins - 1}) AS INT) AS bin")
    ).agg(F.expr("sum(_n) AS _n"))
    counts = filled.groupBy("_low", "_high").agg(
        F.expr("map_from_entries(collect_list(struct(bin, _n))) AS _counts")
    )
    start = "(_low / 365.25D - IF(_low = _high, 0.5D, 0D))"
    end = "(_high / 365.25D + IF(_low = _high, 0.5D, 0D))"
    width = f"({end} - {start}) / {bins}"
    return (
        counts.selectExpr("*", f"explode(sequence(0, {bins - 1})) AS bin")
        .selectExpr(
            "bin",
            f"round({start} + {width} * bin, 6) AS from_years",
            f"round({start} + {width} * (bin + 1), 6) AS to_years",
            "coalesce(try_element_at(_counts, bin), 0L) AS employee_count",
        )
        .orderBy("bin")
    )


def quality_series(report: DataFrame) -> DataFrame:
    """The validation report as two series, passed and failed, per check."""
    series = ", ".join(f"struct('{s}' AS series, {s} AS row_count)" for s in ("passed", "failed"))
    return report.selectExpr("check", f"inline(array({series}))")
