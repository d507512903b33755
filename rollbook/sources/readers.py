"""Readers for the four feeds and the department lookup.

Nothing is inferred from the data: all fields are text (CSV reads the header line for
the column order). Each reader stamps ``source_system``. A path that does not exist
gives an empty frame of the right shape, and the run goes on.

No record is lost in silence: what a reader leaves out, and what it could read in part only,
is listed by ``malformed_records`` with its file and the reason.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

log = logging.getLogger(__name__)


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


CSV_IDENTITY_SCHEMA = _texts(
    "employee_id",
    "first_name",
    "last_name",
    "email",
    "department",
    "job_title",
    "hire_date",
    "country",
    "employment_type",
    "manager_id",
)
JSON_IDENTITY_SCHEMA = T.StructType(
    [
        T.StructField("employee_identifier", T.StringType()),
        T.StructField("name", _texts("first", "last", "full")),
        T.StructField("contact", _texts("email")),
        T.StructField(
            "assignment", _texts("department", "role", "location", "hire_timestamp")
        ),
        T.StructField("employment", _texts("type", "status")),
        T.StructField("manager_employee_id", T.StringType()),
    ]
)
PAYROLL_SCHEMA = _texts(
    "employee_id",
    "source",
    "base_salary",
    "currency",
    "pay_frequency",
    "bonus_target_pct",
    "effective_date",
)
BENEFITS_SCHEMA = _texts(
    "employee_id",
    "plan_type",
    "coverage_level",
    "enrollment_date",
    "premium_employee",
    "premium_employer",
)
DEPARTMENT_MAPPING_SCHEMA = _texts("source_system", "source_department", "standard_department")

# Texts that stand for "missing" in delimited files.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class SourceSpec:
    """Where a feed lies and how it is stored: csv, json, json_lines, xml or parquet.

    ``multi_line``: CSV values may contain line breaks; a file is then one unit of work.
    """

    path: str
    format: str
    multi_line: bool = False


# The formats of each feed that its reader knows.
FORMATS = {
    "globaltech_hris": ("csv",),
    "acquiredco_hris": ("json", "json_lines"),
    "payroll": ("csv", "parquet"),
    "benefits": ("xml",),
}
_MALFORMED = "_malformed"


def read_csv_identity(
    spark: SparkSession, path: str, name: str = "globaltech_hris", multi_line: bool = False
) -> DataFrame:
    return _stamp(_read_csv(spark, path, CSV_IDENTITY_SCHEMA, multi_line), name)


def read_json_identity(
    spark: SparkSession, path: str, name: str = "acquiredco_hris", lines: bool = False
) -> DataFrame:
    """Documents ``{"employees": [...]}`` or bare lists of records.

    One document per file, or one per line (``lines=True``; a line may also be a single
    record). A document is one unit of work, so a large export should come as lines,
    which Spark splits, or as a folder of pages. Fields are read as variants, whatever
    their shape: where a nested object is something else, the fields in it are null and
    the rest of the record stays. A malformed document gives no rows.
    """
    loaded = _load_documents(spark, path, lines)
    nested = {f.name: f.dataType.names for f in JSON_IDENTITY_SCHEMA if isinstance(f.dataType, T.StructType)}

    def record(field) -> Column:
        """The record as text fields, from the expression and path of each of its fields."""
        columns = []
        for f in JSON_IDENTITY_SCHEMA:
            if f.name in nested:
                parts = [F.try_variant_get(*field(f.name, n), "string").alias(n) for n in nested[f.name]]
                columns.append(F.struct(*parts).alias(f.name))
            else:
                columns.append(F.try_variant_get(*field(f.name), "string").alias(f.name))
        return F.struct(*columns)

    def listed(element: Column) -> Column:
        return record(lambda *names: (element, "$." + ".".join(names)))

    own = record(lambda name, *inner: (F.col(name), ".".join(("$", *inner))))
    records = F.when(F.col("employees").isNotNull(), F.transform(F.filter("employees", _is_object), listed)).when(
        _has_fields(), F.array(own)
    )
    return _stamp(loaded.select(F.inline(records)), name)


def _load_documents(spark: SparkSession, path: str, lines: bool) -> DataFrame:
    document = T.StructType(
        [T.StructField("employees", T.ArrayType(T.VariantType()))]
        + [T.StructField(f.name, T.VariantType()) for f in JSON_IDENTITY_SCHEMA]
        + [T.StructField(_MALFORMED, T.StringType())]
    )
    return _load(
        spark, document, "json", path, multiLine=not lines, columnNameOfCorruptRecord=_MALFORMED
    )


def _has_fields() -> Column:
    """Whether a document is a record itself: it has one of the fields, not just as null."""
    has = [F.col(f.name).isNotNull() & ~F.is_variant_null(f.name) for f in JSON_IDENTITY_SCHEMA]
    return reduce(Column.__or__, has)


def _is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT<")


def malformed_records(spark: SparkSession, sources: Mapping[str, SourceSpec]) -> DataFrame:
    """(source_system, file, reason, record): what could not be read, or only in part.

    The feeds hold what could be read of records listed as ``unreadable``, ``too few values``
    or ``open quote``; they do not hold the others. ``record`` is the record's text; it is
    null for a document without records.
    """
    found = spark.createDataFrame([], "source_system string, file string, reason string, record string")
    for name, spec in sources.items():
        if spec.format in ("json", "json_lines"):
            listed = _malformed_json(spark, spec)
        elif spec.format == "xml":
            listed = _malformed_xml(spark, spec)
        elif spec.format == "csv":
            schema = PAYROLL_SCHEMA if name == "payroll" else CSV_IDENTITY_SCHEMA
            listed = _malformed_csv(spark, spec, schema)
        else:
            continue
        found = found.unionByName(listed.select(F.lit(name).alias("source_system"), "file", "reason", "record"))
    return found


def _malformed_json(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    loaded = _with_file(_load_documents(spark, spec.path, spec.format == "json_lines"))
    empty = F.col("employees").isNull() & ~_has_fields()
    others = F.transform(
        F.filter("employees", lambda e: ~_is_object(e)), lambda e: F.struct(F.lit("not a record").alias("reason"), F.to_json(e).alias("record"))
    )
    whole = F.struct(
        F.when(F.col(_MALFORMED).isNotNull(), "unreadable").otherwise("no records").alias("reason"),
        F.col(_MALFORMED).alias("record"),
    )
    kinds = F.when(F.col(_MALFORMED).isNotNull() | empty, F.array(whole)).otherwise(others)
    return loaded.select("file", F.inline(kinds))


def _malformed_xml(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    schema = T.StructType([*BENEFITS_SCHEMA.fields, T.StructField(_MALFORMED, T.StringType())])
    loaded = _with_file(
        _load(spark, schema, "xml", spec.path, rowTag="enrollment", columnNameOfCorruptRecord=_MALFORMED)
    )
    listed = loaded.select("file", F.lit("unreadable").alias("reason"), _text_of("employee_id").alias("record"))
    return listed.filter("record IS NOT NULL")


def _text_of(field: str) -> Column:
    """The text of a malformed record. Spark parses records only if it is asked for a field of
    theirs too: no part of one."""
    return F.concat(F.col(_MALFORMED), F.substring(F.coalesce(F.col(f"`{field}`"), F.lit("")), 1, 0))


def _malformed_csv(spark: SparkSession, spec: SourceSpec, schema: T.StructType) -> DataFrame:
    frames = [
        _with_file(rows).select("file", _csv_fault(record := _text_of(rows.columns[0]), width).alias("reason"), record.alias("record"))
        for rows, width in _csv_by_header(spark, spec.path, schema, spec.multi_line)
    ]
    return reduce(DataFrame.unionByName, frames).filter("reason IS NOT NULL")


def _csv_fault(record: Column, width: int) -> Column:
    """What is wrong with a record that does not have ``width`` values; null for no record."""
    unquoted = F.regexp_replace(record, '"[^"]*"', "")
    values = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1
    return (
        F.when(record.isNull(), None)
        .when(F.contains(unquoted, F.lit('"')), "open quote")
        .when(values > width, "too many values")
        .otherwise("too few values")
    )


def _with_file(df: DataFrame) -> DataFrame:
    """The rows and the file of each; an empty frame that stands for a missing path has none."""
    if not df.inputFiles():
        return df.withColumn("file", F.lit(None).cast("string"))
    return df.withColumn("file", F.col("_metadata.file_path"))


def read_payroll(
    spark: SparkSession,
    path: str,
    format: str = "csv",
    name: str = "payroll",
    multi_line: bool = False,
) -> DataFrame:
    """The payroll table, landed as CSV or Parquet with the same columns."""
    if format == "csv":
        return _stamp(_read_csv(spark, path, PAYROLL_SCHEMA, multi_line), name)
    try:
        stored = spark.read.format(format).load(path)
    except AnalysisException as error:
        return _stamp(_empty(spark, PAYROLL_SCHEMA, path, error), name)
    columns = [
        F.col(f.name) if f.name in stored.columns else F.lit(None).cast("string").alias(f.name)
        for f in PAYROLL_SCHEMA
    ]
    return _stamp(stored.select(columns), name)


def read_benefits(spark: SparkSession, path: str, name: str = "benefits") -> DataFrame:
    """Every ``<enrollment>`` element at any depth; child elements become text columns."""
    rows = _load(spark, BENEFITS_SCHEMA, "xml", path, rowTag="enrollment", mode="PERMISSIVE")
    return _stamp(rows, name)


def read_department_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The department lookup. A missing file is an empty lookup, a missing column an error."""
    try:
        header = spark.read.option("header", True).csv(path)
    except AnalysisException as error:
        return _empty(spark, DEPARTMENT_MAPPING_SCHEMA, path, error)
    missing = set(DEPARTMENT_MAPPING_SCHEMA.names) - set(header.columns)
    if missing:
        raise ValueError(f"department mapping lacks columns: {sorted(missing)}")
    return header.select(
        [_present(F.col(name)).alias(name) for name in DEPARTMENT_MAPPING_SCHEMA.names]
    )


def load_sources(spark: SparkSession, sources: Mapping[str, SourceSpec]) -> dict[str, DataFrame]:
    """Read every configured feed; names without a reader are reported and left out.

    A format that a feed's reader does not know is an error, not a guess.
    """
    frames = {}
    for name, spec in sources.items():
        if name in FORMATS and spec.format not in FORMATS[name]:
            raise ValueError(f"{name}: format {spec.format!r} is none of {FORMATS[name]}")
        if name == "globaltech_hris":
            frames[name] = read_csv_identity(spark, spec.path, multi_line=spec.multi_line)
        elif name == "acquiredco_hris":
            lines = spec.format == "json_lines"
            frames[name] = read_json_identity(spark, spec.path, lines=lines)
        elif name == "payroll":
            frames[name] = read_payroll(
                spark, spec.path, spec.format, multi_line=spec.multi_line
            )
        elif name == "benefits":
            frames[name] = read_benefits(spark, spec.path)
        else:
            log.warning("no reader for source %s", name)
    return frames


def _stamp(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("source_system", F.lit(name))


def _read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """Columns are found by header name, in whatever order each file has them.

    The files of a folder may have different headers: those with the same one are read
    together, and each header by itself. A row with too few values has nulls for the rest; one
    with too many is left out, as its values cannot be told apart.
    """
    frames = [
        _by_header(rows.filter(~_csv_fault(_text_of(rows.columns[0]), width).eqNullSafe("too many values")), schema)
        for rows, width in _csv_by_header(spark, path, schema, multi_line)
    ]
    return reduce(DataFrame.unionByName, frames)


def _csv_by_header(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool
) -> list[tuple[DataFrame, int]]:
    """For each header below the path, the rows under it, with the text of those that do not
    fit it in a column of its own, and how many values the header has."""
    options = {"header": True, "encoding": "UTF-8", "escape": '"', "multiLine": multi_line}
    try:
        first = spark.read.options(**options).csv(path)
    except AnalysisException as error:
        missing = T.StructType([*schema.fields, T.StructField(_MALFORMED, T.StringType())])
        return [(_empty(spark, missing, path, error), len(schema))]
    out = []
    for files in _files_by_header(first, spark, path) or [path]:
        names = first.columns if files == path else spark.read.options(**options).csv(files).columns
        wide = _texts(*names, _MALFORMED)
        # all values are parsed: fewer than all would hide how many there are
        rows = spark.read.schema(wide).options(**options, columnNameOfCorruptRecord=_MALFORMED, columnPruning=False)
        out.append((rows.csv(files), len(names)))
    return out


def _files_by_header(first: DataFrame, spark: SparkSession, path: str) -> list[list[str]]:
    """The files below a path, those with the same first line together.

    A list of the files, and one line of each, come to the driver: as much as Spark's own
    listing of the folder brings there.
    """
    if len(first.inputFiles()) < 2:
        return []
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    heads = lines.filter("file_block_start = 0").groupBy("file_path").agg(F.first("value").alias("head"))
    files: dict[str, list[str]] = {}
    for row in heads.collect():
        files.setdefault(row["head"], []).append(row["file_path"])
    return [sorted(files[head]) for head in sorted(files)]


def _by_header(stored: DataFrame, schema: T.StructType) -> DataFrame:
    return stored.select(
        [
            _present(F.col(f"`{f.name}`")).alias(f.name)
            if f.name in stored.columns
            else F.lit(None).cast("string").alias(f.name)
            for f in schema
        ]
    )


def _present(value: Column) -> Column:
    return F.when(~value.isin(*MISSING_TEXTS), value)


def _load(spark: SparkSession, schema: T.StructType, format: str, path: str, **options):
    try:
        return spark.read.format(format).schema(schema).options(**options).load(path)
    except AnalysisException as error:
        return _empty(spark, schema, path, error)


def _empty(
    spark: SparkSession, schema: T.StructType, path: str, error: AnalysisException
) -> DataFrame:
    if error.getCondition() != "PATH_NOT_FOUND":
        raise error
    log.error("missing source file: %s", path)
    return spark.createDataFrame([], schema)
