"""Writers of the published outputs."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from rollbook.operators.export import golden_export
from rollbook.staging import remove


def write_golden(golden: DataFrame, path: str) -> str:
    """Publishes the golden table as a new version below ``path``; returns the version.

    A version is a folder of Parquet files, one folder per company in it. The list of published
    versions gets its row only when all files are there, so a run that dies while it writes
    leaves the last version in force, and nobody reads half a table. Versions before the last
    two are removed; a reader may still be at the one before.
    """
    spark = golden.sparkSession
    number = max([n for n, _ in _published(spark, path)], default=0) + 1
    version = f"{number:06d}-{uuid.uuid4().hex}"
    golden_export(golden).write.partitionBy("company_origin").parquet(f"{path}/versions/{version}")
    row = spark.createDataFrame([(number, version)], _PUBLISHED)
    row.coalesce(1).write.mode("append").parquet(f"{path}/published")
    for _, old in sorted(_published(spark, path))[:-2]:
        remove(spark, f"{path}/versions/{old}")
    return version


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """The version of the golden table that was published last."""
    published = _published(spark, path)
    if not published:
        raise FileNotFoundError(f"no golden table is published below {path}")
    return spark.read.parquet(f"{path}/versions/{max(published)[1]}")


_PUBLISHED = "number int, version string"


def _published(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    try:
        rows = spark.read.schema(_PUBLISHED).parquet(f"{path}/published").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [tuple(r) for r in rows]


def write_review(
    review: DataFrame, path: str, order_by: Sequence[str] = (), compression: str = "none"
) -> None:
    """A review table as CSV with a header, which an empty table has too.

    ``order_by`` sorts the rows across the files; end it with a column that differs
    from row to row, so that equal leading values can be spread over several files.
    ``compression`` is a codec of Spark's CSV writer, whose readers tell it by the file name.
    """
    rows = review.orderBy(*order_by) if order_by else review
    # blanks are part of a value, and quotes are doubled, not escaped
    options = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "compression": compression}
    rows.write.mode("overwrite").options(header=True, escape='"', **options).csv(path)


def write_report(report: DataFrame, path: str) -> None:
    """The validation report: one small CSV file, in rule order."""
    write_review(report.coalesce(1), path)
