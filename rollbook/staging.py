"""Tables written once and read by several later steps.

A staged table cuts the lineage: what is read several times is computed once, and a
lost executor costs a re-read, not a re-run. The folder is the shared one the session
names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DIR_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The session's shared folder. Only a local session may do without one."""
    context = spark.sparkContext
    folder = spark.conf.get(_DIR_KEY, None) or context.getConf().get(_DIR_KEY)
    folder = folder or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_DIR_KEY} to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="rollbook-")
    spark.conf.set(_DIR_KEY, folder)
    return folder


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Stage:
    """A fresh sub-folder for the tables of one run."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self._spark = spark
        self.folder = folder or f"{shared_folder(spark)}/rollbook/{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def remove(self) -> None:
        """Deletes the tables; nothing may read them any more."""
        remove(self._spark, self.folder)

    def table(self, name: str, df: DataFrame) -> DataFrame:
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)
