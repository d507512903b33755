"""Session settings the operators rely on, and a local session for tests and benches."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Adaptive execution sizes partitions and splits hot ones while a query runs.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: str | None = None, **extra: str) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("rollbook")
    local = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
    }
    for key, value in {**SETTINGS, **local, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
