"""Session settings the jobs are written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Everything here is a Spark default or a runtime setting, so a cluster session that was
# created elsewhere works as well; `local_session` only serves tests and the bench.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", app: str = "stratamart", **extra: str) -> SparkSession:
    """A single-JVM session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    partitions = str(os.cpu_count() if cpus == "*" else cpus)
    settings = SETTINGS | {
        "spark.sql.shuffle.partitions": partitions,
        "spark.driver.memory": "12g",
        # Small local files: split them over the cores, and build no large hash table on one thread.
        "spark.sql.files.openCostInBytes": "512KB",
        "spark.sql.autoBroadcastJoinThreshold": "1MB",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
    } | extra
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
