"""Intermediate tables written once to the folder all executors share.

Some operators need a result to be computed exactly once (surrogate keys) or need Catalyst
to see the true size of an intermediate (small aggregates joined back to a large table).
Both are served by writing the intermediate as Parquet and reading it back: the lineage is
cut, lost executors cost nothing, and the size check of the automatic broadcast works on
real file sizes instead of guesses.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, tempfile.TemporaryDirectory] = {}

# Called when the staged tables are deleted, by those who remember some of them.
on_clear: list[Callable[[], None]] = []

# What the load that runs has staged, if it is one that deletes that.
_passing: ContextVar[list[str] | None] = ContextVar("_passing", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder for this application's staged tables.

    A cluster names it in `spark.checkpoint.dir`. Only a local master may do without.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        if context.applicationId not in _local_folders:
            _local_folders[context.applicationId] = tempfile.TemporaryDirectory(
                prefix="stratamart-", ignore_cleanup_errors=True
            )
        base = _local_folders[context.applicationId].name
    return f"{base.rstrip('/')}/stratamart/{context.applicationId}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and return a scan of what was written."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{label}-{uuid.uuid4().hex}"
    if (passed := _passing.get()) is not None:
        passed.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """For a load that returns nothing but scans of what it wrote: what it stages is deleted when it ends, and each
    query's shuffle files when that query ends. Else the former stay until `clear`, the latter until the driver
    happens to collect its garbage, and a chain of loads needs the disk of all of them at once."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    token = _passing.set(staged := [])
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
        _passing.reset(token)
        for path in staged:
            _delete(spark, path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Delete this application's staged tables; call it when no result is needed any more."""
    for forget in on_clear:
        forget()
    _delete(spark, shared_folder(spark))
