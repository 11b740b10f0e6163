"""Incremental bronze loads: new landing files only, each exactly once."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession, functions as F, types as T

from stratamart.functions.cleaning import fill_missing
from stratamart.schemas import LISTING
from stratamart.sources.readers import checked, csv_text, field_fault, read_raw_csv


def _unless_empty(read, otherwise):
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return otherwise
        raise


def append_new_files(spark: SparkSession, landing: str, table_path: str, progress_path: str,
                     columns: list[str] | None = None, fills: dict[str, object] | None = None,
                     multiline: bool = True) -> int:
    """Append the rows of CSV files not seen before to a bronze table; returns the rows added.

    `columns` is the column order of the files, by default that of their header; a new file with another
    header fails the load, as does a row that cannot be read whole (see `read_flat`). The file source keeps
    its progress in `progress_path` (a shared folder), so a rerun after a failure neither skips nor
    repeats a file. The rows are counted in the table, whose files know their number.
    """
    header = columns or _unless_empty(lambda: read_raw_csv(spark, landing, multiline).columns, LISTING.fieldNames())
    before = _unless_empty(lambda: spark.read.parquet(table_path).count(), 0)
    raw = csv_text(spark.readStream, header, multiline).csv(landing).withColumn(
        "_source_file", F.col("_metadata.file_name"))
    kept = T.StructType(LISTING.fields + [T.StructField("_source_file", T.StringType())])
    rows = fill_missing(checked(raw, kept, field_fault(LISTING)), fills)
    query = (
        rows.withColumn("_ingestion_timestamp", F.current_timestamp())
        .writeStream.format("parquet").option("path", table_path).option("checkpointLocation", progress_path)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return _unless_empty(lambda: spark.read.parquet(table_path).count(), 0) - before
