"""Dense surrogate keys 1..N without a single-task sort."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window, functions as F

from stratamart.staging import materialize

# monotonically_increasing_id puts the partition above bit 33 and the row position below.
_POSITION_BITS = 33
# Stretches of files, by the first bits of their hash, and the files whose offsets (24 bytes each) may be broadcast.
_STRETCH_BITS = 10
_MOST_BROADCAST = 1 << 21


def dense_key(df: DataFrame, key: str, order_by: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """Prefix `df` with a dense BIGINT `key`.

    With `order_by` the key is the rank of the row in that order (nulls first); the columns must
    identify the row, which also keeps the range partitions even. Without it rows are numbered as
    they lie and nothing is shuffled, so repeated rows cannot pile up in one task.

    Partition and position are stored with the rows, so the per-partition counts and the final
    keys come from one execution whatever is retried. One count per written partition is summed on the
    driver and joined back; their number is that of the write's tasks, which the driver knows one by one anyway. A
    stored Parquet table is numbered more cheaply by `file_key`.
    """
    ordered = df
    if order_by:
        order = [F.col(c).asc_nulls_first() for c in order_by]
        ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    staged = materialize(ordered.withColumn("_slot", F.monotonically_increasing_id()), key)
    located = staged.withColumn("_part", F.shiftright("_slot", _POSITION_BITS)).withColumn(
        "_position", F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
    # One number per task of the write above.
    counts = sorted(tuple(r) for r in located.groupBy("_part").count().collect())
    ends = list(accumulate(n for _, n in counts))
    offsets = df.sparkSession.createDataFrame([(p, end - n) for (p, n), end in zip(counts, ends)], "_part long, _offset long")
    keyed = located.join(F.broadcast(offsets), "_part").withColumn(key, F.col("_offset") + F.col("_position") + 1)
    return keyed.select(key, *df.columns)


def file_key(stored: DataFrame, key: str) -> DataFrame:
    """Prefix a stored Parquet table with a dense BIGINT `key` in storage order.

    Parquet scans know the file and the position of every row, so neither a shuffle nor another
    copy of the table is needed. `stored` must be the scan itself or columns of it.
    """
    located = stored.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return located_key(located, key)


def located_key(rows: DataFrame, key: str) -> DataFrame:
    """`file_key` for rows that carry their `_file` and `_row`.

    A file goes by two hashes of its path, so rows carry and compare numbers; the counts check that each pair of
    hashes stands for one path. Offsets are written once and broadcast if they are known to be few enough, else
    joined.
    """
    kept = [c for c in rows.columns if c not in ("_file", "_row")]
    hashed = rows.withColumns({"_part": F.xxhash64("_file"), "_other": F.xxhash64(F.lit(1), "_file")})
    offsets = materialize(_offsets(file_counts(rows), ["_part", "_other"]), "file_offsets")
    side = F.broadcast(offsets) if offsets.count() <= _MOST_BROADCAST else offsets
    return hashed.join(side, ["_part", "_other"]).withColumn(key, F.col("_offset") + F.col("_row") + 1).select(key, *kept)


def file_counts(rows: DataFrame) -> DataFrame:
    """Per `_file`, named by two hashes of its path: its rows. Rows are counted by path, one group per file, and hashes are
    compared among files, so no task sorts or holds rows."""
    files = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    hashed = files.select(F.xxhash64("_file").alias("_part"), F.xxhash64(F.lit(1), "_file").alias("_other"), "_n")
    one_path = F.when(F.count("*") == 1, F.sum("_n")).otherwise(F.raise_error(F.lit("two files of one hash")).cast("long"))
    return hashed.groupBy("_part", "_other").agg(one_path.alias("_rows"))


def _offsets(counts: DataFrame, part: list[str]) -> DataFrame:
    """Per part, named by hashes, the `_offset`: the rows (`_rows`) of all parts before it.

    Stretches of parts, by the first bits of the first hash, are summed, then the parts within each: no task sees more
    than the parts of one stretch, or one sum per stretch.
    """
    dealt = counts.withColumn("_stretch", F.shiftrightunsigned(part[0], 64 - _STRETCH_BITS))
    sums = dealt.groupBy("_stretch").agg(F.sum("_rows").alias("_sum"))
    every = sums.agg(F.collect_list(F.struct("_stretch", "_sum")).alias("_all"))
    earlier = F.aggregate(F.filter("_all", lambda s: s["_stretch"] < F.col("_one._stretch")), F.lit(0).cast("long"), lambda n, s: n + s["_sum"])
    bases = every.select("_all", F.explode("_all").alias("_one")).select(F.col("_one._stretch").alias("_stretch"), earlier.alias("_base"))
    within = Window.partitionBy("_stretch").orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumn("_within", F.coalesce(F.sum("_rows").over(within), F.lit(0)))
    return inside.join(bases, "_stretch").select(*part, (F.col("_base") + F.col("_within")).alias("_offset"))
