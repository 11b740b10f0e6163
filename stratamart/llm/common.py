"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

LAST_ID = (1 << 63) - 1
#: Rows of one hash slice of a hot group; layout only.
SLICE_ROWS = 100_000
#: Bytes of the Arrow batches in which whole texts go to Python, where a step says so; layout only.
BATCH_BYTES = 4_000_000
#: Salts that spread the rows of one hot key; layout only.
SALTS = 64


def key_of(column: str) -> Column:
    """An id that sorts: a null id becomes the largest long, `LAST_ID`, until `id_of` undoes it."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def id_of(column: str) -> Column:
    return F.nullif(F.col(column), F.lit(LAST_ID))


def slice_count(rows: int) -> int:
    return max(64, math.ceil(rows / SLICE_ROWS))


def text_key(column: str) -> Column:
    """A string that is never null and tells null from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))


def add_running(df: DataFrame, group: list[str], order: list[str], value: str, spread: list[str], slices: int,
                per_group: DataFrame | None = None) -> DataFrame:
    """Add `before`, the sum of `value` over the earlier rows of the group.

    The order is that of a hash of `spread` first (a shuffled order; `slices` of it are summed
    apart and then strung together) and of `order` within a slice, so one hot group is spread over
    `slices` tasks. `group` must hold no null. `per_group` adds columns of a table with one row per
    group; it meets the slices' sums, never the rows.
    """
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*spread), F.lit(slices)))
    keys = [*group, "_slice"]
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sliced.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    bases = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).cast("long")).drop("_sum")
    if per_group is not None:
        bases = bases.join(per_group, group)
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (sliced.join(bases, keys)
            .withColumn("before", F.col("_base") + F.coalesce(F.sum(value).over(within), F.lit(0)).cast("long"))
            .drop("_base", "_slice"))


def join_salted(rows: DataFrame, by: str | list[str], spread: str, table: DataFrame, salts: int = SALTS) -> DataFrame:
    """Left join `rows` to `table` (one row per `by`) when one key may hold a third of the rows.

    The distinct pairs of key and salt, at most `salts` per key, meet the table; the rows then meet
    those pairs, so a hot key is spread over `salts` keys. `by` must not be null.
    """
    by = [by] if isinstance(by, str) else by
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    pairs = salted.select(*by, "_salt").distinct().join(table, by, "left")
    return salted.join(pairs, [*by, "_salt"]).drop("_salt")


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int]:
    """The C library's way to return freed memory, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def give_back() -> None:
    """Return freed memory to the system: a worker lives on between tasks, beside those that work."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile hands rows to Python in Arrow batches of about `BATCH_BYTES`, not of 10,000 rows however wide:
    the executor's JVM and the worker both hold such a batch, and while it grows or the next one comes two of them."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`mapInArrow` for rows whose columns may have any names, dots included; the function sees them by these names."""
    names = df.columns

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return function(pa.RecordBatch.from_arrays(batch.columns, names) for batch in batches)

    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(named, schema)


def quoted(names: list[str]) -> list[Column]:
    """Columns of these very names, dots included."""
    return [F.col(f"`{name.replace('`', '``')}`") for name in names]


def ddl(fields: list[T.StructField]) -> str:
    """Names and types of fields of any names, as the schema text of `mapInArrow`."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)


def complete_groups(batches: Iterator[pa.RecordBatch], same: Callable[[pa.Table], int]) -> Iterator[pa.Table]:
    """Cut a task's sorted batches so that no group is split; `same` gives the row at which the last group starts."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        cut = same(table)
        if cut:
            yield table.slice(0, cut).combine_chunks()
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()
