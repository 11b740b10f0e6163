"""Checks a warehouse would enforce as constraints, run as jobs that return what they found."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from stratamart.operators.skew import fits_broadcast


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def key_check(df: DataFrame, key: str, table: str) -> DataFrame:
    """(table, key, rows, nulls, duplicates, min_key, max_key); a dense key has min 1 and max = rows."""
    copies = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    return copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_n"))), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum(F.when(F.col("_key").isNotNull(), F.col("_n") - 1)), F.lit(0)).alias("duplicates"),
        F.min("_key").alias("min_key"), F.max("_key").alias("max_key"),
    ).select(F.lit(table).alias("table"), F.lit(key).alias("key"), "*")


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows; empty means unique."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(key, rows): keys of the child that the parent lacks.

    The child is grouped by key first: a hot key is one row per task by the time it is shuffled,
    and the join needs no second shuffle of it.
    """
    used = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(parent_key).alias("_parent")).distinct()
    return used.join(known, F.col(key) == F.col("_parent"), "left_anti")


def foreign_key_check(child: DataFrame, key: str, parent: DataFrame, parent_key: str, label: str) -> DataFrame:
    """(reference, rows, nulls, orphan_keys, orphan_rows) in one aggregation."""
    used = child.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    known = parent.select(F.col(parent_key).alias("_parent")).where(F.col("_parent").isNotNull()).distinct()
    if not fits_broadcast(parent):  # a single column of it may seem to
        known = known.hint("merge")
    joined = used.join(known, F.col("_key") == F.col("_parent"), "left")
    orphan = F.col("_key").isNotNull() & F.col("_parent").isNull()
    return joined.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_n"))), F.lit(0)).alias("nulls"),
        F.count_if(orphan).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(orphan, F.col("_n"))), F.lit(0)).alias("orphan_rows"),
    ).select(F.lit(label).alias("reference"), "*")


def foreign_key_checks(child: DataFrame, parents: dict[str, tuple[DataFrame, str]], label: str) -> DataFrame:
    """`foreign_key_check` of several keys of one table: `parents` maps each key to a table and its key.

    Each key is a column of its own to a columnar store, so the keys together read the child once. A key's values are
    counted before they are shuffled (a hot value is one row per task), and meet the parent where they were counted; no
    row is copied per key.
    """
    return union_all([foreign_key_check(child, key, parent, parent_key, f"{label}.{key}")
                      for key, (parent, parent_key) in parents.items()])


def type_check(df: DataFrame, targets: dict[str, str]) -> DataFrame:
    """(column, target, rows, lossy): values that a cast to the target type would lose or change."""
    def lossy(name: str, target: str):
        column = F.col(name)
        back = column.try_cast(target).try_cast(df.schema[name].dataType)
        return F.count_if(column.isNotNull() & ~column.eqNullSafe(back))

    one_row = df.agg(F.count("*").alias("rows"), *[lossy(c, t).alias(c) for c, t in targets.items()])
    kinds = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])
    return one_row.unpivot("rows", list(targets), "column", "lossy").select(
        "column", kinds[F.col("column")].alias("target"), "rows", "lossy")


def width_check(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """(column, max_width, longest, too_long) in one pass."""
    columns = [c for c in widths if c in df.columns]
    one_row = df.agg(F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.lit(widths[c]).alias("max_width"),
            F.max(F.length(c)).alias("longest"), F.count_if(F.length(c) > widths[c]).alias("too_long"),
        ) for c in columns
    ]).alias("_checks"))
    return one_row.select(F.explode("_checks").alias("_c")).select("_c.*")


def table_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(camada, tabela, registros), one row per (layer, table)."""
    return union_all([
        df.agg(F.count("*").alias("registros"))
        .select(F.lit(layer).alias("camada"), F.lit(table).alias("tabela"), "registros")
        for (layer, table), df in tables.items()
    ])


def reconcile(tables: dict[str, DataFrame], expected: str) -> DataFrame:
    """(table, rows, expected_rows, matches): every table against the one named `expected`."""
    want = tables[expected].agg(F.count("*")).scalar()
    return union_all([
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()
    ]).withColumn("expected_rows", want).withColumn("matches", F.col("rows") == F.col("expected_rows"))


def conforms(df: DataFrame, schema: T.StructType) -> list[str]:
    """Columns that are missing or of another type; empty means the table has the schema."""
    have = {f.name.lower(): f.dataType for f in df.schema.fields}
    return [f.name for f in schema.fields if have.get(f.name.lower()) != f.dataType]
