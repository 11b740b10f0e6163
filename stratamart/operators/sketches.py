"""Profiles of tables that grow: sketches of each load, stored and merged without a look at earlier rows.

Quantiles come from KLL sketches, distinct counts from HyperLogLog sketches, both Spark's own. A sketch has a fixed
size, so a profile costs one pass over the new rows and one row per load and column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: log2 of the registers of a distinct-count sketch: its relative standard error is 1.04 / sqrt(2 ** DISTINCT_BITS), 0.8 %.
DISTINCT_BITS = 14


def sketch_size(accuracy: int) -> int:
    """The size of a KLL sketch whose ranks are off by less than 1 / `accuracy` of the rows, 99 times in a hundred."""
    # The fitted constants of the sketch's published rank error, 2.296 / k ** 0.9021.
    return min(65_535, max(8, math.ceil((2.296 * accuracy) ** (1 / 0.9021))))


def rank_error(accuracy: int) -> float:
    """The error that a sketch for `accuracy` keeps to."""
    return 2.296 / sketch_size(accuracy) ** 0.9021


def sketched(df: DataFrame, numbers: Sequence[str] = (), texts: Sequence[str] = (), groups: Sequence[str] = (),
             accuracy: int = 200) -> DataFrame:
    """(groups, column, rows, nulls, low, high, total, quantiles, distinct): one row per column, in one pass.

    `numbers` get both sketches, `texts` that of their distinct values only. Nulls and NaN count as nulls and take no
    other part. A column without values has null sketches, which merge as nothing.
    """
    size = sketch_size(accuracy)

    def number(name: str) -> Column:
        value = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
        return F.struct(F.lit(name).alias("column"), F.count("*").alias("rows"), F.count_if(value.isNull()).alias("nulls"),
                        F.min(value).alias("low"), F.max(value).alias("high"), F.sum(value).alias("total"),
                        F.when(F.count(value) > 0, F.kll_sketch_agg_double(value, size)).alias("quantiles"),
                        F.when(F.count(value) > 0, F.hll_sketch_agg(value.cast("string"), DISTINCT_BITS)).alias("distinct"))

    def text(name: str) -> Column:
        value, none = F.col(name).cast("string"), F.lit(None)
        return F.struct(F.lit(name).alias("column"), F.count("*").alias("rows"), F.count_if(value.isNull()).alias("nulls"),
                        none.cast("double").alias("low"), none.cast("double").alias("high"), none.cast("double").alias("total"),
                        none.cast("binary").alias("quantiles"),
                        F.when(F.count(value) > 0, F.hll_sketch_agg(value, DISTINCT_BITS)).alias("distinct"))

    profiled = df.groupBy(*groups).agg(F.array(*map(number, numbers), *map(text, texts)).alias("_all"))
    return profiled.select(*groups, F.inline("_all"))


def merged(sketches: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """One row per group and column from those of several loads."""
    quantiles, distinct = F.col("quantiles"), F.col("distinct")
    return sketches.groupBy(*groups, "column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("total").alias("total"), F.when(F.count(quantiles) > 0, F.kll_merge_agg_double(quantiles)).alias("quantiles"),
        F.when(F.count(distinct) > 0, F.hll_union_agg(distinct)).alias("distinct"))


def profile_of(sketches: DataFrame, shares: dict[str, float], groups: Sequence[str] = ()) -> DataFrame:
    """(groups, column, rows, nulls, mean, min, max, `shares`..., distinct): what merged sketches say.

    A quantile is a value of the table whose rank is off by the sketch's error at most; `distinct` is an estimate.
    """
    present = F.col("quantiles").isNotNull()
    quantile = [F.when(present, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(q)))).alias(name) for name, q in shares.items()]
    return sketches.select(*groups, "column", "rows", "nulls", (F.col("total") / F.nullif(F.col("rows") - F.col("nulls"), F.lit(0))).alias("mean"),
                           F.col("low").alias("min"), F.col("high").alias("max"), *quantile,
                           F.when(F.col("distinct").isNotNull(), F.hll_sketch_estimate("distinct")).otherwise(F.lit(0)).cast("long").alias("distinct"))


def sketched_quantiles(df: DataFrame, value: str, shares: dict[str, float], groups: Sequence[str] = (), accuracy: int = 200) -> DataFrame:
    """Columns named by `shares` per group, from one sketch per group."""
    found = sketched(df, [value], (), groups, accuracy)
    return profile_of(found, shares, groups).select(*groups, *shares)


def rank_errors(df: DataFrame, profile: DataFrame, shares: dict[str, float]) -> DataFrame:
    """(column, share, error): how far the rank of each quantile in a profile (of no groups) is from the wanted one, as a
    share of the rows. A value that occurs often covers a range of ranks; the nearest of them counts."""
    rows = {r["column"]: r for r in profile.collect()}  # one row per column
    tests = []
    for column, row in rows.items():
        value = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
        for name, share in shares.items():
            if row[name] is not None:
                below, upto = F.count_if(value < row[name]), F.count_if(value <= row[name])
                wanted = F.lit(float(share)) * F.count(value)
                off = F.greatest(below - wanted, wanted - upto, F.lit(0.0)) / F.count(value)
                tests.append(F.struct(F.lit(column).alias("column"), F.lit(name).alias("share"), off.alias("error")))
    return df.agg(F.array(*tests).alias("_all")).select(F.inline("_all"))
