"""Exact interpolated quantiles, globally or per group, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratamart.staging import materialize


def value_counts_sorted(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """Stored table of (groups, value, _n, _part): copies per value, range-partitioned by group and value.

    Equal values collapse before the shuffle, and a large group spreads over several partitions.
    """
    counts = (
        df.select(*groups, F.col(value).cast("double").alias(value)).where(F.col(value).isNotNull())
        .groupBy(*groups, value).agg(F.count("*").alias("_n"))
    )
    order = [*groups, value]
    ordered = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ordered.withColumn("_part", F.spark_partition_id()), "value_counts")


def quantiles_of_counts(counts: DataFrame, value: str, quantiles: dict[str, float],
                        groups: Sequence[str] = ()) -> DataFrame:
    """Columns named by `quantiles` per group, from the table of `value_counts_sorted`.

    The copies per (group, partition) slice tell which slices hold a wanted rank. Only those are
    numbered value by value, each slice on its own, so no task ever sees a whole large group.
    """
    groups = list(groups)
    total = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = total.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    slices = counts.groupBy(*groups, "_part").agg(F.sum("_n").alias("_copies")).select(
        *groups, "_part", "_copies",
        F.coalesce(F.sum("_copies").over(before), F.lit(0)).alias("_before"),
        F.sum("_copies").over(total).alias("_total"),
    )

    def wanted(name: str, share: float) -> list[Column]:
        position = F.lit(float(share)) * (F.col("_total") - 1)
        low = F.floor(position).cast("long")
        weight = position - low
        return [
            F.struct(F.lit(name).alias("name"), F.lit(0).alias("upper"), low.alias("rank"), weight.alias("weight")),
            F.struct(F.lit(name).alias("name"), F.lit(1).alias("upper"),
                     F.ceil(position).cast("long").alias("rank"), weight.alias("weight")),
        ]

    ranks = F.array(*[w for name, share in quantiles.items() for w in wanted(name, share)])
    end = F.col("_before") + F.col("_copies")
    picked = slices.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col("_part").alias("_slice"), F.col("_before"),
        F.filter(ranks, lambda r: (r["rank"] >= F.col("_before")) & (r["rank"] < end)).alias("_ranks"),
    ).where(F.size("_ranks") > 0)

    match = counts["_part"] == picked["_slice"]
    for i, g in enumerate(groups):
        match = match & counts[g].eqNullSafe(picked[f"_g{i}"])
    inside = Window.partitionBy("_part", *groups).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    numbered = counts.join(picked, match).withColumn("_upto", F.col("_before") + F.sum("_n").over(inside))
    hits = numbered.select(
        *groups, value,
        F.explode(F.filter("_ranks", lambda r: (r["rank"] >= F.col("_upto") - F.col("_n"))
                           & (r["rank"] < F.col("_upto")))).alias("_hit"),
    )

    def interpolated(name: str) -> Column:
        def side(upper: int) -> Column:
            return F.max(F.when((F.col("_hit.name") == name) & (F.col("_hit.upper") == upper), F.col(value)))
        weight = F.max(F.when(F.col("_hit.name") == name, F.col("_hit.weight")))
        return (side(0) + (side(1) - side(0)) * weight).alias(name)

    return hits.groupBy(*groups).agg(*[interpolated(name) for name in quantiles])


def quantiles(df: DataFrame, value: str, wanted: dict[str, float], groups: Sequence[str] = (),
              accuracy: int | None = None) -> DataFrame:
    """Exact by default; with `accuracy` the built-in sketch of that accuracy."""
    if accuracy:
        sketch = [F.percentile_approx(value, float(q), accuracy).cast("double").alias(n) for n, q in wanted.items()]
        return df.groupBy(*groups).agg(*sketch)
    return quantiles_of_counts(value_counts_sorted(df, value, groups), value, wanted, groups)


def mean_median(df: DataFrame, value: str, groups: Sequence[str] = (), accuracy: int | None = None) -> DataFrame:
    """Mean and median, both from the copies per value; with `accuracy` in one pass, the median's rank off by up to 1 / `accuracy`."""
    if accuracy:
        number = F.col(value).cast("double")
        return df.where(number.isNotNull()).groupBy(*groups).agg(
            F.count("*").alias("n"), F.avg(number).alias("mean"), F.percentile_approx(number, 0.5, accuracy).alias("median"))
    counts = value_counts_sorted(df, value, groups)
    means = counts.groupBy(*groups).agg(
        F.sum("_n").alias("n"), (F.sum(F.col(value) * F.col("_n")) / F.sum("_n")).alias("mean"))
    medians = quantiles_of_counts(counts, value, {"median": 0.5}, groups)
    return join_groups(means, medians, groups)


def join_groups(left: DataFrame, right: DataFrame, groups: Sequence[str], how: str = "inner") -> DataFrame:
    """Attach per-group values to `left`; null groups meet. Without groups `right` is one row of values."""
    if not groups:
        row = right.first()
        return left.withColumns({
            f.name: F.lit(row[f.name] if row else None).cast(f.dataType) for f in right.schema.fields})
    names = [f"_r{i}" for i in range(len(groups))]
    side = right.select(*[F.col(g).alias(n) for g, n in zip(groups, names)],
                        *[c for c in right.columns if c not in groups])
    condition = reduce(lambda a, b: a & b, [left[g].eqNullSafe(side[n]) for g, n in zip(groups, names)])
    return left.join(side, condition, how).drop(*names)
