"""Aggregates behind distribution plots: histograms, density curves, box statistics, 2-D bins.

Only bin counts, curves and five-number summaries leave the executors, never the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stratamart.operators.quantiles import join_groups, quantiles, quantiles_of_counts, value_counts_sorted
from stratamart.staging import materialize

_QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _with_bounds(df: DataFrame, value: str, groups: Sequence[str]) -> DataFrame:
    """Rows (groups, value) with `_lo`, `_hi`, `_total`, `_sd` of their group.

    The group statistics are staged, so their real size decides how they are joined back.
    """
    rows = df.select(*groups, F.col(value).cast("double").alias(value)).where(F.col(value).isNotNull())
    stats = rows.groupBy(*groups).agg(
        F.min(value).alias("_lo"), F.max(value).alias("_hi"),
        F.count("*").alias("_total"), F.stddev_samp(value).alias("_sd"))
    return join_groups(rows, materialize(stats, "bounds") if groups else stats, groups)


def bin_index(column: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based equal-width bin over [low, high]; the last bin is closed, a constant column is bin 0."""
    width = (high - low) / bins
    return F.when(high > low, F.least(F.floor((column - low) / width), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")


def histogram(df: DataFrame, value: str, bins: int, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, bin, bin_start, bin_end, count), empty bins included.

    Reads the rows twice (bounds, then bins); stage them first when they come out of a join.
    """
    rows = _with_bounds(df, value, groups)
    cells = (
        rows.withColumn("_bin", bin_index(F.col(value), F.col("_lo"), F.col("_hi"), bins))
        .groupBy(*groups, "_lo", "_hi", "_bin").agg(F.count("*").alias("_n"))
    )
    packed = cells.groupBy(*groups, "_lo", "_hi").agg(
        F.map_from_entries(F.collect_list(F.struct("_bin", "_n"))).alias("_counts"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    return packed.select(*groups, "_lo", "_hi", "_counts",
                         F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")).select(
        *groups, "bin",
        (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce(F.try_element_at("_counts", F.col("bin")), F.lit(0)).cast("long").alias("count"),
    )


def density(df: DataFrame, value: str, groups: Sequence[str] = (), cells: int = 1024, points: int = 200,
            cut: float = 0.0) -> DataFrame:
    """(groups, point, x, density): Gaussian kernel curve with bandwidth sd * n^(-1/5).

    The kernel is laid over cell centres, so after one pass over the rows the work per group is
    `cells` times `points` whatever its size. `cut` extends the curve by that many bandwidths beyond
    the data. Groups with fewer than two rows or no spread have no curve.
    """
    rows = _with_bounds(df, value, groups)
    group = [*groups, "_lo", "_hi", "_total", "_sd"]
    counted = (
        rows.where((F.col("_total") >= 2) & (F.col("_sd") > 0))
        .withColumn("_cell", bin_index(F.col(value), F.col("_lo"), F.col("_hi"), cells))
        .groupBy(*group, "_cell").agg(F.count("*").cast("double").alias("_n"))
    )
    centre = F.col("_lo") + (F.col("_cell") + 0.5) * (F.col("_hi") - F.col("_lo")) / cells
    packed = counted.groupBy(*group).agg(
        F.sort_array(F.collect_list(F.struct(centre.alias("c"), F.col("_n").alias("n")))).alias("_cells"))
    bandwidth = F.col("_sd") * F.pow(F.col("_total").cast("double"), F.lit(-0.2))
    start = F.col("_lo") - F.lit(float(cut)) * F.col("_h")
    step = (F.col("_hi") - F.col("_lo") + F.lit(2.0 * cut) * F.col("_h")) / (points - 1)
    curve = packed.withColumn("_h", bandwidth).select(
        *group, "_h", "_cells", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"),
    ).withColumn("x", start + F.col("point") * step)

    def add(total: Column, cell: Column) -> Column:
        z = (F.col("x") - cell["c"]) / F.col("_h")
        return total + cell["n"] * F.exp(z * z * -0.5)

    mass = F.aggregate("_cells", F.lit(0.0), add)
    scale = F.col("_total") * F.col("_h") * math.sqrt(2 * math.pi)
    return curve.select(*groups, "point", "x", (mass / scale).alias("density"))


def box_stats(df: DataFrame, value: str, groups: Sequence[str] = (), whisker: float = 1.5, accuracy: int | None = None) -> DataFrame:
    """Quartiles, whisker ends (extreme values within `whisker` times the box) and outlier count.

    With `accuracy` the quartiles are values whose rank is off by up to 1 / `accuracy`, from a sketch; whiskers and outliers
    are exact for that box.
    """
    if accuracy:
        rows = df.select(*groups, F.col(value).cast("double").alias(value)).where(F.col(value).isNotNull())
        return _boxes(rows.withColumn("_n", F.lit(1)), quantiles(rows, value, _QUARTILES, groups, accuracy), value, groups, whisker)
    return box_stats_of_counts(value_counts_sorted(df, value, groups), value, groups, whisker)


def box_stats_of_counts(counts: DataFrame, value: str, groups: Sequence[str] = (), whisker: float = 1.5) -> DataFrame:
    """`box_stats` from the table of `value_counts_sorted`."""
    return _boxes(counts, quantiles_of_counts(counts, value, _QUARTILES, groups), value, groups, whisker)


def _boxes(counts: DataFrame, quartiles: DataFrame, value: str, groups: Sequence[str], whisker: float) -> DataFrame:
    """Box statistics of rows with `_n` copies each."""
    if groups:
        quartiles = materialize(quartiles, "quartiles")
    spread = (F.col("q3") - F.col("q1")) * whisker
    inside = F.col(value).between(F.col("q1") - spread, F.col("q3") + spread)
    return join_groups(counts, quartiles, groups).groupBy(*groups, "q1", "median", "q3").agg(
        F.sum("_n").alias("count"),
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("outliers"),
    )


def scatter_bins(df: DataFrame, x: str, y: str, x_bins: int, y_bins: int, colour: str | None = None) -> DataFrame:
    """(x_bin, y_bin, count[, mean colour]) for the occupied cells of a scatter plot."""
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    bounds = rows.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in (x, y)
                        for n, f in (("lo", F.min), ("hi", F.max))]).first()

    def cell(column: str, bins: int) -> Column:
        return bin_index(F.col(column).cast("double"), F.lit(bounds[f"lo_{column}"]),
                         F.lit(bounds[f"hi_{column}"]), bins)

    measures = [F.count("*").alias("count")]
    if colour:
        measures.append(F.avg(colour).alias(f"mean_{colour}"))
    return rows.groupBy(cell(x, x_bins).alias("x_bin"), cell(y, y_bins).alias("y_bin")).agg(*measures)
