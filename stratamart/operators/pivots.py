"""Cross-tabs of already grouped counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def domain(df: DataFrame, column: str, limit: int = 10_000) -> list:
    """Sorted distinct non-null values; fails when there are too many to become columns."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} values, too many for columns")
    return sorted(row[0] for row in rows)


def cross_tab(df: DataFrame, row: str, column: str, value: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per `row`, one column per value of `column`, absent cells 0."""
    columns = domain(df, column) if columns is None else list(columns)
    return df.groupBy(row).pivot(column, columns).agg(F.sum(value)).fillna(0, subset=columns)


def row_percentages(tab: DataFrame, row: str) -> DataFrame:
    """Cells as percent of their row; null for an empty row."""
    cells = [c for c in tab.columns if c != row]
    total = reduce(lambda a, b: a + b, [F.col(f"`{c}`") for c in cells])
    return tab.select(row, *[
        (F.try_divide(F.col(f"`{c}`").cast("double"), total.cast("double")) * 100).alias(c) for c in cells
    ])
