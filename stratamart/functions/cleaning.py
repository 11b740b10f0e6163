"""Missing-value handling at ingest."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The texts a CSV reader of data-frame libraries takes as missing by default.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def missing_to_null(column: Column, tokens: tuple[str, ...] = NA_TOKENS, strip: bool = True) -> Column:
    """Null where the text is one of `tokens`; `strip` ignores blanks around the token."""
    probe = F.trim(column) if strip else column
    return F.when(~probe.isin(*tokens), column)


def tokens_to_null(df: DataFrame, tokens: tuple[str, ...] = NA_TOKENS, strip: bool = True) -> DataFrame:
    """`missing_to_null` on every text column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: missing_to_null(F.col(f"`{c}`"), tokens, strip) for c in texts})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is a value to Spark (it joins, groups and spoils averages), so it must not pass ingest."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats})


def normalize_missing(df: DataFrame, tokens: tuple[str, ...] = NA_TOKENS, strip: bool = True) -> DataFrame:
    """Missing tokens in text columns and NaN in floating columns become null."""
    return nan_to_null(tokens_to_null(df, tokens, strip))


def fill_missing(df: DataFrame, fills: dict[str, object] | None = None) -> DataFrame:
    """Replace nulls by a constant per column; by default an unknown accident history is `'None'`."""
    return df.fillna({"accident_history": "None"} if fills is None else fills)


def require_columns(df: DataFrame, columns, what: str = "table") -> None:
    """Fail when a column is missing instead of working on a narrower set."""
    have = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")


def shared_columns(left: DataFrame, right: DataFrame, columns, strict: bool = True) -> list[str]:
    """The join columns both sides have; strict (the default) demands all of them.

    A narrower key fans the join out, so the lenient form is only for exploration.
    """
    if strict:
        require_columns(left, columns, "left side")
        require_columns(right, columns, "right side")
        return list(columns)
    have = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    lacking = [c for c in columns if c.lower() not in have]
    if lacking:
        warnings.warn(f"joining without the columns {lacking}, which one side lacks", stacklevel=2)
    return [c for c in columns if c.lower() in have]


def fitting_widths(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """The same rows, whose evaluation fails on the first text longer than its column's width.

    Only a text that is too long meets the message, which is a lambda: written out for all columns the messages make a
    method that the JVM does not compile.
    """
    def check(column: str, width: int) -> Column:
        text = F.col(column)
        failure = F.transform(F.array(text), lambda t: F.raise_error(F.concat(F.lit(f"{column} is longer than {width}: "), t)))
        return F.when(F.length(text) > width, F.get(failure, F.lit(0)).cast("string")).otherwise(text).alias(column)

    return df.withColumns({c: check(c, w) for c, w in widths.items() if c in df.columns})


def drop_incomplete(df: DataFrame, columns) -> DataFrame:
    """Keep rows whose `columns` are all present."""
    return df.dropna(subset=list(columns))
