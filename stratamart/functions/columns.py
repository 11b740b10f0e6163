"""Column expressions shared by the queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def round_money(column: Column, digits: int = 2) -> Column:
    """Round as exact decimals do (half away from zero), free of binary noise in the last digits."""
    return F.round(column.cast("decimal(28,6)"), digits).cast("double")


def bucketize(column: Column, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """`labels[i]` for values below `cuts[i]`, the last label for the rest (null included)."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("bucketize needs one label more than cuts")
    banded = F.when(column < cuts[0], labels[0])
    for cut, label in zip(cuts[1:], labels[1:-1]):
        banded = banded.when(column < cut, label)
    return banded.otherwise(labels[-1])


def price_band(column: Column) -> Column:
    return bucketize(column, (15000, 30000), ("Barato", "Médio", "Caro"))


def vehicle_name(make: Column, model: Column) -> Column:
    """`make model`; null when either is."""
    return F.concat(make, F.lit(" "), model)


def short_label(column: Column, width: int = 30) -> Column:
    """At most `width` characters, `...` appended where text was cut."""
    return F.when(F.length(column) > width, F.concat(F.substring(column, 1, width), F.lit("..."))).otherwise(column)


def currency(column: Column, digits: int = 2, symbol: str = "$") -> Column:
    """Text with thousands separators; for reports, never stored."""
    return F.concat(F.lit(symbol), F.format_number(column, digits))


def ratio(part: Column, whole: Column) -> Column:
    """Quotient as double, null for a zero denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def tagged(df: DataFrame, **literals: object) -> DataFrame:
    """`df` with constant columns in front."""
    return df.select(*[F.lit(v).alias(k) for k, v in literals.items()], *df.columns)


def _one_zero(df: DataFrame, name: str) -> Column:
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    return column + F.lit(0.0).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else column


def row_hashes(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row; rows that group together hash alike. Nulls, which hash functions pass over, count by their place."""
    nulls = F.array(*[F.col(f"`{c}`").isNull() for c in columns])
    return [F.xxhash64(F.lit(i), nulls, *[_one_zero(df, c) for c in columns]) for i in (0, 1)]


_DIGESTED = (T.StringType, T.BinaryType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def row_digest(df: DataFrame) -> list[Column]:
    """Columns to group whole rows by: the SHA-256 of all plain values with their lengths, and what is not plain as it is."""
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, _DIGESTED)]
    other = [F.col(f"`{f.name}`") for f in df.schema.fields if f.name not in plain]
    if not plain:
        return other
    texts = [_one_zero(df, c).cast("string") for c in plain]
    lengths = F.array(*[F.octet_length(t) for t in texts]).cast("string")
    return [F.unhex(F.sha2(F.concat(lengths, F.concat_ws("", *texts)).cast("binary"), 256)).alias("_digest"), *other]
