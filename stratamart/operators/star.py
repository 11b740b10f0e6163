"""Star schemas: dimensions, natural-key lookups, facts, and re-modelling one star into another."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from stratamart.functions.cleaning import drop_incomplete, require_columns, shared_columns
from stratamart.functions.columns import row_hashes
from stratamart.operators.keys import dense_key
from stratamart.operators.skew import skew_join
from stratamart.schemas import DimensionSpec, FactSpec

# Buckets of rows whose sums are compared, by the first bits of their hash.
_BUCKET_BITS = 12


def build_dimension(source: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Distinct tuples of the dimension's columns, keyed by their rank."""
    require_columns(source, spec.columns, f"source of {spec.name}")
    return dense_key(source.select(*spec.columns).distinct(), spec.key, spec.columns)


def rekey_dimension(dimension: DataFrame, key: str, spec: DimensionSpec) -> tuple[DataFrame, DataFrame]:
    """A new dimension of the same attributes as an old one, and the map from old `key` to `spec.key`.

    Old and new rows correspond one to one, so the old rows are numbered once: no second distinct,
    and no join on the natural key.
    """
    keyed = dense_key(dimension.select(key, *spec.columns), spec.key, spec.columns)
    return keyed.select(spec.key, *spec.columns), keyed.select(key, spec.key)


def lookup_key(rows: DataFrame, dimension: DataFrame, spec: DimensionSpec,
               measured_on: DataFrame | None = None) -> DataFrame:
    """Left join on the natural key; adds `spec.key`, null where the dimension has no such tuple.

    Null equals null. Frequent tuples are spread, see `skew_join`.
    """
    columns = shared_columns(rows, dimension, spec.columns)
    return skew_join(rows, dimension.select(spec.key, *columns), columns, "left", null_safe=True,
                     measured_on=measured_on)


def new_members(source: DataFrame, dimension: DataFrame, spec: DimensionSpec, last: int) -> DataFrame:
    """Rows for the tuples of `source` that the dimension lacks, keyed from `last` + 1 on in their order.

    Both meet in one aggregation, which collapses repeated tuples before its only shuffle.
    """
    require_columns(source, spec.columns, f"source of {spec.name}")
    require_columns(dimension, spec.columns, spec.name)
    both = source.select(*spec.columns, F.lit(False).alias("_known")).unionByName(
        dimension.select(*spec.columns, F.lit(True).alias("_known")))
    lacking = both.groupBy(*spec.columns).agg(F.max("_known").alias("_known")).where(~F.col("_known")).select(*spec.columns)
    return dense_key(lacking, spec.key, spec.columns).withColumn(spec.key, F.col(spec.key) + last)


def complete_lookup(rows: DataFrame, dimension: DataFrame, spec: DimensionSpec, names: list[str], measured_on: DataFrame) -> DataFrame:
    """`lookup_key` into a dimension that has every tuple of `rows`, which carry its two hashes (`names`) in its place.

    Fails if two tuples of the dimension share their hashes. So the row found is the row's own tuple, and neither side
    ships the tuple itself.
    """
    own = F.when(F.count("*") == 1, F.max(spec.key)).otherwise(F.raise_error(F.lit(f"two rows of {spec.name} have the same hashes")).cast("long"))
    hashes = [h.alias(n) for h, n in zip(row_hashes(dimension, spec.columns), names)]
    side = dimension.select(spec.key, *hashes).groupBy(*names).agg(own.alias(spec.key))
    return skew_join(rows, side, names, "left", measured_on=measured_on, sized_on=dimension)


def fact_rows(source: DataFrame, spec: FactSpec, dimensions: dict[str, DataFrame], complete: bool = True) -> DataFrame:
    """The columns of the fact; its own key, if it has one, must come with the source.

    Dimensions are taken to hold each tuple of the source once (`complete_lookup`); without `complete` the tuples
    themselves are compared, and those that a dimension lacks have null keys. Lookups run from the last dimension to the first: the natural key of a resolved dimension is
    dropped at once, and the small last dimension is usually broadcast, so the wide first lookup
    shuffles a row that is already narrow.
    """
    carried = [c for c in spec.columns if c in source.columns]
    if complete:
        names = {d.name: [f"_{d.key}_{i}" for i in (0, 1)] for d in spec.dimensions}
        rows = source.select(*carried, *[h.alias(n) for d in spec.dimensions for h, n in zip(row_hashes(source, d.columns), names[d.name])])
        hashed = rows
        for dimension in reversed(spec.dimensions):
            rows = complete_lookup(rows, dimensions[dimension.name], dimension, names[dimension.name], hashed).drop(*names[dimension.name])
        return rows.select(*spec.columns)
    rows = source.select(*dict.fromkeys([c for d in spec.dimensions for c in d.columns] + carried))
    pending = list(spec.dimensions)
    while pending:
        dimension = pending.pop()
        rows = lookup_key(rows, dimensions[dimension.name], dimension, measured_on=source)
        needed = {c for d in pending for c in d.columns} | set(spec.columns)
        rows = rows.select(*[c for c in rows.columns if c in needed])
    return rows.select(*spec.columns)


def surrogate_map(dimension: DataFrame, key: str, targets: list[tuple[DimensionSpec, DataFrame]],
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row of `dimension`: its `key`, the keys of the target dimensions, and the `keep` columns.

    Target dimensions are functions of the old dimension, so the natural keys are compared at the
    grain of the dimension and the fact is later joined by surrogate only.
    """
    rows = dimension
    for spec, target in targets:
        rows = lookup_key(rows, target, spec)
    return rows.select(key, *[spec.key for spec, _ in targets], *keep)


def remap_fact(fact: DataFrame, spec: FactSpec, maps: list[tuple[str, DataFrame]]) -> DataFrame:
    """Replace old surrogates by those of the maps (left joins, so orphans keep null keys)."""
    rows = fact
    for key, mapping in maps:
        rows = skew_join(rows, mapping, [key], "left", measured_on=fact)
    require_columns(rows, spec.columns, spec.name)
    return rows.select(*spec.columns)


def missing_keys(fact: DataFrame, spec: FactSpec) -> DataFrame:
    """One row per dimension: how many fact rows found no key."""
    counted = fact.agg(*[F.count_if(F.col(d.key).isNull()).alias(d.name) for d in spec.dimensions])
    return counted.unpivot([], [d.name for d in spec.dimensions], "dimension", "missing")


def drop_orphans(fact: DataFrame, spec: FactSpec) -> DataFrame:
    return drop_incomplete(fact, [d.key for d in spec.dimensions])


def widen(fact: DataFrame, spec: FactSpec, dimensions: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """The flat rows a star stands for."""
    rows = fact
    for dimension in spec.dimensions:
        rows = skew_join(rows, dimensions[dimension.name], [dimension.key], measured_on=fact)
    return rows.select(*columns)


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs between two tables of equal columns.

    First the rows of both are summed up per bucket of a hash: their number, and the four halves of two 64-bit hashes of
    each row. Only rows of buckets whose sums differ are then shuffled and grouped, as they are. Tables of which a bucket
    differs in rows but in none of these sums would be missed; that happens by chance once in about 2^112.
    """
    both = left.withColumn("_n", F.lit(1)).unionByName(right.withColumn("_n", F.lit(-1)))
    first, second = row_hashes(both, left.columns)
    hashed = both.select(first.alias("_first"), second.alias("_second"), F.col("_n").cast("long").alias("_n"))
    halves = [half for h in ("_first", "_second")
              for half in (F.col(h).bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))]
    sums = hashed.groupBy(F.shiftrightunsigned("_first", 64 - _BUCKET_BITS).alias("_bucket")).agg(
        F.sum("_n").alias("_rows"), *[F.sum(half * F.col("_n")).alias(f"_sum{i}") for i, half in enumerate(halves)])
    unequal = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in sums.columns[1:]])
    # At most one number per bucket.
    found = [r["_bucket"] for r in sums.where(unequal).select("_bucket").collect()]
    if not found:
        return left.sparkSession.createDataFrame([], T.StructType([*both.drop("_n").schema.fields, T.StructField("surplus", T.LongType())]))
    return (
        both.where(F.shiftrightunsigned(first, 64 - _BUCKET_BITS).isin(found))
        .groupBy(*left.columns).agg(F.sum("_n").alias("surplus"))
        .where(F.col("surplus") != 0)
    )
