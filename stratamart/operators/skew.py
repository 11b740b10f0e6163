"""Joins that stay balanced when a few keys hold a large part of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratamart.staging import materialize

# A key is frequent from a thousandth of the rows on, so there are at most a thousand of them.
_MOST_FREQUENT = 1000
_WORTHWHILE_ROWS = 10_000
_TRACKED = 16_384
_SPREAD = 65_536


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size estimate is below its broadcast threshold."""
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= threshold


def _key_hash(columns: list[Column], kinds: list[T.DataType]) -> Column:
    """One long per key; equal keys hash alike on both sides of a join (one type, one zero)."""
    def plain(column: Column, kind: T.DataType) -> Column:
        cast = column.cast(kind)
        return cast + F.lit(0.0).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else cast
    return F.xxhash64(*[plain(c, k) for c, k in zip(columns, kinds)])


def frequent_hashes(rows: DataFrame, key_hash: Column) -> list[int]:
    """Hashes of the frequent keys, from a frequency sketch: one pass, no shuffle of the rows.

    The sketch only decides how a join is laid out, never what it returns.
    """
    seen = rows.select(key_hash.alias("_h")).agg(
        F.count("*").alias("total"),
        F.call_function("approx_top_k", F.col("_h"), F.lit(_MOST_FREQUENT), F.lit(_TRACKED)).alias("top"),
    ).first()
    least = max(seen["total"] / _MOST_FREQUENT, _WORTHWHILE_ROWS)
    return [item["item"] for item in seen["top"] or [] if item["count"] >= least]


def _all_equal(pairs: list[tuple[Column, Column]], null_safe: bool) -> Column:
    equal = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return reduce(lambda a, b: a & b, equal)


def skew_join(rows: DataFrame, side: DataFrame, on: list, how: str = "inner", null_safe: bool = False,
              measured_on: DataFrame | None = None, sized_on: DataFrame | None = None) -> DataFrame:
    """Join `rows` to `side`, whose key is unique; returns the columns of `rows` and the rest of `side`.

    `on` lists names, or (row column, side column) pairs. A side that fits a broadcast, and rows
    without frequent keys, take a plain join. Otherwise the few side rows of the frequent keys are
    staged and joined by broadcast; their rows go through the shuffle join of all the others
    spread over the partitions, where they meet nothing. The spread depends on the row and on the
    number of its map partition only, so a recomputed task sends every row where it went before.

    `measured_on` is a cheaper table with the same key columns to find frequent keys on. `sized_on` is the stored table that
    the side was made of, if its size is to decide: a few columns of a well compressed table look small and are not.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join {how!r}")
    pairs = [(key, key) if isinstance(key, str) else tuple(key) for key in on]
    side_keys = [s for _, s in pairs]
    payload = [c for c in side.columns if c not in side_keys]
    kinds = [side.schema[s].dataType for s in side_keys]
    names = [f"_key{i}" for i in range(len(pairs))]
    keyed = side.select(*[F.col(s).alias(n) for s, n in zip(side_keys, names)], *payload)
    row_keys = [F.col(r) for r, _ in pairs]
    row_hash, side_hash = _key_hash(row_keys, kinds), _key_hash([F.col(n) for n in names], kinds)

    hot = []
    small = fits_broadcast(side if sized_on is None else sized_on)
    if sized_on is not None and not small:
        keyed = keyed.hint("merge")
    if not small:
        source = rows if measured_on is None else measured_on
        hot = frequent_hashes(source, row_hash)

    def meet(left: DataFrame, right: DataFrame, right_names: list[str]) -> Column:
        return _all_equal([(left[r], right[n]) for (r, _), n in zip(pairs, right_names)], null_safe)

    # A composite key is compared by its hash first: sorting longs is far cheaper than many columns.
    hashed = null_safe and len(pairs) > 1
    if not hot:
        if not hashed:
            return rows.join(keyed, meet(rows, keyed, names), how).select(*rows.columns, *payload)
        left, right = rows.withColumn("_h", row_hash), keyed.withColumn("_k", side_hash)
        matched = left.join(right, (left["_h"] == right["_k"]) & meet(left, right, names), how)
        return matched.select(*rows.columns, *payload)

    frequent = materialize(keyed.where(side_hash.isin(hot)), "frequent_keys")
    frequent = frequent.select(F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in frequent.columns])
    # At most _MOST_FREQUENT rows, since the keys of `side` are unique.
    marked = rows.join(F.broadcast(frequent), meet(rows, frequent, [f"_hot_{n}" for n in names]), "left")
    is_hot = row_hash.isin(hot)
    if how == "inner":
        marked = marked.where(~is_hot | F.col("_hot").isNotNull())
    values = [F.col(f.name) for f in rows.schema.fields if not isinstance(f.dataType, T.MapType)]
    place = F.pmod(F.xxhash64(F.spark_partition_id(), *values), F.lit(_SPREAD))
    # The hash of the key, or for frequent keys a place of their own, which no side row has: those
    # are even and places odd.
    even = F.bitwise_not(F.lit(1).cast("long"))
    marked = marked.withColumn("_h", F.when(is_hot, place * 2 + 1).otherwise(row_hash.bitwiseAND(even)))
    rest = keyed.withColumns({"_k": side_hash.bitwiseAND(even), "_found": F.lit(True)})
    joined = marked.join(rest, (marked["_h"] == rest["_k"]) & meet(marked, rest, names), "left")
    if how == "inner":
        joined = joined.where(F.col("_hot").isNotNull() | F.col("_found").isNotNull())
    return joined.select(*rows.columns, *[
        F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c) for c in payload])


def sum_through(fact: DataFrame, dimension: DataFrame, key: str, by: list[str], sums: dict[str, Column],
                lows: dict[str, Column] | None = None, highs: dict[str, Column] | None = None) -> DataFrame:
    """Sums, minima and maxima of fact expressions per dimension attributes.

    Unless the whole dimension can be broadcast, the fact is aggregated per key first: it has to be
    shuffled by that key for the join anyway, and any frequent key is one row per task by then.
    """
    lows, highs = lows or {}, highs or {}
    first = [F.sum(e).alias(n) for n, e in sums.items()] + [F.min(e).alias(n) for n, e in lows.items()] \
        + [F.max(e).alias(n) for n, e in highs.items()]
    attributes = dimension.select(key, *by)
    if fits_broadcast(dimension):
        return fact.join(attributes, key).groupBy(*by).agg(*first)
    again = [F.sum(n).alias(n) for n in sums] + [F.min(n).alias(n) for n in lows] + [F.max(n).alias(n) for n in highs]
    return fact.groupBy(key).agg(*first).join(attributes.hint("merge"), key).groupBy(*by).agg(*again)
