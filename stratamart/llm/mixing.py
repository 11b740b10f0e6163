"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratamart.llm.common import add_running, key_of, quoted, slice_count, text_key
from stratamart.operators.keys import dense_key
from stratamart.staging import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: The weights that sources get in turn, in code point order.
WEIGHTS = (1, 2, 3)
#: How often a document may be taken.
MOST_REPEATS = 3


def words(column: str) -> Column:
    """Number of words in a text; none in a null."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MOST_REPEATS) -> DataFrame:
    """`_source`, `source_size` -> the same with `target`: shares by weight, none above `repeats` times its size.

    What a capped source leaves goes to the others by weight. Each round caps at least one more
    source; only the number of capped sources and two sums come to the driver.
    """
    numbered = dense_key(sizes.withColumn("_last", F.col("_source") == "null"), "_place", ["_last", "_source"])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.col("_place") - 1, F.lit(len(weights))) + 1).cast("int"))
    table = materialize(numbered.select("_source", "source_size", weight.alias("_weight"),
                                        (F.col("source_size") * float(repeats)).alias("_cap")), "sources")
    level, capped = -1.0, -1
    while True:
        at = F.col("_cap") <= F.col("_weight") * F.lit(level)
        row = table.agg(F.sum("source_size").alias("all"), F.sum(at.cast("long")).alias("n"),
                        F.sum(F.when(at, F.col("_cap"))).alias("cap"),
                        F.sum(F.when(~at, F.col("_weight"))).alias("weight")).first()
        if not row["weight"] or row["n"] == capped:
            break
        capped, level = row["n"], ((row["all"] or 0) - (row["cap"] or 0.0)) / row["weight"]
    return table.select("_source", "source_size", F.least("_cap", F.col("_weight") * F.lit(level)).alias("target"))


def mix(docs: DataFrame, size: Column, weights: tuple[int, ...] = WEIGHTS, repeats: int = MOST_REPEATS,
        identity: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """Choose how often each document goes into the mix: the columns of `docs`, then `size`, `source_size`,
    `target` (of its source) and `taken` (size times the copies taken).

    Weighted fair queueing: the documents of a source are shuffled (by a hash, so reruns agree) and
    queue up to `repeats` times; a document's virtual finish time is the source's size queued up to its
    end, divided by the source's target. All queues are range-sorted by it and cut at the total budget,
    the sum of all sizes. The cut is found from the sizes per range of finish times and one such range.

    A null source is a source of its own and comes last; null, empty and wordless texts have size 0 and
    are never taken; repeated rows queue one after another; an empty table gives an empty result. Columns
    of `docs` named like a result column are replaced.
    """
    own = ("size", "source_size", "target", "taken", "before")
    kept = [c for c in docs.columns if c not in own]
    # The columns of `docs` travel as one, so that none can clash with those needed on the way.
    sized = docs.select(
        F.struct(*quoted(kept)).alias("_carried"), size.alias("size"), text_key("source").alias("_source"), key_of("doc_id").alias("_doc"),
        F.xxhash64(*identity).alias("_hash"))
    narrow = sized.select("_source", "_doc", "_hash", "size")
    totals = narrow.groupBy("_source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    totals = materialize(totals, "source_totals")
    whole = totals.agg(F.sum("source_size").alias("size"), F.sum("_rows").alias("rows")).first()
    budget, rows = whole["size"] or 0, whole["rows"] or 0
    targets = materialize(source_targets(totals.drop("_rows"), weights, repeats), "targets")

    order = F.xxhash64("_doc", "_hash")
    queued = add_running(sized.withColumn("_turn", order), ["_source"], ["_turn", "_doc", "_hash"], "size",
                         ["_doc", "_hash"], slice_count(rows), targets)
    queued = materialize(queued, "queued")
    finish = [(F.col("before") + F.col("size") + F.col("source_size") * n) / F.col("target") for n in range(repeats)]

    items = (queued.where("size > 0")
             .select("size", F.explode(F.array(*[
                 F.struct(f.alias("finish"), F.col("_source").alias("source"), F.col("_turn").alias("turn"),
                          F.col("_doc").alias("doc"), F.col("_hash").alias("hash")) for f in finish])).alias("key")))
    # Finish times up to the cut, near 1, hold equal sizes in equal widths; later ones share the last range.
    ranges = max(64, math.isqrt(rows))
    ranged = items.withColumn("_range", F.least(F.floor(F.col("key.finish") * ranges), F.lit(4 * ranges)))
    running = F.sum("size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0))
    over = (ranged.groupBy("_range").agg(F.sum("size").alias("size")).withColumn("_until", running)
            .where(F.col("_until") > budget).orderBy("_range").first())
    taken = F.lit(repeats)
    if over is not None:
        inside = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
        first_out = (ranged.where(F.col("_range") == over["_range"]).withColumn("_sum", F.sum("size").over(inside))
                     .where(F.col("_sum") + (over["_until"] - over["size"]) > budget).orderBy("key").first())["key"]
        cut = F.struct(F.lit(first_out["finish"]).alias("finish"), F.lit(first_out["source"]).alias("source"),
                       F.lit(first_out["turn"]).alias("turn"), F.lit(first_out["doc"]).alias("doc"),
                       F.lit(first_out["hash"]).alias("hash"))
        taken = sum((F.struct(f.alias("finish"), F.col("_source").alias("source"), F.col("_turn").alias("turn"),
                              F.col("_doc").alias("doc"), F.col("_hash").alias("hash")) < cut).cast("long")
                    for f in finish)
    copies = F.when(F.col("size") > 0, taken).otherwise(F.lit(0))
    carried = [F.col(f"_carried.`{c.replace('`', '``')}`").alias(c) for c in kept]
    return queued.select(*carried, "size", "source_size", "target", (F.col("size") * copies).cast("long").alias("taken"))
