"""Embedding near-duplicates by cross-polytope hashing with fast Hadamard rotations and multiprobe buckets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import complete_groups, id_of, join_salted
from stratamart.llm.components import labelled
from stratamart.llm.vectors import matrix, scale_factors, usable, vectors
from stratamart.staging import materialize

#: Tables, and buckets a vector is put into per table (its own and the next likely ones).
TABLES, PROBES = 10, 4
#: Rows of a bucket that are compared as one block; larger buckets are compared block by block.
BLOCK = 2048
#: What half precision may take from a cosine.
_HALF_ERROR = 0.005
_CHOICES = 3


def rotate(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Pseudo-random rotation of rows: a change of signs and a fast Hadamard transform for each row of `signs`."""
    width = signs.shape[1]
    out = np.zeros((len(x), width))
    out[:, :x.shape[1]] = x
    for row in signs:
        out *= row
        size = 1
        while size < width:
            pairs = out.reshape(len(x), -1, 2, size)
            out = np.concatenate((pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]), axis=2).reshape(len(x), width)
            size *= 2
        out /= math.sqrt(width)
    return out


def buckets(unit: np.ndarray, tables: int, polytopes: int, probes: int) -> np.ndarray:
    """Bucket numbers, `tables` times `probes` per unit vector, the vector's own bucket first in each table.

    In each table a vector is rotated once per polytope and hashed to the nearest signed axis of each; the other
    probes replace axes by the next nearest ones, the least loss first.
    """
    n, dim = unit.shape
    width = 1 << max(0, (dim - 1).bit_length())
    random = np.random.default_rng(dim)
    out = np.empty((n, tables, probes), dtype=np.int64)
    rows = np.arange(n)[:, None]
    choices = min(_CHOICES, width)
    combos = np.array(list(product(range(choices), repeat=polytopes)))
    for table in range(tables):
        loss = np.zeros((n, len(combos)))
        code = np.full((n, len(combos)), dim * tables + table, dtype=np.int64)
        for polytope in range(polytopes):
            turned = rotate(unit, random.choice([-1.0, 1.0], size=(3, width)))
            size = np.abs(turned)
            best = np.argsort(-size, axis=1, kind="stable")[:, :choices]
            axis = 2 * best + (turned[rows, best] < 0)
            gap = (size[rows, best[:, :1]] - size[rows, best]) ** 2
            loss += gap[:, combos[:, polytope]]
            code = code * (2 * width) + axis[:, combos[:, polytope]]
        first = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        picked = code[rows, first]
        out[:, table, :picked.shape[1]] = picked
        out[:, table, picked.shape[1]:] = picked[:, :1]
    return out.reshape(n, -1)


def _close(table: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one sorted cut of bucket cells whose half-precision cosine may reach `least`."""
    ids = table.column("cls").to_numpy()
    side = table.column("block").to_numpy()
    low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
    bucket = table.column("bucket").to_numpy()
    blob = table.column("half").combine_chunks() if isinstance(table.column("half"), pa.ChunkedArray) else table.column("half")
    new = np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])))
    edges = np.append(np.flatnonzero(new), len(ids))
    a, b = [], []
    for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if y - x < 2:
            continue
        unit = np.frombuffer(b"".join(blob.slice(x, y - x).to_pylist()), dtype=np.float16).reshape(y - x, -1).astype(np.float32)
        for at in range(0, y - x, 1024):
            i, j = np.nonzero(unit[at:at + 1024] @ unit.T >= least - _HALF_ERROR)
            i += at
            # Each pair once; two blocks of one bucket meet across, and within only in their own cell.
            keep = (ids[x + i] < ids[x + j]) & ((low[x] == high[x]) | (side[x + i] != side[x + j]))
            a.append(ids[x + i[keep]])
            b.append(ids[x + j[keep]])
    none = np.empty(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def classes_of(rows: DataFrame) -> DataFrame:
    """Equal vectors as one class: `cls` (any number), `embedding`, `first` (smallest id), `copies`."""
    return materialize(rows.groupBy("embedding").agg(F.min("_vec").alias("first"), F.count("*").alias("copies"))
                       .withColumn("cls", F.monotonically_increasing_id()), "vector_classes")


def links(classes: DataFrame, least: float, tables: int = TABLES, probes: int = PROBES, block: int = BLOCK,
          polytopes: int | None = None) -> DataFrame:
    """Pairs of classes `a` < `b` with a cosine of at least `least`, verified in double precision.

    The number of `polytopes` per table follows the number of classes, so that buckets stay small. Only ids
    are put into buckets first; buckets of more than `block` rows become a grid of cells, so that no
    task gets a large bucket, and none of its pairs is left out. Cells compare unit vectors in half precision with
    a margin, and the pairs found are verified on the vectors themselves.
    """
    count = classes.count()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array(batch.column("embedding").value_lengths().to_numpy(zero_copy_only=False))
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                x = matrix(part.column("embedding"))
                x = x / np.abs(x).max(axis=1, keepdims=True)
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                width = 1 << max(0, (int(size) - 1).bit_length())
                found = buckets(unit, tables, polytopes or max(1, min(4, round(math.log(max(2, count)) / math.log(2 * max(2, width))))), probes)
                yield pa.RecordBatch.from_arrays(
                    [part.column("cls"), pa.array(list(found), pa.list_(pa.int64())),
                     pa.array([r.tobytes() for r in unit.astype(np.float16)], pa.binary())], ["cls", "buckets", "half"])

    hashes = materialize(classes.select("cls", "embedding").mapInArrow(hashed, "cls long, buckets array<long>, half binary"), "vector_hashes")
    entries = hashes.select("cls", F.explode(F.array_distinct("buckets")).alias("bucket"))
    counts = entries.groupBy("bucket").agg(F.count("*").alias("rows"))
    blocks = F.ceil(F.col("rows") / block).cast("long")
    own = F.pmod(F.xxhash64("cls"), blocks)
    cells = (join_salted(entries, "bucket", "cls", counts).where("rows > 1")
             .select("cls", "bucket", own.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("_other"))
             .select("cls", "bucket", "block", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high")))
    dealt = (cells.join(hashes.select("cls", "half"), "cls").repartition("bucket", "low", "high")
             .sortWithinPartitions("bucket", "low", "high"))

    def last_group(table: pa.Table) -> int:
        key = np.stack([table.column(c).to_numpy() for c in ("bucket", "low", "high")])
        differs = np.flatnonzero((key != key[:, -1:]).any(axis=0))
        return int(differs[-1]) + 1 if len(differs) else 0

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in complete_groups(batches, last_group):
            a, b = _close(table, least)
            pairs = np.unique(np.stack((a, b)), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    pairs = dealt.mapInArrow(compare, "a long, b long").distinct()
    sides = classes.select("cls", "embedding")
    both = (pairs.join(sides.select(F.col("cls").alias("a"), F.col("embedding").alias("x")), "a")
            .join(sides.select(F.col("cls").alias("b"), F.col("embedding").alias("y")), "b"))

    def dot(x: str, y: str):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    cosine = dot("x", "y") / (F.sqrt(dot("x", "x")) * F.sqrt(dot("y", "y")))
    return both.where((F.size("x") == F.size("y")) & (cosine >= F.lit(float(least)))).select("a", "b")


def near_duplicates(rows: DataFrame, least: float) -> DataFrame:
    """`vec_id`, `n_links` (other vectors with a cosine of at least `least`), `component_id` (smallest vec_id reachable by
    links, its own included) and `kept` (whether that is the row's own) of every row of `vec_id`, `embedding`.

    Vectors that are null, empty or zero or hold null or non-finite components link with nothing; vectors of
    different lengths do not link. Components of any size are compared exactly, as vectors are scaled by powers of two first,
    which leaves cosines as they are. Equal vectors are one class from the start: their links among each other are
    counted, not listed. A null vec_id is kept as null and is the component's id only if no other is in it;
    rows that repeat a vec_id are vectors of their own; an empty table gives an empty result; other
    columns, labels too, are ignored.
    """
    first, second = scale_factors("embedding")
    told = vectors(rows).withColumn("_usable", usable("embedding"))
    rows = materialize(told.withColumns({"_first": F.when(F.col("_usable"), first), "_second": F.when(F.col("_usable"), second)}), "vectors")
    scaled = F.transform("embedding", lambda x: x * F.col("_first") * F.col("_second"))
    valid = rows.where("_usable").select("_vec", scaled.alias("embedding"))
    classes = classes_of(valid)
    found = materialize(links(classes, least), "vector_links")
    directed = found.union(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weights = classes.select(F.col("cls").alias("b"), "copies")
    others = join_salted(directed, "b", "a", weights).groupBy(F.col("a").alias("cls")).agg(F.sum("copies").alias("others"))
    labels = labelled(classes.select("cls", "first"), found)
    described = materialize(classes.join(others, "cls", "left").join(labels, "cls").select(
        "embedding", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component"), "vector_labels")
    linked = join_salted(valid, "embedding", "_vec", described).select("_vec", "n_links", "component")
    rest = rows.where("not _usable").select("_vec", F.lit(0).cast("long").alias("n_links"), F.col("_vec").alias("component"))
    return linked.union(rest).select(id_of("_vec").alias("vec_id"), "n_links", id_of("component").alias("component_id"),
                                     (F.col("_vec") == F.col("component")).alias("kept"))
