"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import give_back, id_of, join_salted, key_of
from stratamart.llm.components import labelled
from stratamart.staging import materialize

#: Variants that one bucket makes on average, and at most at a time; layout only.
BUCKET_VARIANTS, VARIANTS_AT_ONCE = 2_000_000, 4_000_000
_HASHES_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle: int, seed: int = 42) -> int:
    """64-bit SimHash of a whole text: words parted by ASCII white space, A-Z lower-cased, word shingles with
    repeats hashed by XXH64; a bit is set if it is in over half the hashes. Fewer words make one shingle; no word gives zero."""
    from xxhash import xxh64_intdigest as digest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[:n - 1])).tolist()
    stops = (ends[len(words) - n:] - 1).tolist()
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _HASHES_AT_ONCE):
        hashes = np.array([digest(line[a:b], seed) for a, b in zip(starts[at:at + _HASHES_AT_ONCE], stops[at:at + _HASHES_AT_ONCE])],
                          dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """`_doc` (the id, a null as the largest long) and `fp` (the fingerprint's bits as a long) of every row."""
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), pa.array(prints.view(np.int64))], ["_doc", "fp"])
            give_back()

    rows = docs.select(key_of("doc_id").alias("_doc"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(take, "_doc long, fp long")


@lru_cache(maxsize=None)
def _flips(bits: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All masks with up to `most` of the lowest `bits` bits, and how many each has."""
    masks = [(sum(1 << i for i in c), n) for n in range(min(bits, most) + 1) for c in combinations(range(bits), n)]
    return np.array([m for m, _ in masks], dtype=np.uint64), np.array([n for _, n in masks], dtype=np.int8)


def _shared(prints: np.ndarray, spent: np.ndarray, bits: int, near: int, far: int, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (positions) between fingerprints that share a variant, among those variants that agree above the lowest
    `bits` bits; `spent` bits of each were flipped to agree. Too many variants at a time are parted by the next bit."""
    if len(prints) < 2:
        return
    ball = sum(math.comb(bits, n) for n in range(far + 1))
    if bits and len(prints) * ball > at_once:
        top = (prints >> np.uint64(bits - 1)) & np.uint64(1)
        for bit in (0, 1):
            cost = spent + (top != bit)
            inside = np.flatnonzero(cost <= far)
            for a, b in _shared(prints[inside], cost[inside], bits - 1, near, far, at_once):
                yield inside[a], inside[b]
        return
    low = np.uint64((1 << bits) - 1)
    variants, owners, flipped = [], [], []
    for used in range(far + 1):
        own = np.flatnonzero(spent == used)
        if len(own):
            masks, n = _flips(bits, far - used)
            variants.append(((prints[own] & low)[:, None] ^ masks).ravel())
            owners.append(np.repeat(own, len(masks)))
            flipped.append(np.tile(n + np.int8(used), len(own)))
    variants, owners, flipped = np.concatenate(variants), np.concatenate(owners), np.concatenate(flipped)
    order = np.argsort(variants, kind="stable")
    variants, owners = variants[order], owners[order]
    group = np.cumsum(np.concatenate(([0], variants[1:] != variants[:-1])))
    # The centre of a group must be within the smaller radius; then every member is within near + far of it.
    close = np.flatnonzero(flipped[order] <= near)
    centre = np.full(group[-1] + 1, -1, dtype=np.int64)
    centre[group[close][::-1]] = owners[close][::-1]
    a = centre[group]
    linked = (a >= 0) & (a != owners)
    pairs = np.unique(a[linked] * len(prints) + owners[linked])
    yield pairs // len(prints), pairs % len(prints)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position each of `n` positions is linked to, over any number of links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def ball_links(prints: DataFrame, distance: int, bucket_variants: int = BUCKET_VARIANTS,
               at_once: int = VARIANTS_AT_ONCE) -> DataFrame:
    """Distinct `fp` -> links `a`, `b` whose components are those of all pairs at most `distance` bits apart.

    Two such fingerprints share a variant that is half the distance from either. Instead of one row per
    variant, a fingerprint is sent to each bucket (the leading bits of a variant) that its ball touches, and
    the bucket makes the variants that begin with its bits. Fingerprints that share a variant are linked to
    one of them, never in all pairs, the distance is verified, and a bucket hands on one link per fingerprint at most.
    """
    far, near = (distance + 1) // 2, distance // 2
    total = sum(math.comb(64, n) for n in range(far + 1))
    rows = prints.count()
    bits = max(0, min(24, math.ceil(math.log2(max(1, rows * total / bucket_variants)))))
    prefixes = [int(m) for m in _flips(bits, far)[0]]
    prefix = F.shiftrightunsigned("fp", 64 - bits) if bits else F.lit(0).cast("long")
    sent = prints.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in prefixes])).alias("_flip"), prefix.alias("_own")).select(
        "fp", F.col("_own").bitwiseXOR(F.col("_flip")).alias("bucket"), F.bit_count("_flip").alias("spent"))

    def link(group: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(group["fp"].to_numpy().astype(np.int64))
        order = np.argsort(group["fp"].to_numpy(), kind="stable")
        prints, spent = values.view(np.uint64), group["spent"].to_numpy()[order]
        a, b = [], []
        for x, y in _shared(prints, spent, 64 - bits, near, far, at_once):
            true = np.bitwise_count(prints[x] ^ prints[y]) <= distance
            a.append(x[true])
            b.append(y[true])
        if not a:
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        root = _forest(len(values), np.concatenate(a), np.concatenate(b))
        del a, b
        give_back()
        moved = np.flatnonzero(root != np.arange(len(values)))
        return pd.DataFrame({"a": values[root[moved]], "b": values[moved]})

    return sent.groupBy("bucket").applyInPandas(link, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int, distance: int) -> DataFrame:
    """`doc_id`, `fp` (the fingerprint's bits as a long) and `component_id` (the smallest doc_id reachable by
    links of at most `distance` differing bits, its own included) of every row.

    Equal fingerprints are first merged, so copies cost one row from then on. A null text counts as empty,
    and all texts without words have fingerprint zero. A null doc_id is kept as null and is never the
    component's id unless no other is in it; rows that repeat a doc_id are kept; an empty table gives an empty
    result. Columns other than `doc_id` and `text` are ignored.
    """
    rows = materialize(fingerprints(docs, shingle), "fingerprints")
    classes = materialize(rows.groupBy("fp").agg(F.min("_doc").alias("first")), "fingerprint_classes")
    labels = labelled(classes.withColumnRenamed("fp", "cls"), ball_links(classes.select("fp"), distance))
    owned = materialize(labels.withColumnRenamed("cls", "fp"), "fingerprint_labels")
    return join_salted(rows, "fp", "_doc", owned).select(
        id_of("_doc").alias("doc_id"), "fp", id_of("component").alias("component_id"))

