"""Best-fit packing of token sequences with large-item matching."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import add_running, ddl, map_batches, quoted, slice_count, small_batches
from stratamart.llm.tokens import Encoding, encoded
from stratamart.staging import materialize

CAPACITY = 4096
_RUN = ("length", "first", "count", "sequence", "offset")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first, count, sequence, offset): the pieces of a length numbered first..first+count-1 go one
    each into the sequences from `sequence` on, all at `offset`.

    Works on the number of pieces per length, so its input and its work are bounded by the capacity,
    not by the corpus. Lengths above a third of the capacity are matched greedily, the longest with the
    longest that still fits, at most two per sequence. The rest, longest first, go where the least
    room is left that holds them, or open a sequence.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    used = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    groups: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, how many)
    rooms: list[int] = []
    opened = 0

    def put(length: int, count: int, sequence: int, offset: int) -> None:
        runs.append((length, used[length], count, sequence, offset))
        used[length] += count
        left[length] -= count

    def leave(room: int, sequence: int, count: int) -> None:
        if room > 0 and count > 0:
            if room not in groups:
                groups[room] = []
                bisect.insort(rooms, room)
            groups[room].append((sequence, count))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        i = bisect.bisect_right(large, capacity - a) - 1
        while i >= 0 and large[i] == a and left[a] < 2:
            i -= 1
        if i < 0:
            n, room = left[a], capacity - a
            put(a, n, opened, 0)
        else:
            b = large[i]
            n, room = (left[a] // 2 if a == b else min(left[a], left[b])), capacity - a - b
            put(a, n, opened, 0)
            put(b, n, opened, a)
        leave(room, opened, n)
        opened += n
        large = [x for x in large if left[x]] if i < 0 or not left[a] or not left[large[i]] else large

    for length in sorted((n for n in left if left[n] and 3 * n <= capacity), reverse=True):
        while left[length]:
            i = bisect.bisect_left(rooms, length)
            if i == len(rooms):
                each = capacity // length
                new = max(1, left[length] // each)
                leave(capacity, opened, new)
                opened += new
                continue
            room = rooms[i]
            sequence, many = groups[room].pop()
            if not groups[room]:
                del groups[room], rooms[i]
            each = room // length
            full = min(many, left[length] // each)
            for slot in range(each if full else 0):
                put(length, full, sequence, capacity - room + slot * length)
            leave(room - each * length, sequence, full)
            if full < many:  # the rest of this length, fewer than one sequence takes
                some = left[length]
                for slot in range(some):
                    put(length, 1, sequence + full, capacity - room + slot * length)
                leave(room - some * length, sequence + full, 1)
                leave(room, sequence + full + 1, many - full - 1)
    return runs


def pieces(docs: DataFrame, encoding: Encoding, capacity: int = CAPACITY) -> DataFrame:
    """`doc_id`, `piece`, `start`, `length`, `ids` (little-endian unsigned 32-bit) of every document, cut only where
    a document is longer than the capacity. Stored once, as encoding is the costly part."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, blobs in encoded(batches, encoding):
            out: list[list] = [[], [], [], [], []]
            for doc, blob in zip(ids, blobs):
                for piece, start in enumerate(range(0, len(blob) // 4, capacity)):
                    part = blob[4 * start:4 * (start + capacity)]
                    for column, value in zip(out, (doc, piece, start, len(part) // 4, part)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()),
                 pa.array(out[3], pa.int64()), pa.array(out[4], pa.binary())],
                ["doc_id", "piece", "start", "length", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with small_batches(docs.sparkSession):
        return materialize(rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary"), "pieces")


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add `sequence_id` and `offset` to pieces (`doc_id`, `piece`, `length` of 1 to `capacity`, any more columns).

    Pieces are counted per length (at most `capacity` numbers reach the driver, however many pieces
    there are), the counts are packed by `plan`, and each piece takes the place of its number within its
    length. A hot length is numbered in slices.

    A null doc_id is kept; repeated rows are packed one by one; an empty table gives no rows. Columns named
    `sequence_id` or `offset` are replaced.
    """
    names = [c for c in cut.columns if c not in ("sequence_id", "offset")]
    others = [c for c in names if c not in ("doc_id", "piece", "length")]
    # The other columns travel as one, so that none can clash with those needed on the way.
    cut = cut.select("doc_id", "piece", "length", (F.struct(*quoted(others)) if others else F.lit(0)).alias("_carried"), F.lit(1).cast("long").alias("_one"))
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    runs = np.array(sorted(plan(counts, capacity)), dtype=np.int64).reshape(-1, len(_RUN))
    starts = (runs[:, 0] << 44) | runs[:, 1]
    numbered = add_running(cut, ["length"], ["doc_id", "piece"], "_one", ["doc_id", "piece"], slice_count(sum(counts.values())))
    numbered = numbered.select(*[F.col(f"_carried.`{c.replace('`', '``')}`").alias(c) if c in others else c for c in names], F.col("before").alias("_number"))
    kept = numbered.schema.fields[:-1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(len(kept)).to_numpy(zero_copy_only=False)
            length = batch.column("length").to_numpy(zero_copy_only=False)
            at = np.searchsorted(starts, (length << 44) | number, side="right") - 1
            sequence = runs[at, 3] + number - runs[at, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(runs[at, 4])],
                [*(f.name for f in kept), "sequence_id", "offset"])

    schema = ddl(kept)
    return map_batches(numbered, place, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: `sequence_id`, `ids`. A sequence holds at most the capacity, so no group is large."""
    joined = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(joined, F.lit(b"").cast("binary"), lambda out, part: F.concat(out, part["ids"]))
    return packed.groupBy("sequence_id").agg(whole.alias("ids"))
