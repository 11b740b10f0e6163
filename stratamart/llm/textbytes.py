"""Words and lines of whole texts as numpy arrays over their UTF-8 bytes.

All separators used here are ASCII, and no byte of a longer UTF-8 character is, so cutting at bytes is
cutting at characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text looked at together; one longer text is looked at alone. Memory only.
CHUNK_BYTES = 1 << 20


def byte_set(*values: int | range) -> np.ndarray:
    """Which of the 256 byte values belong to a set of values and ranges."""
    found = np.zeros(256, dtype=bool)
    for value in values:
        found[list(value) if isinstance(value, range) else value] = True
    return found


def lowered() -> np.ndarray:
    """Every byte value with A-Z as a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A"):ord("Z") + 1] += 32
    return table


def chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of at most `size` bytes of `text` together (or one row), the bytes, and where each row's begin and the last ends."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(lengths, dtype=np.int64), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
            rows = batch.slice(at, stop - at)
            texts = pc.fill_null(rows.column("text").cast(pa.large_binary()), b"")
            _, offsets, data = texts.buffers()
            edges = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
            raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
            yield rows, raw[edges[0]:edges[-1]], edges - edges[0]
            at = stop
            pa.default_memory_pool().release_unused()


def runs(inside: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the longest runs of true values that cross no edge."""
    if not len(inside):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    cut = np.zeros(len(inside) + 1, dtype=bool)
    cut[edges] = True
    cut[0] = cut[-1] = True
    cut[1:-1] |= ~inside[:-1] | ~inside[1:]
    return np.flatnonzero(cut[:-1] & inside), np.flatnonzero(cut[1:] & inside) + 1


def encoded(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number per run of bytes, equal for equal runs, and the runs that the numbers stand for."""
    steps = np.zeros(len(raw) + 1, dtype=np.int8)
    steps[begins] += 1
    steps[ends] -= 1
    kept = raw[np.cumsum(steps[:-1], dtype=np.int8).astype(bool)]
    offsets = np.concatenate(([0], np.cumsum(ends - begins, dtype=np.int64)))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    found = words.dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), found.dictionary


def per_row(mask: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many values are true between each two edges."""
    sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return sums[edges[1:]] - sums[edges[:-1]]


def row_of(places: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The row between whose edges each place lies."""
    return np.searchsorted(edges, places, side="right") - 1
