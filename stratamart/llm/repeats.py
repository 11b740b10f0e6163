"""Exact removal of repeated passages by prefix-free parsing.

Texts are parsed into overlapping phrases at triggers that a rolling hash picks. Equal strings of the match
length lie in phrases with the same trigger string, at the same place before it. So only phrases
whose trigger occurs in more than one document can hold a match; they form the dictionary. The suffixes
of the dictionary's phrases, cut at the match length, are sorted; runs of equal suffixes are the classes of equal
strings, and the parse (which documents hold which phrase) gives each class its smallest document.

The work is dealt out by trigger. Texts lie in chunks; a chunk and a bucket of triggers exchange one row of
packed numbers per step, however many phrases they share.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stratamart.llm.common import give_back, id_of, key_of, quoted
from stratamart.staging import materialize

MATCH = 50
#: Bytes of a trigger string; every match holds MATCH - TRIGGER + 1 of them, one of which is its trigger.
TRIGGER = 24
#: Bytes of a chunk, of a segment that is parsed at a time (below 2^23), and phrases of a bucket; layout only.
CHUNK, SEGMENT, BUCKET = 1 << 21, 1 << 20, 1 << 19
#: Suffixes sorted at a time (about 200 bytes each); layout only.
SORTED = 1 << 19

_BASE, _MIX = 0x100000001B3, 0x9E3779B97F4A7C15
_PLACE_BITS = 23


def _rolled(data: np.ndarray, length: int) -> np.ndarray:
    """Rolling hash of every `length` bytes, built from those of half the length."""
    def power(n: int) -> np.uint64:
        return np.uint64(pow(_BASE, n, 1 << 64))

    done, total, size, doubled = None, 0, 1, data.astype(np.uint64) + np.uint64(1)
    while True:
        if length & size:
            done = doubled if done is None else doubled[:len(data) - total - size + 1] * power(total) + done[size:]
            total += size
        if total == length:
            break
        doubled = doubled[:-size] * power(size) + doubled[size:]
        size *= 2
    done ^= done >> np.uint64(32)
    done *= np.uint64(_MIX)
    done ^= done >> np.uint64(29)
    return done


class Parse(NamedTuple):
    """Phrases in order: the first byte of the first of `count` strings of the match length, the trigger's first byte,
    a hash of the trigger string, and the number of the text."""

    first: np.ndarray
    count: np.ndarray
    trigger: np.ndarray
    hash: np.ndarray
    piece: np.ndarray


def parse(data: np.ndarray, starts: np.ndarray, match: int = MATCH, width: int = TRIGGER) -> Parse:
    """Parse texts that lie one after another in `data`, text i (not empty) from `starts[i]` on. A string's trigger is its
    leftmost `width` bytes of least hash. Long data goes in segments; a phrase ends with its segment."""
    ends = np.append(starts[1:], len(data)) - match + 1  # strings of a text begin before this
    parts = [_parse_segment(data, at, min(at + SEGMENT, len(data) - match + 1), starts, ends, match, width)
             for at in range(0, max(0, len(data) - match + 1), SEGMENT)]
    if not parts:
        empty = np.empty(0, np.int64)
        return Parse(empty, empty, empty, empty.astype(np.uint64), empty)
    first, count, trigger, hashed = (np.concatenate(c) for c in zip(*parts))
    return Parse(first, count, trigger, hashed, np.searchsorted(starts, first, side="right") - 1)


def _parse_segment(data: np.ndarray, begin: int, end: int, starts: np.ndarray, ends: np.ndarray, match: int,
                   width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of the strings that begin from `begin` to before `end`."""
    n = end - begin
    hashes = _rolled(data[begin:end + match - 1], width)
    place = np.uint64((1 << _PLACE_BITS) - 1)
    least = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    span, size = match - width + 1, 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < span:
        least = np.minimum(least[:n], least[span - size:span - size + n])
    trigger = (least[:n] & place).astype(np.int64)
    some = (starts < end) & (ends > begin) & (ends > starts)
    delta = np.zeros(n + 1, dtype=np.int8)
    np.add.at(delta, np.maximum(starts[some] - begin, 0), 1)
    np.add.at(delta, np.minimum(ends[some] - begin, n), -1)
    valid = np.cumsum(delta[:n], dtype=np.int8) > 0
    new = np.empty(n, dtype=bool)
    new[0] = True
    new[1:] = (trigger[1:] != trigger[:-1]) | (valid[1:] != valid[:-1])
    inside = starts[(starts >= begin) & (starts < end)] - begin
    new[inside] = True
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, n))
    keep = valid[first]
    first, count = first[keep], count[keep]
    trigger = trigger[first]
    hashed = hashes[trigger] * np.uint64(_BASE | 2)  # least hashes are small numbers: spread them again
    hashed ^= hashed >> np.uint64(31)
    hashed *= np.uint64(_MIX)
    return first + begin, count, trigger + begin, hashed


def chunks(docs: DataFrame, size: int = CHUNK, carry: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Store whole texts in compressed chunks of about `size` bytes (a longer text is a chunk of its own): `chunk`, `raw`
    (bytes), `data`, and per text `docs`, `lengths` and `others`, the columns to be carried."""
    rows = docs.select(key_of("doc_id").alias("_doc"), F.col("text").cast("string").alias("text"),
                       F.struct(*[c.alias(f"c{i}") for i, c in enumerate(quoted(list(carry)))] or [F.lit(0).alias("none")]).alias("others"))
    others = rows.schema["others"].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        compress = zstandard.ZstdCompressor(level=3).compress
        held: list[tuple] = []
        raw = 0

        def flush() -> pa.RecordBatch:
            ids, texts, kept = zip(*held)
            carried = pa.concat_arrays(kept)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([raw], pa.int64()), pa.array([compress(b"".join(texts))], pa.binary()),
                 pa.array([_packed(ids)], pa.binary()), pa.array([_packed(list(map(len, texts)))], pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, len(carried)], pa.int32()), carried)],
                ["chunk", "raw", "data", "docs", "lengths", "others"])

        for batch in batches:
            for i, (doc, text) in enumerate(zip(batch.column("_doc").to_pylist(), batch.column("text").to_pylist())):
                data = (text or "").encode("utf-8", "surrogatepass")
                if held and raw + len(data) > size:
                    yield flush()
                    held, raw, number = [], 0, number + 1
                held.append((doc, data, batch.column("others").slice(i, 1)))
                raw += len(data)
        if held:
            yield flush()

    return materialize(rows.mapInArrow(
        gather, f"chunk long, raw long, data binary, docs binary, lengths binary, others array<{others}>"), "chunks")


def _packed(numbers) -> bytes:
    return np.array(numbers, dtype="<i8").tobytes()


class _Chunk:
    """A chunk's text, its parse, and its phrases numbered by bucket and trigger."""

    def __init__(self, values: dict, bits: int, match: int, width: int) -> None:
        self.docs, self.lengths = (np.frombuffer(values[c], dtype="<i8") for c in ("docs", "lengths"))
        self.raw = zstandard.ZstdDecompressor().decompress(values["data"], max_output_size=max(1, int(values["raw"])))
        self.data = np.frombuffer(self.raw, dtype=np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.match = match
        # Empty texts share their start with the next one; they have no strings.
        full = np.flatnonzero(self.lengths > 0)
        self.parse = parse(self.data, self.starts[full], match, width)
        self.piece = full[self.parse.piece] if len(full) else self.parse.piece
        self.kinds, self.kind = np.unique(self.parse.hash, return_inverse=True)
        self.bucket = (self.kinds >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(self.kinds), np.int64)
        self.buckets = np.unique(self.bucket)
        self.edges = np.append(np.searchsorted(self.bucket, self.buckets), len(self.bucket))

    def parts(self) -> Iterator[tuple[int, slice]]:
        for bucket, a, b in zip(self.buckets.tolist(), self.edges[:-1].tolist(), self.edges[1:].tolist()):
            yield bucket, slice(a, b)

    def several(self) -> np.ndarray:
        """Which triggers occur in more than one text of the chunk."""
        row = self.piece
        low = np.full(len(self.kinds), np.iinfo(np.int64).max)
        high = np.full(len(self.kinds), np.iinfo(np.int64).min)
        np.minimum.at(low, self.kind, row)
        np.maximum.at(high, self.kind, row)
        return low != high

    def phrases(self, shared: np.ndarray) -> tuple[dict[bytes, int], np.ndarray, np.ndarray, np.ndarray]:
        """Distinct phrases of the shared triggers in order of trigger: themselves (with the trigger's place before
        them), the number of each parsed phrase of those, its position in the parse, and the smallest document of each."""
        at = np.flatnonzero(shared[self.kind])
        at = at[np.argsort(self.kind[at], kind="stable")]
        first, count = self.parse.first[at], self.parse.count[at]
        place = self.parse.trigger[at] - first
        found: dict[bytes, int] = {}
        raw, tail = self.raw, self.match - 1
        number = np.fromiter((found.setdefault(bytes((p,)) + raw[f:f + c + tail], len(found))
                              for f, c, p in zip(first.tolist(), count.tolist(), place.tolist())), dtype=np.int64, count=len(at))
        smallest = np.full(len(found), np.iinfo(np.int64).max)
        np.minimum.at(smallest, number, self.docs[self.piece[at]])
        return found, number, at, smallest


def _low(kinds: np.ndarray) -> np.ndarray:
    return kinds.astype(np.uint32)


def _shared_in_bucket(group: pd.DataFrame) -> pd.DataFrame:
    """Per chunk, which of its triggers occur in another text. Only their low bits are compared: a clash adds a candidate."""
    parts = [np.frombuffer(b, dtype="<u4") for b in group["low"]]
    marked = [np.unpackbits(np.frombuffer(b, dtype=np.uint8), count=len(p)).astype(bool) for b, p in zip(group["several"], parts)]
    values, inverse, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    shared = counts > 1
    shared[inverse[np.concatenate(marked)]] = True
    hits = shared[inverse]
    out, at = [], 0
    for p in parts:
        mask = hits[at:at + len(p)]
        out.append(np.packbits(mask).tobytes() if mask.any() else None)
        at += len(p)
    frame = pd.DataFrame({"chunk": group["chunk"].to_numpy(), "bucket": group["bucket"].to_numpy(), "mask": out})
    del parts, marked, values, inverse, counts, hits
    give_back()
    return frame[frame["mask"].notna()]


def _slices(triggers: np.ndarray, sizes: np.ndarray, at_once: int) -> Iterator[slice]:
    """Cut phrases in order of trigger into runs of about `at_once` strings that part no trigger."""
    total = np.cumsum(sizes)
    borders = np.append(np.flatnonzero(np.diff(triggers, prepend=-1)), len(triggers))
    at = 0
    while at < len(triggers):
        fits = np.searchsorted(total, (total[at - 1] if at else 0) + at_once, side="right")
        stop = int(borders[np.searchsorted(borders, fits, side="right") - 1])
        if stop <= at:
            stop = int(borders[np.searchsorted(borders, at, side="right")])
        yield slice(at, stop)
        at = stop


def _classes(text: np.ndarray, where: np.ndarray, match: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes of `text` at `where`, cut at the match length: their order, and the first of each class of equal ones."""
    words = np.zeros((len(where), -(-match // 8) * 8), dtype=np.uint8)
    words[:, :match] = np.lib.stride_tricks.sliding_window_view(text, match)[where]
    words = words.view(">u8").astype(np.uint64)
    order = np.lexsort(words.T[::-1])
    words = words[order]
    return order, np.flatnonzero(np.concatenate(([True], (words[1:] != words[:-1]).any(axis=1))))


def smallest_documents(phrases: list[bytes], documents: np.ndarray, triggers: np.ndarray, match: int = MATCH,
                       at_once: int = SORTED) -> list[np.ndarray]:
    """For every string of the match length in distinct phrases (first byte: place of the trigger), the smallest document
    that holds it. `triggers` numbers each phrase's trigger; a trigger with one phrase needs no sorting.

    Equal strings have the same trigger at the same place, so the dictionary's suffixes are sorted by runs of
    triggers, and those of a trigger with more than `at_once` strings place by place.
    """
    counts = np.array([len(p) - match for p in phrases], dtype=np.int64)
    base = np.cumsum(counts) - counts
    least = np.repeat(documents, counts)
    several = np.bincount(triggers, minlength=len(phrases) + 1)[triggers] > 1
    some = np.flatnonzero(several)
    some = some[np.argsort(triggers[some], kind="stable")]
    for run in _slices(triggers[some], counts[some], at_once):
        part = some[run]
        text = np.frombuffer(b"".join([phrases[i][1:] for i in part]), dtype=np.uint8)
        c = counts[part]
        within = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        where = np.repeat(np.cumsum(c + match - 1) - (c + match - 1), c) + within
        at = np.repeat(base[part], c) + within
        sets = [slice(None)]
        if len(at) > at_once:
            place = np.repeat(np.array([phrases[i][0] for i in part], dtype=np.int64), c) - within
            order = np.argsort(place, kind="stable")
            sets = np.split(order, np.flatnonzero(np.diff(place[order])) + 1)
        for strings in sets:
            order, first = _classes(text, where[strings], match)
            sorted_at = at[strings][order]
            least[sorted_at] = np.repeat(np.minimum.reduceat(least[sorted_at], first), np.diff(np.append(first, len(order))))
    return np.split(least, np.cumsum(counts)[:-1])


def _bits_of_bucket(match: int, width: int):
    def answer(group: pd.DataFrame) -> pd.DataFrame:
        """Per chunk and phrase, which strings also begin in a document smaller than the chunk's smallest with that phrase."""
        known: dict[bytes, int] = {}
        of, docs = [], []
        for data, sizes, smallest in zip(group["phrases"], group["sizes"], group["smallest"]):
            data, smallest = zstandard.decompress(data), zstandard.decompress(smallest)
            ends = np.cumsum(np.frombuffer(sizes, dtype=np.uint8).astype(np.int64))
            of.append([known.setdefault(data[a:b], len(known)) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())])
            docs.append(np.frombuffer(smallest, dtype="<i8"))
        numbers, all_docs = np.concatenate([np.array(x, dtype=np.int64) for x in of]), np.concatenate(docs)
        lowest = np.full(len(known), np.iinfo(np.int64).max)
        np.minimum.at(lowest, numbers, all_docs)
        phrases = list(known)
        names: dict[bytes, int] = {}
        triggers = np.array([names.setdefault(p[1 + p[0]:1 + p[0] + width], len(names)) for p in phrases], dtype=np.int64)
        del known, names
        least = smallest_documents(phrases, lowest, triggers, match)
        out = []
        for own, smallest in zip(of, docs):
            flags = [least[p] < d for p, d in zip(own, smallest.tolist())]
            out.append(np.packbits(np.concatenate(flags)).tobytes())
        del of, docs, phrases, least
        give_back()
        return pd.DataFrame({"chunk": group["chunk"].to_numpy(), "bucket": group["bucket"].to_numpy(),
                             "mask": group["mask"].to_numpy(), "bits": out})
    return answer


def _per_chunk(store: DataFrame, answers: DataFrame, *columns: str) -> DataFrame:
    """The chunks with their answers, one list entry per bucket."""
    lists = answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", *columns)).alias("answers"))
    return store.join(lists, "chunk", "left")


def _shared_kinds(chunk: _Chunk, answers: list[dict] | None) -> tuple[np.ndarray, dict[int, dict]]:
    by_bucket = {a["bucket"]: a for a in answers or []}
    shared = np.zeros(len(chunk.kinds), dtype=bool)
    for bucket, part in chunk.parts():
        if bucket in by_bucket:
            shared[part] = np.unpackbits(np.frombuffer(by_bucket[bucket]["mask"], dtype=np.uint8), count=part.stop - part.start).astype(bool)
    return shared, by_bucket


def removed_spans(docs: DataFrame, match: int = MATCH, width: int = TRIGGER, chunk_bytes: int = CHUNK,
                  bucket_phrases: int = BUCKET, carry: list[str] | tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """Per row `doc_id`, `n_bytes`, `spans` (array of start and end, in bytes, end excluded) and `kept` (the remaining
    bytes) after removal of every byte that lies in a string of `match` bytes which also starts in a document
    with a smaller doc_id. Strings are judged on the input. The columns in `carry` follow. With `as_text`, `kept` is a
    string, without the bytes left of a cut character.

    A null text is empty. A null doc_id counts as larger than all others. Rows that repeat a doc_id are not
    smaller than each other, so neither loses bytes to the other. Texts shorter than a match lose nothing; empty tables
    give empty results; other columns are ignored.
    """
    whole = chunks(docs, chunk_bytes, carry)
    store = whole.drop("others")
    raw = store.agg(F.sum("raw")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, raw / ((match - width + 2) / 2) / bucket_phrases))))

    def chunkwise(work):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Each chunk with all that is made of it is gone before the next one is unpacked.
            for batch in batches:
                for i in range(batch.num_rows):
                    values = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                    result = work(values, _Chunk(values, bits, match, width))
                    del values
                    if result is not None:
                        yield result
                    del result
                    give_back()
        return run

    def triggers(values: dict, chunk: _Chunk) -> pa.RecordBatch:
        several = chunk.several()
        parts = list(chunk.parts())
        return pa.RecordBatch.from_arrays(
            [pa.array([b for b, _ in parts], pa.int64()), pa.array([values["chunk"]] * len(parts), pa.int64()),
             pa.array([_low(chunk.kinds[p]).tobytes() for _, p in parts], pa.binary()),
             pa.array([np.packbits(several[p]).tobytes() for _, p in parts], pa.binary())],
            ["bucket", "chunk", "low", "several"])

    sent = store.mapInArrow(chunkwise(triggers), "bucket long, chunk long, low binary, several binary")
    masks = sent.groupBy("bucket").applyInPandas(_shared_in_bucket, "chunk long, bucket long, mask binary")

    def candidates(values: dict, chunk: _Chunk) -> pa.RecordBatch | None:
        compress = zstandard.ZstdCompressor(level=3).compress
        shared, by_bucket = _shared_kinds(chunk, values["answers"])
        found, number, at, smallest = chunk.phrases(shared)
        if not found:
            return None
        phrases = list(found)
        kind = np.empty(len(phrases), dtype=np.int64)
        kind[number] = chunk.kind[at]
        edges = np.searchsorted(kind, chunk.edges)
        out = [(b, x, y) for b, x, y in zip(chunk.buckets.tolist(), edges[:-1].tolist(), edges[1:].tolist()) if y > x]
        return pa.RecordBatch.from_arrays(
            [pa.array([b for b, _, _ in out], pa.int64()), pa.array([values["chunk"]] * len(out), pa.int64()),
             pa.array([by_bucket[b]["mask"] for b, _, _ in out], pa.binary()),
             pa.array([compress(b"".join(phrases[x:y])) for _, x, y in out], pa.binary()),
             pa.array([bytes(map(len, phrases[x:y])) for _, x, y in out], pa.binary()),
             pa.array([compress(_packed(smallest[x:y])) for _, x, y in out], pa.binary())],
            ["bucket", "chunk", "mask", "phrases", "sizes", "smallest"])

    dictionary = _per_chunk(store, masks, "mask").mapInArrow(
        chunkwise(candidates), "bucket long, chunk long, mask binary, phrases binary, sizes binary, smallest binary")
    answers = dictionary.groupBy("bucket").applyInPandas(
        _bits_of_bucket(match, width), "chunk long, bucket long, mask binary, bits binary")

    others = whole.schema["others"].dataType.elementType
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
             pa.string() if as_text else pa.binary(), to_arrow_type(others)]

    def remove(values: dict, chunk: _Chunk) -> pa.RecordBatch:
        rows = _results(chunk, _marked(chunk, values["answers"]), values["others"])
        columns = list(zip(*rows))
        if as_text:
            columns[3] = [None if data is None else data.decode("utf-8", "ignore") for data in columns[3]]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          ["doc", "n_bytes", "spans", "kept", "others"])

    remaining = "string" if as_text else "binary"
    schema = f"doc long, n_bytes long, spans array<struct<start:long,end:long>>, kept {remaining}, others {others.simpleString()}"
    result = _per_chunk(whole, materialize(answers, "repeat_answers"), "mask", "bits").mapInArrow(chunkwise(remove), schema)
    return result.select(id_of("doc").alias("doc_id"), "n_bytes", "spans", "kept",
                         *[F.col(f"others.c{i}").alias(c) for i, c in enumerate(carry) if c != "doc_id"])


def without_passages(docs: DataFrame, match: int = MATCH) -> DataFrame:
    """The columns of `docs` with the repeated passages cut out of `text`; bytes left of a cut character go too."""
    carried = [c for c in docs.columns if c not in ("doc_id", "text", "n_bytes", "spans", "kept")]
    # Decoded where it is cut: a second Python step would keep a second worker beside each task's own.
    found = removed_spans(docs, match, carry=carried, as_text=True)
    found = found.toDF(*[f"c{i}" for i in range(len(found.columns))])
    return found.select(F.col("c0").alias("doc_id"), *[F.col(f"c{i}").alias(c) for i, c in enumerate(carried, 4)], F.col("c3").alias("text"))


def _marked(chunk: _Chunk, answers: list[dict] | None) -> np.ndarray:
    """First bytes of the strings that also begin in a smaller document."""
    shared, by_bucket = _shared_kinds(chunk, answers)
    found, number, at, smallest = chunk.phrases(shared)
    n = len(chunk.data)
    marked = np.zeros(n + 1, dtype=np.int32)
    if not found:
        return np.empty(0, np.int64)
    sizes = np.array([len(p) - chunk.match for p in found], dtype=np.int64)
    kind = np.empty(len(sizes), dtype=np.int64)
    kind[number] = chunk.kind[at]
    edges = np.searchsorted(kind, chunk.edges)
    flags = np.zeros(sizes.sum(), dtype=bool)
    base = np.cumsum(sizes) - sizes
    bounds = np.append(base, sizes.sum())
    for bucket, x, y in zip(chunk.buckets.tolist(), edges[:-1].tolist(), edges[1:].tolist()):
        if y > x and bucket in by_bucket:
            a, b = bounds[x], bounds[y]
            flags[a:b] = np.unpackbits(np.frombuffer(by_bucket[bucket]["bits"], dtype=np.uint8), count=b - a)
    count = chunk.parse.count[at]
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    later = chunk.docs[chunk.piece[at]] > smallest[number]
    hit = np.repeat(later, count) | flags[np.repeat(base[number], count) + within]
    return (np.repeat(chunk.parse.first[at], count) + within)[hit]


def _results(chunk: _Chunk, marked: np.ndarray, others: list[dict]) -> list[tuple]:
    """Per text its document, bytes, removed spans, remaining bytes and carried columns."""
    delta = np.zeros(len(chunk.data) + chunk.match + 1, dtype=np.int16)
    np.add.at(delta, marked, 1)
    np.add.at(delta, marked + chunk.match, -1)
    covered = np.cumsum(delta, dtype=np.int16)[:len(chunk.data)] > 0
    out = []
    for doc, start, length, other in zip(chunk.docs.tolist(), chunk.starts.tolist(), chunk.lengths.tolist(), others):
        edge = np.diff(np.concatenate(([0], covered[start:start + length].astype(np.int8), [0])))
        data, parts, spans, at = chunk.raw[start:start + length], [], [], 0
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            parts.append(data[at:a])
            spans.append({"start": a, "end": b})
            at = b
        parts.append(data[at:])
        out.append((doc, length, spans, b"".join(parts), other))
    return out
