"""Phrases whose words occur together more often than apart, by mining relations of occurrences length by length.

The relation of a length holds the occurrences of its phrases, sorted by piece and position. It is kept in blocks: a
row holds a run of positions of one language, and for each position the number of the phrase that begins there; the
block's distinct phrases and their counts lie beside it, dealt into buckets by a hash. Positions skip one between
pieces, so neighbours are in one piece. All of it is packed, so a shuffle carries a few bytes per phrase and no row each.

- Counting: the phrases of all blocks meet in their bucket and are summed there.
- Semi-join: of those frequent enough, each block gets the number of the phrase back.
- Extension: occurrences at adjacent positions of a block merge into those of the next length.

Every relation is written before the next step. A phrase is at most one entry per block, however often it occurs, so no
phrase is hot: that is what blocks are for. Buckets follow the number of words, so that each fits a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratamart.llm.textbytes import byte_set, chunks, encoded, lowered, row_of, runs
from stratamart.staging import materialize

_LOWERED = lowered()
_BREAKS = byte_set(*b".,;:!?", range(0x0A, 0x0E))
_WORD_BYTES = ~(_BREAKS | byte_set(0x20, 0x09))

LEAST_COUNT, LONGEST, ABSORBED_PERCENT = 100, 5, 100
#: Positions of a block (one longer piece makes a longer block). Layout only.
BLOCK_WORDS = 1 << 18
#: Words per bucket, bytes of text per bucket where words are not counted yet, and the fewest buckets. Layout only.
BUCKET_WORDS, BUCKET_BYTES, LEAST_BUCKETS = 1 << 22, 1 << 24, 64

#: A row is a block's occurrences (`words` of them, `codes`), or its phrases of one bucket: those numbered from `base` on.
_RELATION = "block long, lang string, words long, codes binary, bucket int, base int, keys binary"
_FOUND = "lang string, block long, places binary, id long, f long, "
_MIX = np.uint64(0x9E3779B97F4A7C15)


def pack(*columns: np.ndarray) -> bytes:
    """Arrays as compressed bytes: per array its type, its length and its bytes, those of equal significance together."""
    parts = []
    for column in columns:
        column = np.ascontiguousarray(column)
        parts.append(f"{column.dtype.char}{len(column)};".encode())
        parts.append(column.view(np.uint8).reshape(len(column), column.itemsize).T.tobytes())
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def unpack(packed: bytes) -> list[np.ndarray]:
    size = int.from_bytes(packed[:8], "little")
    raw = pa.Codec("zstd").decompress(packed[8:], size, asbytes=True)
    out, at = [], 0
    while at < size:
        end = raw.index(b";", at)
        kind, count = np.dtype(chr(raw[at])), int(raw[at + 1:end])
        at = end + 1 + count * kind.itemsize
        planes = np.frombuffer(raw, np.uint8, count * kind.itemsize, end + 1).reshape(kind.itemsize, count)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
    return out


def _smallest(values: np.ndarray) -> np.ndarray:
    """The same numbers in 32 bits where they fit."""
    return values.astype(np.int32) if not len(values) or values.max() < 1 << 31 else values.astype(np.int64)


def _relation_rows(block: int, lang: str, codes: np.ndarray, buckets: np.ndarray, keys: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    """The rows of one block: its occurrences, then (first, number, packed) of its phrases per bucket."""
    more = len(keys)
    return pa.RecordBatch.from_arrays(
        [pa.array([block] * (1 + more), pa.int64()), pa.array([lang] * (1 + more)), pa.array([int((codes >= 0).sum())] + [0] * more, pa.int64()),
         pa.array([pack(codes.astype(np.int32))] + [None] * more, pa.binary()), pa.array([None, *buckets.tolist()], pa.int32()),
         pa.array([None, *(first for first, _, _ in keys)], pa.int32()), pa.array([None, *(data for _, _, data in keys)], pa.binary())],
        ["block", "lang", "words", "codes", "bucket", "base", "keys"])


def _dealt(buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, begin, end) of ascending buckets."""
    found, first = np.unique(buckets, return_index=True)
    yield from zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(buckets)])


def _word_hash(lengths: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """A hash per word: a polynomial of its bytes, mixed. It only deals words into buckets."""
    if not len(lengths):
        return np.zeros(0, dtype=np.uint64)
    begins = np.cumsum(lengths) - lengths
    powers = np.multiply.accumulate(np.full(int(lengths.max()), np.uint64(0x100000001B3)))
    terms = (raw.astype(np.uint64) + np.uint64(1)) * powers[np.arange(len(raw)) - np.repeat(begins, lengths)]
    return _mixed(np.add.reduceat(terms, begins))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


class _Pending:
    """Occurrences of one language, gathered until they fill a block."""

    def __init__(self) -> None:
        self.codes: list[np.ndarray] = []
        self.words: list[pa.Array] = []
        self.size = self.known = 0

    def add(self, codes: np.ndarray, words: pa.Array) -> None:
        """Codes number `words`; -1 stands between pieces."""
        self.codes.append(np.where(codes >= 0, codes + self.known, -1))
        self.words.append(words)
        self.known += len(words)
        self.size += len(codes)

    def block(self) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """Codes of the distinct words, these words, and how often each occurs."""
        codes = np.concatenate(self.codes)
        found = pa.chunked_array(self.words).combine_chunks().dictionary_encode()
        inside = codes >= 0
        codes[inside] = found.indices.to_numpy().astype(np.int64)[codes[inside]]
        return codes, found.dictionary, np.bincount(codes[inside], minlength=len(found.dictionary))


def _word_rows(block: int, lang: str, codes: np.ndarray, words: pa.Array, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Rows of a block of single words, renumbered by bucket and by bytes within it."""
    lengths, raw = _bytes_of(words)
    bucket = (_word_hash(lengths, raw) % np.uint64(buckets)).astype(np.int64)
    by_bytes = np.empty(len(words), dtype=np.int64)
    by_bytes[pc.sort_indices(words).to_numpy()] = np.arange(len(words))
    order = np.lexsort((by_bytes, bucket))
    renumbered = np.full(len(words) + 1, -1, dtype=np.int64)
    renumbered[order] = np.arange(len(words))
    words, counts, bucket = words.take(pa.array(order)), counts[order], bucket[order]
    parts = list(_dealt(bucket))
    keys = [(a, b - a, pack(_smallest(counts[a:b]), *_packable(words.slice(a, b - a)))) for _, a, b in parts]
    return _relation_rows(block, lang, renumbered[codes], np.array([p[0] for p in parts], dtype=np.int64), keys)


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and bytes of large binaries."""
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset:words.offset + len(words) + 1]
    data = words.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return np.diff(offsets), raw


def _packable(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lengths, raw = _bytes_of(words)
    return _smallest(lengths), raw


def _occurrences(docs: DataFrame, block_words: int, buckets: int) -> DataFrame:
    """The relation of single words."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        emitted = 0
        pending: dict[str, _Pending] = {}

        def emit(lang: str) -> pa.RecordBatch:
            nonlocal emitted
            emitted += 1
            return _word_rows(task + emitted, lang, *pending.pop(lang).block(), buckets)

        for rows, raw, edges in chunks(batches):
            langs = rows.column(0).dictionary_encode()
            begins, ends = runs(_WORD_BYTES[raw], edges)
            codes, found = encoded(_LOWERED[raw], begins, ends)
            docs_of = row_of(begins, edges)
            breaks = np.concatenate(([0], np.cumsum(_BREAKS[raw], dtype=np.int64)))[begins]
            lang_of = langs.indices.to_numpy().astype(np.int64)[docs_of]
            for at, lang in enumerate(langs.dictionary.to_pylist()):
                mine = np.flatnonzero(lang_of == at)
                if not len(mine):
                    continue
                new_piece = np.ones(len(mine), dtype=np.int64)
                new_piece[1:] = (docs_of[mine][1:] != docs_of[mine][:-1]) | (breaks[mine][1:] != breaks[mine][:-1])
                place = np.arange(len(mine)) + np.cumsum(new_piece)
                spaced = np.full(int(place[-1]) + 1, -1, dtype=np.int64)
                some, local = np.unique(codes[mine], return_inverse=True)
                spaced[place] = local
                words = found.take(pa.array(some))
                # A chunk is cut between pieces only; one longer piece makes one longer block.
                pieces = np.flatnonzero(spaced < 0)
                start = 0
                while start < len(spaced):
                    room = block_words - (pending[lang].size if lang in pending else 0)
                    stop = len(spaced)
                    if stop - start > room:
                        fitting = pieces[(pieces > start) & (pieces <= start + max(room, 0))]
                        later = pieces[pieces > start]
                        stop = int(fitting[-1]) if len(fitting) else (start if lang in pending else int(later[0]) if len(later) else stop)
                    if stop > start:
                        pending.setdefault(lang, _Pending()).add(spaced[start:stop], words)
                    if stop < len(spaced) or pending[lang].size >= block_words:
                        yield emit(lang)
                    start = stop
        for lang in list(pending):
            yield emit(lang)

    read = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return materialize(read.mapInArrow(cut, _RELATION), "occurrences_1")


def _frequent(relation: DataFrame, single: bool, buckets: int, least: int, label: str) -> DataFrame:
    """What occurs often enough: per phrase a row with its `id`, `f` and what it is of (`word`, or the ids `left` and `right` of
    the phrases without its last and first word), and per block and bucket a row with the `places` of such phrases,
    their numbers in the block and their ids. Ids are unique per length and language."""
    what = "word string" if single else "left long, right long"
    kinds = [pa.string()] if single else [pa.int64(), pa.int64()]
    schema = pa.schema([("lang", pa.string()), ("block", pa.int64()), ("places", pa.binary()), ("id", pa.int64()), ("f", pa.int64()),
                        *zip(["word"] if single else ["left", "right"], kinds)])

    def count(key: tuple, rows: pa.Table) -> pa.Table:
        parts = [unpack(data.as_py()) for data in rows.column("keys")]
        sizes = [len(part[0]) for part in parts]
        if single:
            lengths = np.concatenate([part[1] for part in parts]).astype(np.int64)
            offsets = np.concatenate(([0], np.cumsum(lengths)))
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.concatenate([p[2] for p in parts]))])
            found = words.dictionary_encode()
            number = found.indices.to_numpy()
        else:
            left, right = (np.concatenate([part[i] for part in parts]).astype(np.int64) for i in (1, 2))
            left = np.concatenate([np.cumsum(a) for a in np.split(left, np.cumsum(sizes)[:-1])])
            lefts, left_at = np.unique(left, return_inverse=True)
            rights, right_at = np.unique(right, return_inverse=True)
            pairs, number = np.unique(left_at * len(rights) + right_at, return_inverse=True)
        f = np.bincount(number, weights=np.concatenate([part[0] for part in parts])).astype(np.int64)
        often = np.flatnonzero(f >= least)
        ids = np.full(len(f), -1, dtype=np.int64)
        ids[often] = np.arange(len(often)) * buckets + key[1].as_py()
        if single:
            told = [found.dictionary.take(pa.array(often)).cast(pa.large_string()).cast(pa.string())]
        else:
            told = [pa.array(lefts[pairs[often] // len(rights)]), pa.array(rights[pairs[often] % len(rights)])]
        replies, to = [], []
        for block, base, own in zip(rows.column("block").to_pylist(), rows.column("base").to_pylist(), np.split(ids[number], np.cumsum(sizes)[:-1])):
            kept = np.flatnonzero(own >= 0)
            if len(kept):
                to.append(block)
                replies.append(pack((base + kept).astype(np.int32), _smallest(own[kept])))
        n, m = len(often), len(to)
        return pa.Table.from_arrays(
            [pa.array([key[0].as_py()] * (n + m), pa.string()), pa.array([None] * n + to, pa.int64()), pa.array([None] * n + replies, pa.binary()),
             pa.concat_arrays([pa.array(ids[often]), pa.nulls(m, pa.int64())]), pa.concat_arrays([pa.array(f[often]), pa.nulls(m, pa.int64())]),
             *(pa.concat_arrays([t, pa.nulls(m, t.type)]) for t in told)], schema=schema)

    dealt = relation.where("bucket is not null").select("lang", "bucket", "block", "base", "keys")
    return materialize(dealt.groupBy("lang", "bucket").applyInArrow(count, _FOUND + what), label)


def _extended(relation: DataFrame, frequent: DataFrame, buckets: int, label: str) -> DataFrame:
    """The next length's relation: frequent phrases at adjacent positions of a block."""
    def merge(key: tuple, block: pa.Table, places: pa.Table) -> pa.Table:
        empty = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("words", pa.int64()), ("codes", pa.binary()),
                           ("bucket", pa.int32()), ("base", pa.int32()), ("keys", pa.binary())]).empty_table()
        if not block.num_rows or not places.num_rows:
            return empty
        codes = unpack(block.column("codes")[0].as_py())[0]
        parts = [unpack(data.as_py()) for data in places.column("places")]
        code, ids = np.concatenate([part[0] for part in parts]), np.concatenate([part[1].astype(np.int64) for part in parts])
        # Places of the codes among the frequent ones; none for the others and, by its last value, for -1 between pieces.
        local = np.full(int(max(codes.max(), code.max())) + 2, -1, dtype=np.int64)
        local[code] = np.arange(len(code))
        at = local[codes]
        pair = (at[:-1] >= 0) & (at[1:] >= 0)
        found, numbers, counts = np.unique(at[:-1][pair] * len(code) + at[1:][pair], return_inverse=True, return_counts=True)
        if not len(found):
            return empty
        left, right = ids[found // len(code)], ids[found % len(code)]
        bucket = (_mixed(left.astype(np.uint64) * _MIX + right.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((right, left, bucket))
        renumbered = np.empty(len(order), dtype=np.int64)
        renumbered[order] = np.arange(len(order))
        out = np.full(len(codes) - 1, -1, dtype=np.int64)
        out[pair] = renumbered[numbers]
        left, right, counts, bucket = left[order], right[order], counts[order], bucket[order]
        dealt = list(_dealt(bucket))
        keys = [(a, b - a, pack(_smallest(counts[a:b]), _smallest(np.diff(left[a:b], prepend=0)), _smallest(right[a:b]))) for _, a, b in dealt]
        rows = _relation_rows(block.column("block")[0].as_py(), block.column("lang")[0].as_py(), out, np.array([d[0] for d in dealt], dtype=np.int64), keys)
        return pa.Table.from_batches([rows])

    blocks = relation.where("bucket is null").select("block", "lang", "codes").groupBy("block")
    replies = frequent.where("block is not null").select("block", "places").groupBy("block")
    return materialize(blocks.cogroup(replies).applyInArrow(merge, _RELATION), label)


def mine(docs: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST, absorbed_percent: int = ABSORBED_PERCENT,
         block_words: int = BLOCK_WORDS) -> DataFrame:
    """Phrases of 2 to `longest` words that occur `least` times or more: `lang`, `phrase`, `words`, `a`, `l`, `r`, `n`, `score`.

    Words are runs of anything but blanks and tabs within pieces, which end at any of . , ; : ! ? and line
    ends; only A-Z are lower-cased. All counts are per language, a null one being `und`. `n` counts words, `a` the
    phrase's occurrences, overlaps included. Cut after its first words a phrase has l and r, the occurrences of both parts,
    and the score 1000 a n div (l r); the cut of the lowest score counts, the earliest of equal ones. A phrase
    is left out if a phrase of one word more holds it and occurs at least `absorbed_percent` hundredths as often
    (a longer one that does is held by one of one word more that does, so no longer ones need a look).

    Null and empty texts hold no word. Repeated rows count as often as they come. An empty table gives no rows. Other
    columns are ignored.
    """
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, math.ceil(size / BUCKET_BYTES))
    relation = _occurrences(docs, block_words, buckets)
    totals = materialize(relation.groupBy("lang").agg(F.sum("words").alias("n")).where("n > 0"), "words")
    frequent = _frequent(relation, True, buckets, least, "frequent_1")
    f = F.array("f")
    known = frequent.where("id is not null").select("lang", "id", F.col("word").alias("last"), F.col("word").alias("phrase"), f.alias("firsts"), f.alias("rests"))
    found, absorbed = [], []
    words = totals.agg(F.sum("n")).first()[0] or 0
    for length in range(2, longest + 1):
        buckets = max(LEAST_BUCKETS, math.ceil(words / BUCKET_WORDS))
        relation = _extended(relation, frequent, buckets, f"occurrences_{length}")
        words = relation.agg(F.sum("words")).first()[0] or 0
        frequent = _frequent(relation, False, buckets, least, f"frequent_{length}")
        pairs = frequent.where("id is not null").select("lang", "id", "f", "left", "right")
        # `firsts` counts the first 1, 2, ... words of a phrase, `rests` its last 1, 2, ... words.
        left = known.select("lang", F.col("id").alias("left"), "firsts", F.col("phrase").alias("_phrase"))
        right = known.select("lang", F.col("id").alias("right"), "rests", "last")
        known = materialize(pairs.join(left, ["lang", "left"]).join(right, ["lang", "right"]).select(
            "lang", "id", "left", "right", "last", F.concat("_phrase", F.lit(" "), "last").alias("phrase"), "f",
            F.concat("firsts", f).alias("firsts"), F.concat("rests", f).alias("rests")), f"phrases_{length}")
        found.append(known.withColumn("words", F.lit(length)))
        shorter = F.lit(length - 1).alias("words")  # ids are those of one length
        absorbed.append(known.select("lang", F.col("left").alias("id"), shorter, "f", F.element_at("firsts", -2).alias("of")))
        absorbed.append(known.select("lang", F.col("right").alias("id"), shorter, "f", F.element_at("rests", -2).alias("of")))
    return _scored(found, absorbed, totals, longest, absorbed_percent)


def _scored(found: list[DataFrame], absorbed: list[DataFrame], totals: DataFrame, longest: int, percent: int) -> DataFrame:
    every, holding = found[0], absorbed[0]
    for more in found[1:]:
        every = every.unionByName(more)
    for more in absorbed[1:]:
        holding = holding.unionByName(more)
    gone = holding.where(100 * F.col("f") >= percent * F.col("of")).select("lang", "id", "words").distinct()
    wide = lambda c: c.cast("decimal(19,0)")  # noqa: E731  products may pass 64 bits
    top = wide(F.col("a")) * 1000 * wide(F.col("n"))

    def cut(at: Column) -> Column:
        first, rest = F.element_at("firsts", at), F.element_at("rests", F.col("words") - at)
        score = F.call_function("div", top, wide(first) * wide(rest))
        return F.struct(score.alias("score"), at.alias("at"), first.alias("l"), rest.alias("r"))

    scored = every.join(gone, ["lang", "id", "words"], "left_anti").join(totals, "lang").withColumnRenamed("f", "a")
    least = F.array_min(F.transform(F.sequence(F.lit(1), F.col("words") - 1), cut))
    return scored.withColumn("_least", least).select("lang", "phrase", "words", "a", "_least.l", "_least.r", "n", "_least.score")


def best(mined: DataFrame, most: int = 2000) -> DataFrame:
    """Each language's first `most` phrases by score and count, descending, then by the bytes of the phrase, with `rank` from 1."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return mined.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
