"""Token ids as length-delimited binary records with a separate offset index.

File format, all numbers little-endian. A record is: length of the payload (8 bytes), masked CRC-32C of
those 8 bytes (4), payload, masked CRC-32C of the payload (4). The payload is a document's ids as unsigned
16-bit integers where the vocabulary allows it, else 32-bit; the index says which. The mask rotates the checksum
right by 15 bits and adds 0xA282EAD8.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from stratamart.llm.common import id_of, key_of, small_batches
from stratamart.llm.tokens import Encoding, encoded
from stratamart.staging import materialize, shared_folder

# The reflected CRC-32C polynomial and the mask of the record format.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8

_BLOCK = 256
_ROWS = 256 * np.arange(_BLOCK, dtype=np.int64)  # where the table of each place in a block starts
_READ_BYTES = 1 << 23


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, list[list[int]]]:
    """Per place in a block, what a byte of each value there adds to the block's checksum; and the first four places as lists."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(POLYNOMIAL), step >> 1).astype(np.uint32)
    places = np.empty((_BLOCK, 256), dtype=np.uint32)
    places[-1] = step
    for i in range(_BLOCK - 2, -1, -1):
        places[i] = (places[i + 1] >> 8) ^ step[places[i + 1] & 0xFF]
    return places, places[:4].tolist()


def _short(data: bytes) -> int:
    """CRC-32C of less than four bytes, too few to add the start value to."""
    places, _ = _tables()
    crc = 0xFFFFFFFF
    for byte in data:
        crc = (crc >> 8) ^ int(places[-1][(crc ^ byte) & 0xFF])
    return crc ^ 0xFFFFFFFF


def checksums(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32C of each of many strings of so many bytes, which lie end to end.

    The checksum of a block is the exclusive or of what each byte adds, looked up for all bytes at once; the
    checksum so far acts as if it were added to the next block's first four bytes. Zeros in front add nothing.
    """
    places, (first, second, third, fourth) = _tables()
    flat, out = places.reshape(-1), np.zeros(len(sizes), dtype=np.int64)
    ends = np.cumsum(sizes)
    starts, counts = ends - sizes, -(-sizes // _BLOCK)
    for i in np.flatnonzero(sizes < 4).tolist():
        out[i] = _short(data[starts[i]:ends[i]].tobytes())
    counts[sizes < 4] = 0
    last = np.cumsum(counts)
    blocks = np.zeros((int(counts.sum()), _BLOCK), dtype=np.uint8)
    padded = blocks.reshape(-1)
    for start, end, size, stop in zip(starts.tolist(), ends.tolist(), sizes.tolist(), (last * _BLOCK).tolist()):
        if size >= 4:
            padded[stop - size:stop] = data[start:end]
    long = sizes >= 4
    padded[((last * _BLOCK - sizes)[long][:, None] + np.arange(4)).reshape(-1)] ^= 0xFF
    adds: list[int] = []
    for at in range(0, len(blocks), 1 << 9):
        adds += np.bitwise_xor.reduce(flat.take(blocks[at:at + (1 << 9)] + _ROWS), axis=1).tolist()
    for i, (stop, count) in enumerate(zip(last.tolist(), counts.tolist())):
        if count:
            crc = 0
            for add in adds[stop - count:stop]:
                crc = first[crc & 255] ^ second[crc >> 8 & 255] ^ third[crc >> 16 & 255] ^ fourth[crc >> 24] ^ add
            out[i] = crc ^ 0xFFFFFFFF
    return out


def crc32c(data: bytes) -> int:
    return int(checksums(np.frombuffer(data, dtype=np.uint8), np.array([len(data)], dtype=np.int64))[0])


def masked(crc):
    """Of one checksum or an array of them."""
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frames(data: np.ndarray, sizes: np.ndarray) -> bytes:
    """The records, end to end, of payloads of so many bytes that lie end to end."""
    lengths = sizes.astype("<i8").view(np.uint8).reshape(-1, 8)
    eights = np.full(len(sizes), 8, dtype=np.int64)
    heads = np.hstack((lengths, masked(checksums(lengths.reshape(-1), eights)).astype("<u4").view(np.uint8).reshape(-1, 4))).tobytes()
    tails = masked(checksums(data, sizes)).astype("<u4").tobytes()
    whole, parts, at = data.tobytes(), [], 0
    for i, size in enumerate(sizes.tolist()):
        parts += (heads[12 * i:12 * i + 12], whole[at:at + size], tails[4 * i:4 * i + 4])
        at += size
    return b"".join(parts)


def unframes(data: bytes, sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The payloads, end to end, of records of so many bytes that lie end to end, and the bytes of each; raises if a
    checksum or a length does not hold."""
    flat, inner = np.frombuffer(data, dtype=np.uint8), sizes - 16
    starts = np.cumsum(sizes) - sizes
    if len(flat) != sizes.sum() or (inner < 0).any():
        raise ValueError("broken length of a record")
    heads = flat[starts[:, None] + np.arange(12)]
    lengths = np.ascontiguousarray(heads[:, :8])
    sums = np.ascontiguousarray(heads[:, 8:]).view("<u4").reshape(-1)
    if (masked(checksums(lengths.reshape(-1), np.full(len(sizes), 8, dtype=np.int64))) != sums).any() or (lengths.view("<u8").reshape(-1) != inner).any():
        raise ValueError("broken length of a record")
    whole = b"".join([data[a:b] for a, b in zip((starts + 12).tolist(), (starts + 12 + inner).tolist())])
    sums = np.ascontiguousarray(flat[(starts + 12 + inner)[:, None] + np.arange(4)]).view("<u4").reshape(-1)
    if (masked(checksums(np.frombuffer(whole, dtype=np.uint8), inner)) != sums).any():
        raise ValueError("broken payload of a record")
    return whole, inner


def frame(payload: bytes) -> bytes:
    return frames(np.frombuffer(payload, dtype=np.uint8), np.array([len(payload)], dtype=np.int64))


def unframe(record: bytes) -> bytes:
    """The payload of one record; raises if a checksum or the length does not hold."""
    return unframes(record, np.array([len(record)], dtype=np.int64))[0]


def write(docs: DataFrame, encoding: Encoding, folder: str | None = None) -> DataFrame:
    """Encode every text and write the ids in ascending doc_id order; returns the stored offset index:
    `doc_id`, `file`, `offset`, `bytes` of the record, `id_bytes`, `start` (ids of all documents before it), `n_tokens`.

    Each task writes one file per range of ids under a name of its own and hands on its index rows. Only
    files that the index names belong to the result, so a repeated or lost task leaves no trace in it. The
    folder must be one that all executors reach (default: in the shared folder) and pyarrow can write to.

    A null text is empty: the end id alone. A null doc_id comes last, as null. Rows that repeat a doc_id
    are written one after another. An empty table gives an empty index. Other columns are ignored.
    """
    spark = docs.sparkSession
    kind = f"<u{encoding.id_bytes}"
    target = folder or f"{shared_folder(spark)}/records-{uuid.uuid4().hex}"

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = fs.FileSystem.from_uri(target)
        filesystem.create_dir(base, recursive=True)
        name, out, offset, start = f"{uuid.uuid4().hex}.records", None, 0, 0
        for ids, blobs in encoded(batches, encoding):
            if out is None:
                out = filesystem.open_output_stream(f"{base}/{name}")
            counts = np.fromiter(map(len, blobs), dtype=np.int64, count=len(blobs)) // 4
            payloads = np.frombuffer(b"".join(blobs), dtype="<u4").astype(kind).view(np.uint8)
            out.write(frames(payloads, encoding.id_bytes * counts))
            sizes = encoding.id_bytes * counts + 16
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([name] * len(ids)), pa.array(offset + np.cumsum(sizes) - sizes, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(start + np.cumsum(counts) - counts, pa.int64()), pa.array(counts, pa.int64())],
                ["_doc", "file", "offset", "bytes", "_before", "n_tokens"])
            offset, start = offset + int(sizes.sum()), start + int(counts.sum())
        if out is not None:
            out.close()

    rows = docs.select(key_of("doc_id").alias("_doc"), F.col("text").cast("string").alias("text"))
    ranged = (rows.withColumn("_turn", F.xxhash64("text")).repartitionByRange("_doc", "_turn")
              .sortWithinPartitions("_doc", "_turn").select("_doc", "text"))
    with small_batches(spark):
        local = materialize(ranged.mapInArrow(
            save, "_doc long, file string, offset long, bytes long, _before long, n_tokens long"), "record_index")
    # One row per file: the files lie in the order of their first ids (no id is in two files unless repeated).
    files = local.groupBy("file").agg(F.sum("n_tokens").alias("_all"), F.min("_doc").alias("_first"), F.max("_doc").alias("_last"))
    earlier = Window.orderBy("_first", "_last", "file").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("file", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_base"))
    return local.join(bases, "file").select(
        id_of("_doc").alias("doc_id"), F.concat(F.lit(f"{target}/"), "file").alias("file"), "offset", "bytes",
        F.lit(encoding.id_bytes).alias("id_bytes"), (F.col("_base") + F.col("_before")).alias("start"), "n_tokens")


def read(index: DataFrame) -> DataFrame:
    """The index's rows with `ids` (binary, little-endian unsigned 32-bit), read from the record files.

    Rows may come in any order and number (a shuffled or partial read); each record is fetched by its
    offset and its checksums are verified.
    """
    kept = index.columns

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_files: dict[str, pa.NativeFile] = {}
        for batch in batches:
            rows = batch.to_pydict()
            order = sorted(range(batch.num_rows), key=lambda i: (rows["file"][i], rows["offset"][i]))
            at = 0
            while at < len(order):
                name, offset, width = rows["file"][order[at]], rows["offset"][order[at]], rows["id_bytes"][order[at]]
                stop, size = at, 0  # records that follow one another in a file are read at once
                while (stop < len(order) and (size < _READ_BYTES or stop == at) and rows["file"][order[stop]] == name
                       and rows["offset"][order[stop]] == offset + size and rows["id_bytes"][order[stop]] == width):
                    size += rows["bytes"][order[stop]]
                    stop += 1
                some = order[at:stop]
                if name not in open_files:
                    if len(open_files) >= 16:
                        open_files.pop(next(iter(open_files))).close()
                    filesystem, path = fs.FileSystem.from_uri(name)
                    open_files[name] = filesystem.open_input_file(path)
                open_files[name].seek(offset)
                payloads, sizes = unframes(open_files[name].read(size), np.array([rows["bytes"][i] for i in some], dtype=np.int64))
                whole = np.frombuffer(payloads, dtype=f"<u{width}").astype("<u4").tobytes()
                ends = np.cumsum(sizes // width * 4)
                blobs = [whole[a:b] for a, b in zip((ends - sizes // width * 4).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(some)).columns, pa.array(blobs, pa.binary())],
                                                 [*kept, "ids"])
                at = stop
        for opened in open_files.values():
            opened.close()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in index.schema.fields)
    return index.mapInArrow(load, f"{schema}, ids binary")
