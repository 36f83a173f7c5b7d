"""Token-ID / binary output: length-delimited records with masked checksums and an offset index.

File format. A shard ``part-NNNNNN.rec`` is a sequence of records, each framed as

    uint64 length | uint32 masked CRC-32C of the length | payload | uint32 masked CRC-32C of the payload

all little-endian; the mask is ``((crc >> 15) | (crc << 17)) + 0xa282ead8`` (the usual framing of
record files). A payload is ``int64 doc_id, uint32 n_ids, uint16 width, uint16 flags`` and then the
ids, ``width`` bytes each; flag 1 means that doc_id is null. ``part-NNNNNN.idx`` beside it holds
``int64 doc_id, uint64 byte offset, uint64 ids before it in the shard, uint32 n_ids, uint32 flags``
per record, so that single records can be read in any order.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import doc_columns, materialize, new_folder, shuffle_partitions
from .tokens import encoder, id_width

# Fixed values of the record format.
CRC32C_POLY = 0x82F63B78  # reflected
MASK_DELTA = 0xA282EAD8
HEAD = struct.Struct("<qIHH")
INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("start", "<u8"), ("n_ids", "<u4"), ("flags", "<u4")])
NULL_ID = 1

#: Checksums run over blocks of so many bytes side by side.
BLOCK = 512


def _tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """CRC of each 16-bit value, and what BLOCK zero bytes make of each byte of a register."""
    one = np.arange(65536, dtype=np.uint32)
    for _ in range(16):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(CRC32C_POLY), one >> 1).astype(np.uint32)
    skip = []
    for k in range(4):
        reg = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(BLOCK // 2):
            reg = one[reg & 0xFFFF] ^ (reg >> np.uint32(16))
        skip.append(reg)
    return one, skip


_STEP, _SKIP = _tables()


def crc32c(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of many byte strings (each of 4 bytes or more), side by side."""
    if not parts:
        return np.zeros(0, dtype=np.uint32)
    size = np.array([len(p) for p in parts], dtype=np.int64)
    if size.min() < 4:
        raise ValueError("crc32c() takes parts of 4 bytes or more")
    blocks = -(-size // BLOCK)
    last = np.cumsum(blocks)
    data = np.zeros(int(last[-1]) * BLOCK, dtype=np.uint8)
    begin = last * BLOCK - size  # zero bytes in front leave an empty register as it is
    for p, at in zip(parts, begin):
        data[at:at + len(p)] = np.frombuffer(p, dtype=np.uint8)
    data[begin[:, None] + np.arange(4)] ^= 0xFF  # the register's start value, moved into the data
    cells = np.ascontiguousarray(data.view("<u2").reshape(-1, BLOCK // 2).T)
    reg = np.zeros(cells.shape[1], dtype=np.uint32)
    for row in cells:
        reg = _STEP[(reg ^ row) & 0xFFFF] ^ (reg >> np.uint32(16))
    out = np.zeros(len(parts), dtype=np.uint32)
    first = last - blocks
    order = np.argsort(-blocks, kind="stable")
    for k in range(int(blocks.max())):
        live = order[: int(np.searchsorted(-blocks[order], -k, side="left"))]  # parts with more than k blocks
        was = out[live]
        for j in range(4):
            if j == 0:
                moved = _SKIP[0][was & 0xFF]
            else:
                moved = moved ^ _SKIP[j][(was >> np.uint32(8 * j)) & 0xFF]
        out[live] = moved ^ reg[first[live] + k]
    return out ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)


def payload(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return HEAD.pack(doc_id or 0, len(ids) // width, width, NULL_ID if doc_id is None else 0) + ids


def parse_payload(data: bytes) -> tuple[int | None, bytes]:
    """(doc_id, ids as little-endian uint32)."""
    doc_id, n, width, flags = HEAD.unpack_from(data)
    ids = np.frombuffer(data, dtype=f"<u{width}", offset=HEAD.size, count=n).astype("<u4").tobytes()
    return None if flags & NULL_ID else doc_id, ids


def index_entries(doc_ids: list[int | None], counts: list[int], sizes: list[int], at: int, ids: int) -> bytes:
    """Index of records that begin ``at`` bytes and ``ids`` ids into their shard."""
    entry = np.zeros(len(doc_ids), dtype=INDEX)
    entry["doc_id"], entry["flags"] = [d or 0 for d in doc_ids], [NULL_ID if d is None else 0 for d in doc_ids]
    entry["n_ids"] = counts
    entry["offset"] = at + np.cumsum(sizes) - sizes
    entry["start"] = ids + np.cumsum(counts) - counts
    return entry.tobytes()


def read_index(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=INDEX)


def frames(payloads: list[bytes]) -> list[bytes]:
    """Each payload as a whole record."""
    sizes = [struct.pack("<Q", len(p)) for p in payloads]
    heads, tails = masked(crc32c(sizes)), masked(crc32c(payloads))
    return [s + struct.pack("<I", h) + p + struct.pack("<I", t)
            for s, h, p, t in zip(sizes, heads.tolist(), payloads, tails.tolist())]


def unframe(chunk: memoryview, offsets: list[int], path: str) -> list[bytes]:
    """The payloads at these offsets of ``chunk``; raises where a length or a checksum is wrong."""
    sizes, heads, payloads, tails = [], [], [], []
    for at in offsets:
        size = chunk[at:at + 8]
        n = int.from_bytes(size, "little")
        sizes.append(bytes(size))
        heads.append(int.from_bytes(chunk[at + 8:at + 12], "little"))
        payloads.append(bytes(chunk[at + 12:at + 12 + n]))
        tails.append(int.from_bytes(chunk[at + 12 + n:at + 16 + n], "little"))
        if len(payloads[-1]) != n:
            raise ValueError(f"{path}: a record is cut short")
    if masked(crc32c(sizes)).tolist() != heads or masked(crc32c(payloads)).tolist() != tails:
        raise ValueError(f"{path}: a checksum doesn't match")
    return payloads


def open_store(uri: str):
    """(file system, path) of a URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int | None = None,
                  id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> DataFrame:
    """Encode each text and write shards in ascending doc_id order; returns the manifest.

    Manifest: shard int, path string, n_records long, n_ids long, first_id long (ids in all earlier
    shards). Shard k holds smaller doc_ids than shard k+1. Null texts are empty texts; null doc_ids come
    first; rows of one doc_id stand together, in the order of their texts' hashes, and repeated rows are
    written as often as they come. A table without rows gives no shard. A task writes to a name of its own
    and moves the file when it is whole, so a repeated task leaves the same file.
    """
    spark = docs.sparkSession
    shards = shards or shuffle_partitions(spark)
    width = id_width(tokenizer_path)
    dtype = f"<u{width}"
    end = b"" if end_id is None else np.array([end_id], dtype=dtype).tobytes()
    # The last key deals out repeated rows; it never decides between different ones.
    keyed = (doc_columns(docs, id_col, text_col)
             .withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id()))
    dealt = (keyed.repartitionByRange(shards, "doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie", "row")
             .select("doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out, index = encoder(tokenizer_path, width), None, None
        shard = TaskContext.get().partitionId()
        at = ids = records = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store, root = open_store(folder)
                store.create_dir(root, recursive=True)
                name = f"{root}/part-{shard:06d}"
                own = f"{root}/_tmp-{shard:06d}-{uuid.uuid4().hex}"
                out, index = store.open_output_stream(f"{own}.rec"), store.open_output_stream(f"{own}.idx")
            ids_of, text_of = batch.column(0).to_pylist(), batch.column(1)
            for low in range(0, batch.num_rows, 1000):
                rows = ids_of[low:low + 1000]
                coded = [enc.encode(t.as_py()) + end for t in text_of[low:low + 1000]]
                counts = [len(c) // width for c in coded]
                done = frames([payload(d, c, width) for d, c in zip(rows, coded)])
                sizes = [len(x) for x in done]
                index.write(index_entries(rows, counts, sizes, at, ids))
                out.write(b"".join(done))
                at, ids, records = at + sum(sizes), ids + sum(counts), records + len(rows)
        if out is not None:
            out.close()
            index.close()
            store.move(f"{own}.rec", f"{name}.rec")
            store.move(f"{own}.idx", f"{name}.idx")
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "path": [f"part-{shard:06d}"], "n_records": [records], "n_ids": [ids]},
                schema=pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_records", pa.int64()), ("n_ids", pa.int64())]))

    made = materialize(dealt.mapInArrow(write, "shard int, path string, n_records long, n_ids long"), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    return made.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_records(spark: SparkSession, folder: str, manifest: DataFrame, batch_bytes: int = 8 << 20) -> DataFrame:
    """Read shards back: doc_id long, start long (ids of all records before it), n_ids long, ids binary
    (little-endian uint32). Reads by the index, checks every length and checksum, holds ``batch_bytes``."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, root = open_store(folder)
                path = f"{root}/{name}"
                with store.open_input_stream(f"{path}.idx") as f:
                    index = read_index(f.read())
                size = store.get_file_info(f"{path}.rec").size
                ends = np.append(index["offset"][1:], np.uint64(size))
                with store.open_input_file(f"{path}.rec") as f:
                    low = 0
                    while low < len(index):
                        base = int(index["offset"][low])
                        high = max(low + 1, int(np.searchsorted(ends, np.uint64(base + batch_bytes), side="right")))
                        chunk = memoryview(f.read_at(int(ends[high - 1]) - base, base))
                        part = index[low:high]
                        payloads = unframe(chunk, (part["offset"] - np.uint64(base)).tolist(), path)
                        found, ids = zip(*map(parse_payload, payloads))
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": found, "start": (part["start"].astype(np.int64) + first).tolist(),
                            "n_ids": part["n_ids"].astype(np.int64).tolist(), "ids": ids}, schema=schema)
                        low = high

    spread = manifest.select("path", "first_id").repartition(shuffle_partitions(spark), "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_ids long, ids binary")


def token_records(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None, **columns) -> DataFrame:
    """Write the records of ``docs`` below the shared folder (or ``folder``) and read them back."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "records")
    return read_records(spark, folder, write_records(docs, folder, tokenizer_path, end_id, **columns))
