"""Token-id files in bit planes.

A file holds the ids of whole documents in order. Ids are cut into blocks of BLOCK, a block's ids are transposed
into 32 bit planes (planes that are zero throughout are left out by the width), each plane is compressed with
zstandard, and the footer holds the chunk index: for each block the width and the size of each plane's frame, for each
document its id, first id and number of ids. Any block can be read alone.

Layout, little-endian: magic, planes of block 0, planes of block 1, ..., index (zstandard frame of JSON-free arrays),
its size as 8 bytes, magic.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdoc.llm.bytebpe import encoder
from loomdoc.llm.common import shared_dir, slices

MAGIC = b"BPLN\x01\x00\x00\x00"
#: Ids in a block; a multiple of 8.
BLOCK = 1 << 16
#: Ids after which a file ends with the document at hand.
FILE_IDS = 1 << 20
#: Characters of a run of texts and units that a worker remembers: more than where other stages need the memory.
RUN, UNITS = 8_000_000, 700_000


def planes(ids: np.ndarray) -> list[bytes]:
    """The bit planes of a block, lowest bit first, as many as its largest id needs; each padded to whole bytes."""
    width = int(ids.max()).bit_length() if len(ids) else 0
    octets = np.ascontiguousarray(np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4).T)
    return [np.packbits(octets[b // 8] & np.uint8(1 << b % 8), bitorder="little").tobytes() for b in range(width)]


def from_planes(parts: list[bytes], n: int) -> np.ndarray:
    out = np.zeros(n, "<u4")
    for b, data in enumerate(parts):
        out |= np.unpackbits(np.frombuffer(data, np.uint8), count=n, bitorder="little").astype("<u4") << np.uint32(b)
    return out


def write_file(doc_ids: np.ndarray, valid: np.ndarray, sizes: np.ndarray, ids: np.ndarray, level: int = 1) -> bytes:
    """A file of documents; doc_ids where valid, sizes: ids of each, ids: those of all in order."""
    pack = zstandard.ZstdCompressor(level=level).compress
    body, frames, widths = [], [], []
    for at in range(0, len(ids), BLOCK):
        parts = [pack(p) for p in planes(ids[at : at + BLOCK])]
        widths.append(len(parts))
        frames += map(len, parts)
        body += parts
    index = struct.pack("<QQQQ", len(ids), len(sizes), len(widths), BLOCK)
    index += b"".join(np.asarray(x, t).tobytes() for x, t in ((doc_ids, "<i8"), (valid, "u1"), (sizes, "<u8"), (widths, "<u4"), (frames, "<u4")))
    index = zstandard.ZstdCompressor(level=3).compress(index)
    return b"".join([MAGIC, *body, index, struct.pack("<Q", len(index)), MAGIC])


class File:
    """A file's chunk index, and its ids by block."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC or data[-8:] != MAGIC:
            raise ValueError("not a bit-plane file")
        self.data = memoryview(data)
        size = struct.unpack("<Q", data[-16:-8])[0]
        raw = zstandard.ZstdDecompressor().decompress(data[len(data) - 16 - size : -16])
        self.n_ids, docs, blocks, self.block = struct.unpack_from("<QQQQ", raw)
        at = 32

        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        self.doc_ids, self.valid, self.sizes, self.widths = take(docs, "<i8"), take(docs, "u1").astype(bool), take(docs, "<u8").astype(np.int64), take(blocks, "<u4").astype(np.int64)
        self.frames = take(int(self.widths.sum()), "<u4").astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.widths)])
        self.offsets = 8 + np.concatenate([[0], np.cumsum(self.frames)])

    def read_block(self, k: int) -> np.ndarray:
        n = min(self.block, self.n_ids - k * self.block)
        unpack = zstandard.ZstdDecompressor().decompress
        return from_planes([unpack(self.data[self.offsets[i] : self.offsets[i + 1]]) for i in range(self.first[k], self.first[k + 1])], n)

    def read(self, start: int, stop: int) -> np.ndarray:
        """ids start to stop, as far as there are any; touches their blocks only."""
        stop = min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, "<u4")
        blocks = range(start // self.block, (stop - 1) // self.block + 1)
        ids = np.concatenate([self.read_block(k) for k in blocks])
        return ids[start - blocks[0] * self.block : stop - blocks[0] * self.block]


def write_ids(docs: DataFrame, path: str, end_id: int = 2, parts: int | None = None, out: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write files of the ids of every text, each with end_id after it, in ascending document order; returns their folder.

    The folder, out or one of its own in the shared folder, holds Parquet rows part and seq (their order is the
    documents'), before (the ids of the part before the file), n_ids, and file, the bytes that File opens, one file a
    row: Python on executors reaches no general store, and Spark's commit leaves nothing half-written when an executor
    is lost. The folder stays until someone deletes it; an existing one is an error. path: the tokenizer's.

    Texts are dealt out by ranges of the id and a hash of the text, so neither one id nor null ids fill a task. Null
    texts are empty, null ids come first, and rows of one id are in the order of that hash, then of their texts. A very
    long text is a row like others and its file as much longer. Other columns are left out; an empty table leaves a
    folder without rows.
    """
    spark = docs.sparkSession
    out = out or f"{shared_dir(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"coalesce(cast(`{text_col}` as string), '') as text").withColumn("h", F.xxhash64("text"))
    dealt = rows.repartitionByRange(n, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    schema = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("before", pa.int64()), ("n_ids", pa.int64()), ("file", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, before, held = TaskContext.get().partitionId(), 0, 0, 0
        keep: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        code = encoder(path, RUN, UNITS)

        def file() -> pa.RecordBatch:
            nonlocal seq, before, held, keep
            cols = [np.concatenate(x) for x in zip(*keep, strict=True)]
            numbers = [pa.array([x], pa.int64()) for x in (part, seq, before, len(cols[3]))]
            out = pa.RecordBatch.from_arrays([*numbers, pa.array([write_file(*cols)], pa.binary())], schema=schema)
            seq, before, held, keep = seq + 1, before + len(cols[3]), 0, []
            return out

        for b in slices(batches):
            keys = b.column(0)
            valid = np.asarray(keys.is_valid().to_numpy(zero_copy_only=False), np.uint8)
            keys = keys.fill_null(0).to_numpy()
            for at, ids, sizes in code(b.column(1).to_pylist()):
                m = len(sizes)
                last = np.cumsum(sizes + 1) - 1
                inner = np.ones(len(ids) + m, bool)
                inner[last] = False
                ends = np.full(len(inner), end_id, "<u4")
                ends[inner] = ids
                keep.append((keys[at : at + m], valid[at : at + m], sizes + 1, ends))
                held += len(ends)
                if held >= FILE_IDS:
                    yield file()
        if keep:
            yield file()

    dealt.mapInArrow(run, "part long, seq long, before long, n_ids long, file binary").write.parquet(out)
    return out


def read_ids(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """What the files of a folder hold, a row for each document: doc_id, start, n_tokens, ids_crc32, on demand the packed ids.

    start counts the ids of all documents before it: those of earlier parts (a sum for each of the parts that write_ids
    was given, 16 bytes, goes to the driver and back), of earlier files of the part, and of the file itself.
    """
    files = spark.read.parquet(folder)
    by_part = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    bases, at = {}, 0
    for part, n in sorted((r.part, r.n) for r in by_part.collect()):
        bases[part] = at
        at += n
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    ddl = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if with_ids:
        fields.append(("ids", pa.binary()))
        ddl += ", ids binary"
    schema = pa.schema(fields)
    shared = spark.sparkContext.broadcast(bases)  # 16 bytes for each part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, before, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                f = File(data.as_py())
                ends = np.cumsum(f.sizes)
                packed = f.read(0, f.n_ids).tobytes()
                each = [packed[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), f.sizes.tolist(), strict=True)]
                cols = [pa.array(f.doc_ids, mask=~f.valid), pa.array(ends - f.sizes + shared.value[part] + before), pa.array(f.sizes), pa.array([zlib.crc32(x) for x in each], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array(each, pa.binary())] if with_ids else []), schema=schema)

    return files.select("part", "before", "file").mapInArrow(run, ddl)
