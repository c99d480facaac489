"""Removal of passages that occur earlier, by fixed-block anchors.

Words are hashed. Every document's non-overlapping blocks of BLOCK words are the reference blocks; any window of
WINDOW >= 2 * BLOCK - 1 words contains one whole. Each rolling window of BLOCK words probes them: a window that
repeats has, wherever it starts, a probe that hits a block which occurs more than once (anchors). Around hits, windows
of WINDOW words are compared by 128 bits, two independent sums of two independent hashes of each word: of each distinct
window the earliest start is found, and runs of the others are the maximal repeats, whose words are removed. Words
themselves are not compared: among 10^13 windows two different ones agree in 128 bits with a chance of 2 in 10^13.

What is shuffled are sorted hashes, difference-coded and compressed, a row for each pair of chunk and hash range, and
one bit for each hash in answer; a chunk (a few MB of documents with all their columns, as a compressed Arrow stream in
the shared folder) meets its answers by its number. A passage that thousands of documents share is one hash a chunk, so
no document meets another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomdoc.llm.bytebpe import spread
from loomdoc.llm.common import blocks_for, cut, shuffle_partitions, trim

BLOCK = 10
CHUNK_BYTES = 4_000_000
#: Chunks' worth of hashes that a range of them holds: some 3 million, 24 MB.
CHUNKS_A_RANGE = 4
#: Hashes of a range that are sorted at once.
STEP = 1 << 19
#: Bits of a probe's hash; what agrees in them by chance only becomes a candidate.
PROBE_BITS = 48
#: Bits of a window's first hash that are used; fewer in tests, where the second one has to tell windows apart.
WINDOW_BITS = 64

_rng = np.random.default_rng(20_111)
#: Odd multipliers, one for each place of a word in a window, for the first hash and for the second.
_MULT, _MULT2 = _rng.integers(0, 1 << 63, (2, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(texts: Iterable[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every word of every text, in one array each."""
    both = np.frombuffer(b"".join([b"".join(map(xxhash.xxh3_128_digest, t)) for t in texts]), "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def rolling(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of size words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out += words[j : j + n] * _MULT[j]
    return _mix(out)


class Chunk:
    """The documents of a chunk as one array of word hashes; words and texts are left out where they are not needed."""

    def __init__(self, data: bytes, text: str, words: bool = True):
        self.batch = pa.ipc.open_stream(data).read_all().combine_chunks()
        self.texts = self.batch.column(text).to_pylist()
        self.words: list[list[bytes]] | None = []
        sizes = []

        def split() -> Iterator[list[bytes]]:
            for t in self.texts:
                w = t.encode().split() if t else []  # bytes: ASCII white space only
                sizes.append(len(w))
                if words:
                    self.words.append(w)
                yield w

        self.hashes, self.seconds = word_hashes(split())
        self.sizes = np.array(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        if not words:
            self.words = self.texts = None

    def windows(self, size: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, hashes and documents of the windows of size words in documents of at least least words."""
        ok = (self.sizes >= max(size, least)).nonzero()[0]
        n = self.sizes[ok] - size + 1
        starts = spread((self.ends - self.sizes)[ok], n)
        return starts, rolling(self.hashes, size)[starts] if len(starts) else np.zeros(0, np.uint64), np.repeat(ok, n)


def _pack(sorted_hashes: np.ndarray) -> bytes:
    """Differences as byte planes: the high planes are nearly constant and all but vanish."""
    d = np.diff(sorted_hashes, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(d.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def _bits(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.packbits(x).tobytes())


def _from_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8), count=n).astype(bool)


def _ranges(sorted_hashes: np.ndarray, buckets: int, bits: int) -> list[tuple[int, int, int]]:
    """Bucket, first and end of the hashes in each of buckets equal ranges."""
    if not len(sorted_hashes):
        return []
    k = ((sorted_hashes >> np.uint64(bits - 32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    at = [0, *(np.flatnonzero(np.diff(k)) + 1).tolist(), len(k)]
    return [(int(k[a]), a, b) for a, b in zip(at, at[1:])]


def _steps(parts: list[np.ndarray]) -> Iterator[list[slice]]:
    """Parts, each sorted, cut at the same hashes, so that about STEP of them all come at a time; equal hashes come together."""
    n = sum(map(len, parts))
    if not n:
        return
    low, high = min(int(p[0]) for p in parts if len(p)), max(int(p[-1]) for p in parts if len(p))
    steps = -(-n // STEP)
    edges = np.array([low + (high - low) * i // steps for i in range(1, steps)], np.uint64)
    at = [[0, *np.searchsorted(p, edges).tolist(), len(p)] for p in parts]
    for i in range(steps):
        yield [slice(a[i], a[i + 1]) for a in at]


def _probes(c: Chunk, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct probe hashes, each probe's place among them, the probes' starts, and whether each is a block."""
    starts, h, doc = c.windows(BLOCK, window)
    h = h >> np.uint64(64 - PROBE_BITS)
    u, inverse = np.unique(h, return_inverse=True)
    return u, inverse, starts, (starts - (c.ends - c.sizes)[doc]) % BLOCK == 0


def _candidates(c: Chunk, window: int, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, first hashes, second ones and documents of the windows around a hit; hit: for each word, whether a hit starts there."""
    starts, h, doc = c.windows(window, window)
    if len(starts):
        total = np.concatenate([[0], np.cumsum(hit)])
        near = total[starts + window - BLOCK + 1] > total[starts]
        starts, h, doc = starts[near], h[near], doc[near]
    second = np.zeros(len(starts), np.uint64)
    for j in range(window):
        second += c.seconds[starts + j] * _MULT2[j]
    return starts, h >> np.uint64(64 - WINDOW_BITS) << np.uint64(64 - WINDOW_BITS), _mix(second), doc


def _hits(c: Chunk, window: int, answers: dict[int, bytes], buckets: int) -> np.ndarray:
    u, inverse, starts, _ = _probes(c, window)
    found = np.zeros(len(u), bool)
    for k, a, b in _ranges(u, buckets, PROBE_BITS):
        if k in answers:
            found[a:b] = _from_bits(answers[k], b - a)
    hit = np.zeros(len(c.hashes), bool)
    hit[starts] = found[inverse]
    return hit


def chunks(docs: DataFrame, text_col: str) -> DataFrame:
    """Rows chunk, data, in the shared folder: all columns of a run of documents, whose texts come to CHUNK_BYTES or a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for b in batches:
            sizes = [len(t) if t else 0 for t in b.column(text_col).to_pylist()]
            at = 0
            while at < b.num_rows:
                end, n = at, 0
                while end < b.num_rows and (end == at or n + sizes[end] <= CHUNK_BYTES):
                    n += sizes[end]
                    end += 1
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, b.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_batch(b.slice(at, end - at))
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int64()), "data": pa.array([out.getvalue().to_pybytes()], pa.binary())})
                chunk, at = chunk + 1, end

    return cut(docs.mapInArrow(run, "chunk long, data binary"))


def repeated(docs: DataFrame, finish, ddl: str, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """finish(chunk, gone) for every chunk; gone: for each of its words, whether a repeat covers it.

    A window repeats if its words also start earlier: in a document of smaller id, or earlier in the same one. Rows
    with one id are taken in the order of their chunks and places, rows without an id as before all others. Null
    texts have no words.
    """
    if window < 2 * BLOCK - 1:
        raise ValueError("a window must contain a whole block wherever it starts")
    stored = chunks(docs, text_col)
    n_chunks = stored.count()
    buckets = max(shuffle_partitions(docs.sparkSession), blocks_for(n_chunks, CHUNKS_A_RANGE))

    def send_probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                c = Chunk(data.as_buffer(), text_col, words=False)
                u, inverse, _, block = _probes(c, window)
                many = np.bincount(inverse, minlength=len(u)) > 1
                blocks = np.bincount(inverse, weights=block, minlength=len(u)) > 0
                rows = [(k, chunk, _pack(u[x:y]), _bits(many[x:y]), _bits(blocks[x:y])) for k, x, y in _ranges(u, buckets, PROBE_BITS)]
                trim()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "chunk", "hashes", "many", "blocks"])

    def answer_probes(t: pa.Table) -> pa.Table:
        parts = [_unpack(x.as_py()) for x in t.column("hashes")]
        flags = [[_from_bits(x.as_py(), len(p)) for x, p in zip(t.column(name), parts, strict=True)] for name in ("many", "blocks")]
        found = [np.zeros(len(p), bool) for p in parts]
        for cuts in _steps(parts):
            many, blocks = (np.concatenate([f[at] for f, at in zip(flag, cuts, strict=True)]) for flag in flags)
            u, inverse, count = np.unique(np.concatenate([p[at] for p, at in zip(parts, cuts, strict=True)]), return_inverse=True, return_counts=True)
            often, block = count > 1, np.zeros(len(u), bool)
            often[inverse[many]] = True
            block[inverse[blocks]] = True
            answer, done = (often & block)[inverse], 0
            for f, at in zip(found, cuts, strict=True):
                f[at] = answer[done : done + at.stop - at.start]
                done += at.stop - at.start
        each = [_bits(x) if x.any() else None for x in found]
        del parts, flags, found
        trim()
        return pa.table({"chunk": t.column("chunk"), "bucket": t.column("bucket"), "answer": pa.array(each, pa.binary())})

    def given(t: pa.Table) -> dict[int, bytes]:
        return {k: x for k, x in zip(t.column("bucket").to_pylist(), t.column("answer").to_pylist(), strict=True) if x is not None}

    found = cut(stored.mapInArrow(send_probes, "bucket int, chunk long, hashes binary, many binary, blocks binary").groupBy("bucket").applyInArrow(answer_probes, "chunk long, bucket int, answer binary").filter("answer is not null"))
    empty_window = pa.table({"bucket": pa.array([], pa.int32()), "chunk": pa.array([], pa.int64()), "hashes": pa.array([], pa.binary()), "seconds": pa.array([], pa.binary()), "docs": pa.array([], pa.binary())})

    def send_windows(t: pa.Table, hits: pa.Table) -> pa.Table:
        rows = []
        if hits.num_rows:
            for chunk, data in zip(t.column("chunk").to_pylist(), t.column("data"), strict=True):
                c = Chunk(data.as_buffer(), text_col, words=False)
                u, second, first, _ = _firsts(c, *_candidates(c, window, _hits(c, window, given(hits), buckets)), id_col)
                for k, x, y in _ranges(u, buckets, 64):
                    rows.append((k, chunk, _pack(u[x:y]), second[x:y].astype("<u8").tobytes(), zstandard.ZstdCompressor(level=1).compress(first[x:y].astype("<i8").tobytes())))
        trim()
        if not rows:
            return empty_window
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), empty_window.schema, strict=True)], schema=empty_window.schema)

    def answer_windows(t: pa.Table) -> pa.Table:
        """A bit for each hash: whether its earliest start is in this chunk."""
        parts = [_unpack(x.as_py()) for x in t.column("hashes")]
        seconds = [np.frombuffer(x.as_py(), "<u8") for x in t.column("seconds")]
        docs = [np.frombuffer(zstandard.ZstdDecompressor().decompress(x.as_py()), "<i8") for x in t.column("docs")]
        chunk = np.array(t.column("chunk").to_pylist())
        first = [np.zeros(len(p), bool) for p in parts]
        for cuts in _steps(parts):
            h, second, doc = (np.concatenate([p[at] for p, at in zip(x, cuts, strict=True)]) for x in (parts, seconds, docs))
            sizes = [at.stop - at.start for at in cuts]
            order = np.lexsort((np.repeat(chunk, sizes), doc, second, h))
            answer, done = np.zeros(len(h), bool), 0
            answer[order[_changes(h[order], second[order])]] = True
            for f, at, n in zip(first, cuts, sizes, strict=True):
                f[at] = answer[done : done + n]
                done += n
        each = [_bits(x) for x in first]
        del parts, seconds, docs, first
        trim()
        return pa.table({"chunk": t.column("chunk"), "bucket": t.column("bucket"), "answer": pa.array(each, pa.binary())})

    meet = lambda other: stored.groupBy("chunk").cogroup(other.groupBy("chunk"))
    firsts = meet(found).applyInArrow(send_windows, "bucket int, chunk long, hashes binary, seconds binary, docs binary").groupBy("bucket").applyInArrow(answer_windows, "chunk long, bucket int, answer binary")
    answers = cut(found.select("chunk", "bucket", "answer", F.lit(0).alias("kind")).union(firsts.select("chunk", "bucket", "answer", F.lit(1).alias("kind"))))

    def last(t: pa.Table, got: pa.Table) -> pa.Table:
        kind = np.array(got.column("kind").to_pylist())
        out = []
        for data in t.column("data"):
            c = Chunk(data.as_buffer(), text_col)
            gone = np.zeros(len(c.hashes), bool)
            if got.num_rows:
                hits = given(got.filter(pa.array(kind == 0)))
                starts, h, second, doc = _candidates(c, window, _hits(c, window, hits, buckets))
                u, _, _, place = _firsts(c, starts, h, second, doc, id_col)
                own = np.zeros(len(u), bool)
                firsts_here = given(got.filter(pa.array(kind == 1)))
                for k, x, y in _ranges(u, buckets, 64):
                    own[x:y] = _from_bits(firsts_here[k], y - x)
                again = np.ones(len(starts), bool)
                again[place[own]] = False
                step = np.bincount(starts[again], minlength=len(gone) + 1) - np.bincount(starts[again] + window, minlength=len(gone) + 1)
                gone = np.cumsum(step)[: len(gone)] > 0
            out.append(finish(c, gone))
        trim()
        return pa.concat_tables(out)

    return meet(answers).applyInArrow(last, ddl)


def _changes(h: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Where a pair of hashes, in order, is not the one before it."""
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (second[1:] != second[:-1])
    return new


def _firsts(c: Chunk, starts: np.ndarray, h: np.ndarray, second: np.ndarray, doc: np.ndarray, id_col: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of hashes, the id of the document where each starts first in the chunk, and the place of that window."""
    ids = c.batch.column(id_col).cast(pa.int64()).fill_null(-(1 << 63)).to_numpy()
    of = ids[doc] if len(doc) else np.zeros(0, np.int64)
    order = np.lexsort((starts, of, second, h))
    order = order[_changes(h[order], second[order])]
    return h[order], second[order], of[order], order


def _kept(c: Chunk, gone: np.ndarray) -> Iterator[tuple[list[bytes], int]]:
    """The kept words of each document and the number removed."""
    for words, end, n in zip(c.words, c.ends.tolist(), c.sizes.tolist(), strict=True):
        away = gone[end - n : end]
        k = int(away.sum())
        yield ([w for w, g in zip(words, away.tolist(), strict=True) if not g] if k else words), k


def removed_words(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words, joined by single spaces) of every row."""

    def finish(c: Chunk, gone: np.ndarray) -> pa.Table:
        kept = list(_kept(c, gone))
        return pa.table({"doc_id": c.batch.column(id_col).cast(pa.int64()), "n_words": pa.array(c.sizes), "n_removed": pa.array([k for _, k in kept], pa.int64()), "kept_sha256": pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w, _ in kept], pa.string())})

    rows = docs.selectExpr(f"cast(`{id_col}` as long) as `{id_col}`", f"cast(`{text_col}` as string) as `{text_col}`")
    return repeated(rows, finish, "doc_id long, n_words long, n_removed long, kept_sha256 string", window, id_col, text_col)


def remove_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with all its columns; texts that lose words become their kept words joined by single spaces."""

    def finish(c: Chunk, gone: np.ndarray) -> pa.Table:
        texts = [b" ".join(w).decode() if k else t for (w, k), t in zip(_kept(c, gone), c.texts, strict=True)]
        at = c.batch.schema.get_field_index(text_col)
        return c.batch.set_column(at, c.batch.schema.field(at), pa.chunked_array([pa.array(texts, c.batch.schema.field(at).type)]))

    return repeated(docs, finish, docs.schema, window, id_col, text_col)
