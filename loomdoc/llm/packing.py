"""Cost-balanced packing of token ids into sequences.

A sequence's cost is linear in its tokens and quadratic in each piece's, as attention is within a document. Documents
are taken in batches of consecutive rows, in descending length; each goes whole to the cheapest sequence with room.
Sequences' capacities add up to the batch's tokens: full ones, and powers of two for the rest, so that none is
padded. A document for which no sequence has room is cut where the roomiest one ends. Batches are packed where their
rows are: nothing is shuffled, and a batch bounds a worker's memory.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomdoc.llm.bytebpe import encoder
from loomdoc.llm.common import slices

#: Tokens in a batch, at least, unless the partition ends.
BATCH = 1 << 20
#: Characters of a run of texts, and rows whose texts are Python strings at once.
RUN, ROWS = 2_000_000, 512


def capacities(total: int, size: int) -> list[int]:
    """Full sequences, then powers of two for what is left, largest first."""
    rest = total % size
    return [size] * (total // size) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pack(lengths: list[int], size: int, linear: float = 1.0, quadratic: float = 1.0 / 2048) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) for documents of these lengths.

    Every sequence ends up full: its length is size or a power of two.
    """
    room = np.array(capacities(sum(lengths), size), np.int64)  # what is left of each
    cost = np.zeros(len(room))
    used = [0] * len(room)
    pieces = []

    def put(doc: int, start: int, n: int, s: int) -> None:
        pieces.append((doc, start, n, s, used[s]))
        used[s] += n
        room[s] -= n
        cost[s] += linear * n + quadratic * n * n

    for doc in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        start, left = 0, lengths[doc]
        while left:
            s = int(np.where(room >= left, cost, np.inf).argmin())  # the first of the cheapest
            if room[s] >= left:
                put(doc, start, left, s)
                break
            s = int(room.argmax())  # no sequence has room for it whole
            most = int(room[s])
            put(doc, start, most, s)
            start, left = start + most, left - most
    return pieces


def pack_sequences(docs: DataFrame, path: str, size: int = 2048, end_id: int = 1, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every text's ids, each with end_id after it, and the sequence and place of each piece.

    Null texts are empty and give the end id alone; rows of one id are documents of their own; other columns are
    left out. sequence_id is the partition's number times 2^36 plus a count. with_ids adds the packed ids.
    """
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    ddl = ", ".join(f"{n} long" for n, _ in fields)
    if with_ids:
        fields.append(("ids", pa.binary()))
        ddl += ", ids binary"
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 36
        keys: list = []
        sizes: list[int] = []
        held: list[np.ndarray] = []
        code = encoder(path, RUN)

        def packed() -> pa.RecordBatch:
            nonlocal first, keys, sizes, held
            data = np.concatenate(held).view(np.uint8).data
            begin = np.concatenate([[0], np.cumsum(sizes)]).tolist()
            pieces = pack(sizes, size)
            each = [data[4 * (begin[d] + s) : 4 * (begin[d] + s + n)] for d, s, n, _, _ in pieces]
            d, s, n, q, o = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
            cols = [pa.array([keys[i] for i in d], pa.int64()), pa.array(s), pa.array(n), pa.array([zlib.crc32(x) for x in each], pa.int64()), pa.array(np.array(sizes, np.int64)[d]), pa.array(q + first), pa.array(o)]
            if with_ids:
                cols.append(pa.array([bytes(x) for x in each], pa.binary()))
            first += int(q.max()) + 1
            keys, sizes, held = [], [], []
            return pa.RecordBatch.from_arrays(cols, schema=schema)

        tokens = 0
        for b in slices(batches, ROWS):
            ids_of = b.column(0).to_pylist()
            for at, ids, n in code(b.column(1).to_pylist()):
                held.append(np.insert(ids, np.cumsum(n), end_id).astype("<u4", copy=False))
                del ids  # not to be held while the next run is encoded
                keys += ids_of[at : at + len(n)]
                sizes += (n + 1).tolist()
                tokens += len(held[-1])
                if tokens >= BATCH:
                    yield packed()
                    tokens = 0
        if sizes:
            yield packed()

    return docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"coalesce(cast(`{text_col}` as string), '') as text").mapInArrow(run, ddl)
