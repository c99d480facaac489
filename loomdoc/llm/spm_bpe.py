"""Byte-level BPE by a sentencepiece model that is written from a rank file.

The model's pieces are the vocabulary's byte strings with a printable character for each byte, scored by negative
rank, so that sentencepiece merges the pair of lowest rank, leftmost first; normalisation is the identity. It gets
the pattern's matches one by one; ids go back to bytes by the inverse of the mapping.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from loomdoc.llm.bytebpe import Units, loaded
from loomdoc.llm.common import slices
from loomdoc.llm.token_counts import byte_chars

#: Name of the piece for unknown input, which never occurs: it has no character that stands for a byte.
UNKNOWN = "⁇unk⁇"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value) -> bytes:
    """A protobuf field: bytes and str by length, float as 32 bits, int and bool as varint."""
    if isinstance(value, str):
        value = value.encode()
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(int(value) & (1 << 64) - 1)


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece model whose ids are the ranks; the unknown piece comes after them."""
    chars = byte_chars()
    order = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in order] != list(range(len(order))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    out = bytearray()
    # ModelProto.pieces: piece 1, score 2, type 3 (1 normal, 2 unknown)
    for i, t in enumerate(order):
        out += _field(1, _field(1, "".join(chars[b] for b in t)) + _field(2, float(-i)) + _field(3, 1))
    out += _field(1, _field(1, UNKNOWN) + _field(2, 0.0) + _field(3, 2))
    # trainer_spec: model_type 3 = BPE (2), vocab_size 4, unk_id 40, bos_id 41, eos_id 42, pad_id 43, unk_piece 45
    out += _field(2, _field(3, 2) + _field(4, len(order) + 1) + _field(40, len(order)) + _field(41, -1) + _field(42, -1) + _field(43, -1) + _field(45, UNKNOWN))
    # normalizer_spec: name 1, no dummy prefix 3, extra spaces stay 4, spaces are not escaped 5
    out += _field(3, _field(1, "identity") + _field(3, False) + _field(4, False) + _field(5, False))
    return bytes(out)


class RankCoder:
    """Encodes and decodes as a byte-level BPE with these ranks does."""

    def __init__(self, path: str):
        import public_tokenizers
        import sentencepiece

        self.ranks = read_ranks(path)
        self.bytes_of = sorted(self.ranks, key=self.ranks.get)
        self.sp = sentencepiece.SentencePieceProcessor()
        self.sp.LoadFromSerializedProto(model_proto(self.ranks))
        self.find = regex.compile(public_tokenizers.PATTERN).findall
        self.table = dict(enumerate(byte_chars()))
        self.units = Units(self._encode)

    def words(self, words: list[str]) -> list[list[int]]:
        """Ids of matches; one that is in the vocabulary is its own id, however it would merge."""
        data = [w.encode() for w in words]
        out = [[self.ranks[d]] if d in self.ranks else None for d in data]
        rest = [i for i, ids in enumerate(out) if ids is None]
        if rest:
            mapped = [data[i].decode("latin-1").translate(self.table) for i in rest]
            for i, ids in zip(rest, self.sp.encode(mapped, out_type=int, num_threads=1), strict=True):
                out[i] = ids
        return out

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = list(map(self.find, texts))
        words = list({w for ws in split for w in ws})
        known = dict(zip(words, self.words(words), strict=True))
        each = [[i for w in ws for i in known[w]] for ws in split]
        return np.array([i for e in each for i in e], "<u4"), np.array([len(e) for e in each], np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


def bpe_round_trip(docs: DataFrame, path: str, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every text, their digest, and the digest of the bytes they decode to.

    Null texts are empty ones: no ids, digests of nothing. Every row gives a row; other columns are left out.
    with_ids adds the ids, packed as little-endian 32-bit integers, and the decoded bytes. No shuffle.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        fields += [("ids", pa.binary()), ("decoded", pa.binary())]
        ddl += ", ids binary, decoded binary"
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded("ranks", path, RankCoder)
        for b in slices(batches):
            for at, ids, sizes in coder.units(b.column(1).to_pylist()):
                ends = np.cumsum(sizes)
                each = [ids[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                packed, decoded = [x.tobytes() for x in each], [coder.decode(x) for x in each]
                sha = lambda xs: pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string())
                cols = [b.column(0).slice(at, len(each)), pa.array(sizes), sha(packed), sha(decoded)]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array(packed, pa.binary()), pa.array(decoded, pa.binary())] if with_ids else []), schema=schema)

    return docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"coalesce(cast(`{text_col}` as string), '') as text").mapInArrow(run, ddl)
