"""Ids in bit planes: a worker with memory to spare remembers more units, and planes and files stay the same."""

import numpy as np
import public_tokenizers

from loomdoc.llm import bitplane, bytebpe

JSON = public_tokenizers.path("byte_bpe_50k.json")


def test_units_are_remembered_by_the_own_limit(monkeypatch):
    monkeypatch.setattr(bytebpe, "MAX_UNITS", 10)
    texts = [" ".join(f"word{i}" for i in range(200)), "", "x  y", " ".join(f"word{i}" for i in range(100, 300))]
    plain, more = bytebpe.json_units(JSON), bytebpe.json_units(JSON, run=1000, most=1000)
    want = [tok for _, ids, _ in plain(texts) for tok in ids.tolist()]
    assert [tok for _, ids, _ in more(texts) for tok in ids.tolist()] == want
    asked = []
    whole = more.encode
    more.encode = lambda t: asked.extend(x for x in t if x.startswith(" word")) or whole(t)
    assert [tok for _, ids, _ in more(texts) for tok in ids.tolist()] == want and not asked


def test_planes_are_those_of_each_bit():
    rng = np.random.default_rng(4)
    for ids in (np.zeros(0, "<u4"), np.zeros(5, "<u4"), rng.integers(0, 50_000, 1003).astype("<u4"), rng.integers(0, 1 << 32, 64, dtype="u8").astype("<u4")):
        width = int(ids.max()).bit_length() if len(ids) else 0
        want = [np.packbits((ids >> np.uint32(b)) & 1 == 1, bitorder="little").tobytes() for b in range(width)]
        assert bitplane.planes(ids) == want and (bitplane.from_planes(want, len(ids)) == ids).all()
