"""What bounds leave to be compared: in dense groups of near copies little more than what links."""

import random

import numpy as np

from loomdoc.llm import simhash


def copies(n, seed=5):
    """Texts that differ from one text, which is not there, in two words each, so that most pairs are just below 0.8."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w = [f"w{i}" for i in range(120)]
        for p in rng.sample(range(120), 2):
            w[p] = f"x{rng.randrange(10**9)}"
        out.append(" ".join(w))
    return out


def test_dense_group_leaves_few_pairs(spark, monkeypatch):
    texts, seen = copies(90), []
    whole = simhash._similar_pairs

    def counted(texts, groups, pairs, *more):
        seen.append(sorted(map(tuple, pairs.collect())))
        return whole(texts, groups, pairs, *more)

    monkeypatch.setattr(simhash, "_similar_pairs", counted)
    got = {r.doc_id: r.component_id for r in simhash.similar(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    sets = [set(simhash.shingle_set(simhash.words(t), 5).tolist()) for t in texts]
    links = [(i, j) for i in range(90) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert all(got[i] == got[j] for i, j in links)
    assert len(seen[-1]) <= 90 * 89 / 2 / 8, (len(seen[-1]), len(links))


def test_bitmaps_never_differ_in_more_bits_than_sets_in_hashes():
    rng = np.random.default_rng(2)
    for n in (0, 1, 50, 3000):
        both = rng.integers(0, 1 << 63, n).astype("<u8")
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, k).astype("<u8")])) for k in (n // 5, n // 3))
        assert np.bitwise_count((simhash.bitmap(a) ^ simhash.bitmap(b)).view("<u8")).sum() <= len(np.setxor1d(a, b))
