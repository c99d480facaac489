"""Queries without SQL over every document, against plain code."""

import random

import pytest

from loomdoc.plans import queries as plans

LEAST, MOST, HIGH, TARGET = 20, 120, 80, 70


@pytest.fixture
def table(spark, tmp_path):
    def write(texts):
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
        return str(tmp_path)

    return write


def windows(text):
    w, at, out = text.split(), 0, []
    if len(w) <= MOST:
        return [text]
    while at < len(w):
        ends = [e for e in range(at + LEAST, min(at + TARGET, len(w)) + 1) if w[e - 1][-1] in ".!?"]
        end = len(w) if len(w) - at <= MOST else max(ends, default=min(at + TARGET, len(w)))
        out.append(" ".join(w[at:end]))
        at = end
    return out


def pieces(text):
    paras = [p.strip() for p in (text or "").split("\n") if p.strip()]
    if sum(len(p.split()) for p in paras) <= MOST or len(paras) < 2:
        return [x for p in ["\n\n".join(paras)] if p for x in windows(p)]
    out, held, n = [], [], 0

    def flush():
        nonlocal held, n
        if held:
            out.append("\n\n".join(held))
        held, n = [], 0

    for p in paras:
        k = len(p.split())
        if k > MOST:
            flush()
            out.extend(windows(p))
            continue
        if n + k + bool(held) > MOST:
            flush()
            held, n = [p], k
            continue
        close = n + k > HIGH and n >= LEAST
        held, n = [*held, p], n + k
        if close:
            flush()
    flush()
    return out


def test_split_oversized(spark, table):
    rng = random.Random(3)
    line = lambda n: " ".join(f"w{rng.randrange(99)}" + rng.choice(["", "", "", ".", "?"]) for _ in range(n))
    texts = [None, "", " \n ", "short", line(120), line(121), line(400), line(30) + "\n" + line(300) + "\n\n" + line(15), line(125) + "\n" + line(125)]
    texts += ["\n".join(line(rng.choice([1, 10, 30, 70, 119, 120, 121, 260])) for _ in range(rng.randrange(1, 9))) for _ in range(40)]
    got = sorted(map(tuple, plans.queries()["split_oversized"](spark, table(texts)).select("doc_id", "part", "text").collect()))
    want = [(i, k, p) for i, t in enumerate(texts) for k, p in enumerate(pieces(t))]
    assert got == want, next((g, w) for g, w in zip(got, want) if g != w)
