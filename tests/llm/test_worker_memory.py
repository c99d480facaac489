"""What keeps an executor's Python workers small and few."""

import re
import tracemalloc

import numpy as np
import pyarrow as pa
import public_tokenizers

from loomdoc.llm import bytebpe, simhash, substring_dedup

from .test_bounds import copies


def test_no_task_of_near_duplicates_runs_two_python_workers(spark, monkeypatch):
    plans, whole = [], simhash.cut

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return whole(df)

    monkeypatch.setattr(simhash, "cut", seen)
    simhash.similar(spark.createDataFrame(list(enumerate(copies(90))), "doc_id long, text string")).collect()
    python = [re.findall(r"MapInArrow|Exchange", p) for p in plans]
    assert sum("MapInArrow" in x for x in python) >= 2
    assert not any(x[i : i + 2] == ["MapInArrow"] * 2 for x in python for i in range(len(x)))


def test_library_gets_short_calls_and_ids_stay(monkeypatch):
    units = bytebpe.json_units(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [" ".join(f"w{i}x{k}" for i in range(3000)) for k in range(20)] + ["", "x  y", " a"]
    got = [(ids.tolist(), n.tolist()) for _, ids, n in units(texts)]
    monkeypatch.setattr(bytebpe, "GATHER", 7)
    one = bytebpe.json_units(public_tokenizers.path("byte_bpe_50k.json"), run=5000)
    each = [(ids.tolist(), n.tolist()) for _, ids, n in one(texts)]
    assert sum((i for i, _ in got), []) == sum((i for i, _ in each), []) and sum((n for _, n in got), []) == sum((n for _, n in each), [])
    assert bytebpe.CALL_CHARS <= 30_000


def test_words_of_a_chunk_are_not_held_where_hashes_do():
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(200)), "text": [" ".join(f"{k}a{i}" for i in range(500)) for k in range(200)]})
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as w:
        w.write_batch(batch)
    peaks, made = [], []
    for words in (True, False):
        tracemalloc.start()
        made.append(substring_dedup.Chunk(out.getvalue(), "text", words=words))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    a, b = made
    assert (a.hashes == b.hashes).all() and (a.seconds == b.seconds).all() and (a.sizes == b.sizes).all() and np.array_equal(a.ends, b.ends)
    assert peaks[1] < 0.7 * peaks[0], peaks
