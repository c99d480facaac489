"""What the pipeline's stages keep, against plain code."""

import random

from pyspark.sql import functions as F
from tests.llm import brute

import corpus_pipeline
from loomdoc.llm import simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)], SCHEMA).repartition(3)


def shingles(text, k=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + k]) for i in range(max(len(w) - k, 0) + 1)} if w else set()


def similar(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) >= 0.8 * len(a | b)


def near_copies():
    rng = random.Random(5)
    texts = ["", None, "a b", "A  b", "a b c", "one two three four five", "one two three four five six"]
    for n in (30, 80, 80, 300):
        base = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        for edits in (0, 1, 2, 3, 5, 8):
            w = list(base)
            for p in rng.sample(range(n), edits):
                w[p] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    return texts


def test_near_duplicate_stage_keeps_one_of_each_group_at_0_8(spark):
    texts = near_copies()
    comp = brute.components(list(range(len(texts))), lambda a, b: similar(texts[a], texts[b]))
    out = corpus_pipeline.near_duplicate(spark, docs(spark, texts), "")
    assert sorted(r.doc_id for r in out.collect()) == [i for i in range(len(texts)) if comp[i] == i]
    got = {r.doc_id: r.component_id for r in simhash.similar(docs(spark, texts).withColumn("node", F.lit(1))).collect()}
    assert got == comp


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (1, b), (1, a.upper()), (None, b + " c"), (None, "quite another text"), (2, None), (2, ""), (None, None)]
    got = simhash.keep_one(spark.createDataFrame([(i, t, "clash", 7) for i, t in rows], "doc_id long, text string, digest_0 string, Least_0 int").repartition(3))
    assert got.columns == ["doc_id", "text", "digest_0", "Least_0"]
    kept = [(r.doc_id, (r.text or "").lower()) for r in got.collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (1, b), (None, "quite another text"), (2, "")], key=str)


def test_dense_groups_below_and_above_the_similarity(spark):
    """Near copies of one text, many more than a slice holds, and texts that share half of their words with it."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for k in range(90):
        w = list(base)
        for p in rng.sample(range(120), 2 if k % 3 else 14):
            w[p] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    comp = brute.components(list(range(len(texts))), lambda a, b: similar(texts[a], texts[b]))
    simhash_slice, simhash.SLICE = simhash.SLICE, 8
    try:
        got = {r.doc_id: r.component_id for r in simhash.similar(docs(spark, texts)).collect()}
    finally:
        simhash.SLICE = simhash_slice
    assert got == comp


def test_substring_stage_drops_only_rows_whose_words_are_all_removed(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(0, passage, "en", "s", 1), (1, passage, "en", "s", 0), (2, "", "en", "s", None), (3, "", "en", "s", 7), (4, None, "en", "s", None), (5, " ", "en", "s", 1), (6, passage + " tail", "en", "s", None)]
    out = corpus_pipeline.substrings(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "")
    assert out.schema == spark.createDataFrame([], SCHEMA).schema
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect()) == [(0, passage, len(passage)), (2, "", 0), (3, "", 0), (4, None, None), (5, " ", 1), (6, "tail", 4)]
