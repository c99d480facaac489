"""The queries over the driver's smallest tables: those with SQL against it, the pipeline's stages against brute force."""

import hashlib
import os

import duckdb
import pytest
from pyspark.sql import functions as F
from tests.llm import brute
from tests.llm.test_pipeline_rules import shingles
from tests.test_queries import SF, TABLES, rows

import corpus_pipeline
from loomdoc.llm import queries
from loomdoc.llm.common import table

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = queries.queries()[name](spark, SF).toPandas(), con.execute(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


@pytest.mark.parametrize("name", [n for n in queries.queries() if n not in ("op4_topk", "op9_packing")])
def test_a_row_each(spark, name):
    source = "embeddings" if name.startswith("op6_") else "documents"
    assert queries.queries()[name](spark, SF).count() == table(spark, SF, source).count()


def test_pipeline(spark, tmp_path):
    docs = table(spark, SF, "documents")
    texts = {}
    for name, stage in corpus_pipeline.STAGES:
        before = texts or {r.doc_id: r.text for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert out.dtypes == docs.dtypes
            got = {r.doc_id: r for r in out.collect()}
            texts = {i: r.text for i, r in got.items()}
            assert all(r.n_chars == len(r.text) for r in got.values()) and set(texts) <= set(before)
        if name == "quality":
            marks = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
            assert sum((i in texts) == bool(q) for i, q in marks.items()) > 0.95 * len(marks)
        elif name == "near_duplicates":
            sets = {i: shingles(t) for i, t in before.items()}
            comp = brute.components(list(sets), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
            assert texts == {i: before[i] for i in before if comp[i] == i}
        elif name == "substrings":
            want = brute.repeats(list(before.items()))
            assert set(texts) == {i for i, (n, gone, _) in want.items() if n == 0 or gone < n}
            assert all(texts[i] == before[i] if want[i][1] == 0 else hashlib.sha256(texts[i].encode()).hexdigest() == want[i][2] for i in texts)
        elif name == "secrets":
            assert set(texts) == set(before) and not any(brute.secrets(t) for t in texts.values())
            assert all(texts[i] == t for i, t in before.items() if "[SECRET]" not in texts[i])
        else:
            pieces = [tuple(r) for r in out.select("doc_id", "start", "length", "sequence_id", "offset", "doc_tokens").collect()]
            assert {p[0] for p in pieces} == set(before)
            assert all(sum(p[2] for p in pieces if p[0] == i) == next(p[5] for p in pieces if p[0] == i) for i in before)
        docs = out
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


def test_pipeline_of_nothing(spark, tmp_path):
    docs = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls in any column, repeated ids and rows, no n_chars, clashing names; all stages."""
    real = table(spark, SF, "documents").drop("n_chars")
    odd = [(1_000_001, "some words here", "en", "s"), (1_000_001, "some words here", "en", "s"), (1_000_001, "other words are here", None, "s"), (None, "a text without an id", None, None), (1_000_002, None, "en", "s"), (1_000_003, "", "en", "s"), (1_000_004, "long " * 40_000, "en", "s")]
    docs = real.unionByName(spark.createDataFrame(odd, real.schema)).withColumn("digest_0", F.lit(1)).withColumn("base_spans_0", F.lit("x"))
    names, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.groupBy("doc_id").count().filter("doc_id is null or doc_id > 1000000").collect()
        if name != "packing":
            assert docs.columns == names
    ids = lambda name: {r.doc_id for r in kept[name]}
    good = ids("quality")
    assert ids("packing") == ids("secrets") == ids("substrings") == good - ({1_000_003} if 1_000_002 in good else set())
    for name in ("near_duplicates", "secrets"):
        assert all(r["count"] <= 2 for r in kept[name] if r.doc_id == 1_000_001)
