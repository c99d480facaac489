"""Classes read a text once for each rule, whatever is made of the result."""

from pyspark.sql import functions as F

from loomdoc.operators.classify import KEYWORDS, classify, structure_counts
from loomdoc.plans import queries as plans


def test_texts_are_read_once(spark, tmp_path):
    spark.createDataFrame([(7, "dear all\nsection 1"), (8, "")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    df = plans.queries()["classification_evidence"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    most = {"replace(": 1, "lower(": 3, "split(": 1, "regexp_extract_all(": 2, "regexp_count(": 2}  # replace( in regexp_replace( does not count
    for call, n in most.items():
        assert plan.count(call) - (plan.count("regexp_replace(") if call == "replace(" else 0) <= n, call


def test_evidence_of_phrases(spark):
    texts = ["Sections: SECTION sectionésection cc:cc:cc: resubmittal", "", None, " \n", "nothing of it"]
    got = {r.i: {e.rule_id: e.detail for e in r.evidence if e.rule_id.startswith("keyword")} for r in classify(spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("source_filename", F.lit("a"))).collect()}
    for i, text in enumerate(texts):
        low = (text or "").lower()
        want = {f"keyword:{c}:{p[:24]}": f'Phrase "{p}" appears ~{low.count(p)} time(s)' for c, ps in KEYWORDS.items() for p in ps if low.count(p)}
        assert {k: v.split(" →")[0] for k, v in got[i].items()} == want


def test_headings_among_lines(spark):
    text = " \tSECTION 09 65 00\nPart 2 - X\r\nsection 1\x0b 1.2 Scope\x85ALL CAPS LINE\nARTICLE 5\nDivision 3\nxSECTION 09 65 00\nSECTION 1 ... 4\n"
    r = spark.createDataFrame([(text,)], "text string").select(*(v.alias(k) for k, v in structure_counts(F.col("text")).items())).first()
    assert (r.headings, r.lines) == (5, 9)
