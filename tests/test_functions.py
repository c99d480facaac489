from pyspark.sql import functions as F

from loomdoc.functions import text as T
from loomdoc.operators.classify import classify
from loomdoc.operators.headings import heading_reasons, heading_score, is_heading


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("r")).first().r


def test_white_space_is_unicode(spark):
    assert one(spark, "a b　c\u0085d\x1ce", T.count_words) == 5
    assert one(spark, "　 x  ", T.strip) == "x"
    assert one(spark, "a\r\nb\t \tc\n\n\n\nd ", T.normalize_whitespace) == "a\nb c\n\nd"
    assert one(spark, "a b \n c", T.non_whitespace_chars) == 3 and one(spark, "", T.non_whitespace_chars) == 0


def test_word_pieces(spark):
    assert one(spark, "a  b c", lambda c: T.tail_words(c, 2)) == "b c"
    assert one(spark, " a\nb ", lambda c: T.tail_words(c, 2)) == "a\nb"
    assert one(spark, "a b", lambda c: T.tail_words(c, 0)) == ""
    assert one(spark, "a b c", lambda c: T.cap_words(c, 2)) == "a b"
    assert one(spark, "One. Two!  Three", T.split_sentences) == ["One.", "Two!", "Three"]


def test_names(spark):
    assert one(spark, "folder/Spec A (2024).pdf", T.source_spec) == "Spec A (2024)"
    assert one(spark, ".bashrc", T.source_spec) == ".bashrc"
    assert one(spark, "a.tar.gz", T.source_spec) == "a.tar"
    assert one(spark, "x/A b__c!!.txt", T.safe_stem) == "A_b_c"
    assert one(spark, "SECTION 09  62 29 - CORK", T.section_number) == "09 62 29"
    assert one(spark, "1.2.3 Scope", T.section_number) == "1.2.3" and one(spark, "Scope", T.section_number) is None
    assert [one(spark, n, T.document_kind) for n in ("a.PDF", "b.md", "c.tsv", "d.html", "e.webp", "noext", "f.zzz")] == ["pdf", "txt", "csv", "txt", "image", "unknown", "unknown"]


def test_cells(spark):
    assert [one(spark, v, T.excel_cell) for v in ("=1+1", "\t=1", "\tx", "ok")] == ["'=1+1", "'\t=1", "\tx", "ok"]
    assert one(spark, "a\x01\tb\r\n\x1f", T.strip_control) == "a\tb\r\n"
    assert one(spark, " A" + "b" * 63, T.valid_sha256) == "a" + "b" * 63 and one(spark, "not-a-hash", T.valid_sha256) is None


def test_heading_scores(spark):
    want = {"SECTION 09 65 00 RESILIENT FLOORING": 7.5, "Section 09 65 00": 6.0, "SECTION 1": 5.0, "PART 1 - GENERAL": 7.0, "PART 1": 3.0, "DIVISION 03": 6.0, "1.1 SUMMARY": 5.0, "1.1 Scope": 3.5, "ARTICLE 5": 5.5, "1.0": 2.0, "CAST-IN-PLACE CONCRETE": 1.5, "PART 1 - GENERAL ..... 3": None, "plain words": None, "ab": None}
    df = spark.createDataFrame([(k,) for k in want], "line string").select("line", heading_score(F.col("line")).alias("s"), is_heading(F.col("line")).alias("h"), heading_reasons(F.col("line")).alias("r"))
    got = {r.line: r for r in df.collect()}
    assert {k: r.s for k, r in got.items()} == want
    assert not got["1.0"].h and got["PART 1"].h
    assert got["1.1 Scope"].r == ['Numbered outline with title ("1.1 …").'] and got["plain words"].r == []


def test_classes(spark):
    spec = "SECTION 09 65 00\nPART 1 - GENERAL\n1.1 SUMMARY\nmaterials execution\n" * 2
    df = spark.createDataFrame([("Submittal_1.txt", "weak"), ("x.txt", spec), ("y.txt", " "), (None, None)], "source_filename string, text string")
    got = [r.asDict() for r in classify(df).collect()]
    assert [r["category"] for r in got][:1] == ["submittal"] and got[1]["category"] in ("specification", "mixed_package") and got[2]["category"] == got[3]["category"] == "unknown"
    assert got[0]["evidence"][0]["rule_id"].startswith("filename:") and got[2]["evidence"] == [] and got[2]["confidence"] == 0.1


def test_evidence_and_stand_ins(spark):
    from loomdoc.operators.classify import classify_pages, untrained

    pages = spark.createDataFrame([("d", 2, "subject: submittal and product data, shop drawing"), ("d", 1, "Dear all, pursuant to your letter, regards, sincerely")], "document_id string, page_number int, text string")
    files = spark.createDataFrame([("d", "x.txt")], "document_id string, source_filename string")
    r = classify_pages(pages, files).first()
    assert r.text.startswith("Dear all") and r.category == "mixed_package" and r.scores["unknown"] == 0.0
    assert any(e.rule_id == "meta:mixed_signals" for e in r.evidence)
    assert 'Phrase "dear" appears ~1 time(s) → +1.39 toward correspondence' in [e.detail for e in r.evidence]
    assert [abs(e.weight) for e in r.evidence] == sorted((abs(e.weight) for e in r.evidence), reverse=True)
    u = classify_pages(pages, files, untrained).first()
    assert (u.category, u.confidence, u.evidence, u.scores, u.classifier_id) == ("unknown", 0.0, [], {}, "ml_stub")


def test_checks(spark):
    import pytest

    from loomdoc.operators import checks

    df = spark.createDataFrame([(1, 2), (3, 2), (None, 1)], "page_start int, page_end int")
    rule = {"page_span": checks.CHUNK_RULES["page_span"]}
    assert [tuple(r) for r in checks.violations(df, rule).collect()] == [("page_span", 1)]
    assert checks.enforced(df.filter("page_start = 1"), rule).count() == 1
    with pytest.raises(Exception, match="rule broken: page_span"):
        checks.enforced(df, rule).collect()


def test_settings(tmp_path):
    import pytest

    from loomdoc.config import load_settings

    pytest.importorskip("yaml")
    (tmp_path / "a.yaml").write_text("x: 1")
    (tmp_path / "b.yaml").write_text("- 1")
    assert load_settings(str(tmp_path / "a.yaml")) == {"x": 1}
    with pytest.raises(ValueError):
        load_settings(str(tmp_path / "b.yaml"))


def test_preview(spark):
    from loomdoc.operators.export import preview_text

    df = spark.createDataFrame([("d" * 64, "a.txt", "d-chunk-0001", 1, 1, "unknown", "x  y " * 90)] * 4, "document_id string, source_filename string, chunk_id string, page_start int, page_end int, document_type string, chunk_text string")
    assert preview_text(df).endswith("… and 1 more row(s).") and len(preview_text(df).splitlines()) == 6
