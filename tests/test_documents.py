import pytest
from pyspark.sql import functions as F

from loomdoc.config import ChunkingConfig
from loomdoc.operators import chunking, ocr, quality, sections

CFG = ChunkingConfig(20, 120, 60, 80, 5, 15)


def pages(spark, *texts, doc="d"):
    return spark.createDataFrame([(doc, i + 1, t, "parse", 1.0) for i, t in enumerate(texts)], "document_id string, page_number int, text string, method string, confidence double")


def test_config():
    with pytest.raises(ValueError):
        ChunkingConfig(min_words=200)
    with pytest.raises(ValueError):
        ChunkingConfig(min_words=3000)
    assert ChunkingConfig().target == 1350 and ChunkingConfig().overlap == 150


def test_sections_over_pages(spark):
    got = sections.detect_sections(pages(spark, "intro\nPART 1 - GENERAL\nbody a", "PART 2 - PRODUCTS\nbody b")).orderBy("section_index").collect()
    assert [(r.heading_text, r.body_text, r.page_start, r.page_end) for r in got] == [(None, "intro", 1, 1), ("PART 1 - GENERAL", "body a", 1, 1), ("PART 2 - PRODUCTS", "body b", 2, 2)]
    assert [round(r.confidence, 3) for r in got] == [0.5, 0.9, 0.9] and got[0].strategy == "text_heuristic"


def test_noise_and_empty(spark):
    noisy = "\n".join(f"{i}.1 Title" for i in range(1, 31))
    got = sections.detect_sections(pages(spark, noisy, noisy)).collect()
    assert len(got) == 2 and {r.strategy for r in got} == {"fallback_page"} and {r.confidence for r in got} == {0.35}
    single = sections.detect_sections(pages(spark, "", "")).collect()
    assert len(single) == 1 and single[0].strategy == "fallback_single" and (single[0].page_start, single[0].page_end) == (1, 2)
    assert sections.detect_sections(pages(spark)).count() == 0


def test_styles_win(spark):
    blocks = spark.createDataFrame([("d", 0, "heading", "One"), ("d", 1, "paragraph", "a"), ("d", 2, "heading", "Two")], "document_id string, order_index int, kind string, text string")
    got = sections.detect_sections(pages(spark, "One\n\na\n\nTwo"), blocks).orderBy("section_index").collect()
    assert [(r.heading_text, r.body_text, r.strategy) for r in got] == [("One", "a", "docx_styles"), ("Two", "", "docx_styles")]


def chunks(spark, df, cfg=CFG):
    return chunking.chunk_documents(df, sections.detect_sections(df), cfg).orderBy("chunk_index").collect()


def test_limits_and_order(spark):
    text = " ".join(f"w{i}" + ("." if i % 37 == 0 else "") for i in range(5000))
    got = chunks(spark, pages(spark, text))
    assert all(r.chunk_word_count <= 120 for r in got) and got[0].chunk_id == "d-chunk-0001" and got[-1].chunk_index == got[-1].total_chunks == len(got)
    raw = chunking.raw_chunks(chunking.merge_sections(sections.detect_sections(pages(spark, text)), CFG), CFG).orderBy("pos").collect()
    assert " ".join(r.text for r in raw) == text
    assert [r.chunk_text.split()[:10] for r in got[1:]] == [r.text.split()[-10:] for r in raw[:-1]]


def test_headings_without_text_fall_back_to_paragraphs(spark):
    got = chunks(spark, pages(spark, "PART 1 - GENERAL\nPART 2 - PRODUCTS"))
    assert [r.chunk_text for r in got] == ["PART 1 - GENERAL\nPART 2 - PRODUCTS"] and got[0].section_detection_confidence is None
    assert chunks(spark, pages(spark, " \n ")) == []


def test_packing_flushes(spark):
    para = lambda n, c: " ".join([c] * n)
    text = "\n\n".join([para(50, "a"), para(40, "b"), para(60, "c"), para(130, "d"), para(10, "e")])
    got = spark.createDataFrame([(text,)], "t string").select(F.explode(chunking.split_oversized(F.col("t"), CFG)).alias("p")).collect()
    assert [sorted(set(r.p.split())) for r in got] == [["a", "b"], ["c"], ["d"], ["d"], ["e"]]


def test_quality(spark):
    df = pages(spark, "x" * 50, "").withColumn("confidence", F.lit(0.95))
    d = quality.document_summary(df).first()
    assert d.percent_empty_pages == 50.0 and d.extraction_mode == "native" and not d.ocr_used and d.document_needs_review
    rows = quality.with_quality(chunking.chunk_documents(df, sections.detect_sections(df), CFG), quality.document_summary(df), CFG.min_words)
    r = rows.first()
    assert 0 < r.chunk_quality_score < 1 and r.low_quality_chunk and r.ocr_confidence is None
    assert quality.job_summary(rows.filter("false")).first().asDict() == {"chunks_total": 0, "low_quality_chunks": 0, "documents_needing_review": 0, "mean_chunk_quality_score": None, "fraction_low_quality": None}


class Fake(ocr.NoProvider):
    """Sees an image's or a page's bytes."""

    provider_id = "fake"

    def is_available(self):
        return True

    def read_image(self, image, language="eng"):
        return ocr.OcrResult(f"image of {len(image)} bytes", 0.9, "fake")

    def read_pdf_page(self, pdf, page_number, language="eng"):
        if page_number == 3:
            raise RuntimeError("no")
        return ocr.OcrResult(f"{pdf[:1].decode()} page {page_number}", 0.72, "fake", page_number=page_number)


def test_recognition(spark):
    files = spark.createDataFrame([("d", bytearray(b"pdf")), ("i", bytearray(b"1234"))], "document_id string, content binary")
    flagged = spark.createDataFrame([("d", 1, "pdf", "x" * 39), *(("d", n, "pdf", "") for n in range(2, 40)), ("i", 1, "image", "")], "document_id string, page_number int, kind string, text string")
    got = {(r.document_id, r.page_number): (r.text, r.method, round(r.confidence, 3)) for r in ocr.recognise(flagged, files, Fake).collect()}
    assert len(got) == 40 and got["d", 1] == ("x" * 39 + "\n\np page 1", "hybrid", 0.835) and got["d", 2] == ("p page 2", "ocr", 0.72)
    assert got["d", 3] == ("", "parse", 0.0) and got["d", 39] == ("p page 39", "ocr", 0.72) and got["i", 1] == ("image of 4 bytes", "ocr", 0.9)
    got = {(r.document_id, r.page_number): (r.method, r.confidence) for r in ocr.recognise(flagged, files, ocr.NoProvider).collect()}
    assert got["d", 1] == ("parse", 0.3) and got["d", 2] == ("parse", 0.0) and got["i", 1] == ("ocr", 0.0)


def test_providers(monkeypatch):
    assert ocr.mean_confidence(["96", "96.5", "-1"]) == 0.96 and ocr.mean_confidence([]) == 0.5
    assert [(r.page_number, r.error) for r in ocr.NoProvider().read_batch([b"", b""])] == [(1, "provider unavailable"), (2, "provider unavailable")]
    assert [(r.text, r.page_number) for r in Fake().read_batch([b"a", b"bc"])] == [("image of 1 bytes", 1), ("image of 2 bytes", 2)]
    assert ocr.read_page(b"abc", 7, Fake()) == ocr.OcrResult("image of 3 bytes", 0.9, "fake", None, 7)
    failed = ocr.read_page(b"", 2, ocr.CloudProvider())
    assert failed.confidence == 0.0 and "remote" in failed.error and not ocr.CloudProvider().is_available()
    assert ocr.turn_of("Page: 0\nRotate: 270\n") == 270 and ocr.turn_of("") == 0
    ocr.set_default_provider(Fake)
    try:
        assert ocr.recognition_available() and ocr.read_page(b"a").text == "image of 1 bytes"
    finally:
        ocr.set_default_provider(ocr.TesseractProvider)


def test_tesseract_with_stand_ins(monkeypatch):
    """The steps of preparation and the confidences, with what Tesseract and Pillow are asked for written down."""
    import sys
    import types

    asked = []

    class Image:
        def __getattr__(self, name):
            return lambda *a, **k: (asked.append(name), self)[1]

    ops = types.SimpleNamespace(grayscale=lambda x: (asked.append("grey"), x)[1], autocontrast=lambda x, cutoff: (asked.append(f"contrast {cutoff}"), x)[1])
    filters = types.SimpleNamespace(MedianFilter=lambda n: asked.append(f"median {n}"))
    pillow = types.SimpleNamespace(Image=types.SimpleNamespace(open=lambda b: Image()), ImageOps=ops, ImageFilter=filters)

    def data(*a, **k):
        raise RuntimeError("no data")

    engine = types.SimpleNamespace(get_tesseract_version=lambda: "5", image_to_string=lambda img, lang: " words ", image_to_data=data, image_to_osd=lambda img, lang: "Rotate: 90", Output=types.SimpleNamespace(DICT=1))
    monkeypatch.setitem(sys.modules, "PIL", pillow)
    monkeypatch.setitem(sys.modules, "pytesseract", engine)
    r = ocr.TesseractProvider(ocr.Preparation(upright=True)).read_image(b"x")
    assert (r.text, r.confidence, r.error) == ("words", 0.7, None)
    assert asked == ["load", "convert", "grey", "contrast 1", "median 3", "filter", "convert", "point", "convert", "rotate"]
    engine.image_to_data = lambda *a, **k: {"conf": [90, "80", -1]}
    assert ocr.TesseractProvider().read_image(b"x").confidence == 0.85


def test_notes(spark):
    notes = lambda *t, **k: sections.detect_sections(pages(spark, *t), **k).first().notes
    assert notes("a line") == [sections.NOTES["short"]] and notes("word " * 100) == [sections.NOTES["none"]]
    assert notes("x" * 199, "y" * 200) == [sections.NOTES["short"]] and notes("x" * 200, "y" * 200) == [sections.NOTES["none"]]
    blocks = spark.createDataFrame([("d", 0, "paragraph", "a line")], "document_id string, order_index int, kind string, text string")
    assert notes("a line", blocks=blocks) == [sections.NOTES["unstyled"], sections.NOTES["short"]]
    assert notes("PART 1 - GENERAL\nbody") == []
