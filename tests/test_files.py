import io
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from loomdoc.config import ChunkingConfig, IntakeLimits
from loomdoc.operators import export, ocr
from loomdoc.plans import batch
from loomdoc.sources import files, formats

CFG = ChunkingConfig(20, 120, 60, 80, 5, 15)
W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def docx(*paras):
    body = "".join(f'<w:p><w:pPr><w:pStyle w:val="{s}"/></w:pPr><w:r><w:t>{t}</w:t></w:r></w:p>' for s, t in paras)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}<w:tbl><w:p><w:r><w:t>cell</w:t></w:r></w:p></w:tbl></w:body></w:document>")
        z.writestr("word/styles.xml", f'<w:styles {W}><w:style w:styleId="H2"><w:name w:val="heading 2"/></w:style></w:styles>')
    return out.getvalue()


def pdf(*pages):
    objs = ["<</Type/Catalog/Pages 2 0 R>>", "<</Type/Pages/Kids[]/Count 1>>"]
    for i, text in enumerate(pages):
        s = f"BT ({text}) Tj ET"
        objs += [f"<</Type/Page/Parent 2 0 R/Contents {4 + 2 * i} 0 R>>", f"<</Length {len(s)}>>stream\n{s}\nendstream"]
    return ("%PDF-1.4\n" + "".join(f"{i} 0 obj{o}endobj\n" for i, o in enumerate(objs, 1))).encode()


def test_tables():
    assert formats.csv_text(b"\xef\xbb\xbfa,b\r\nc,d\r\n") == "a\tb\nc\td"
    assert formats.csv_text(b"a;b\nc;d\ne;f\n", 2).endswith("... truncated after 2 data rows ...")
    book = export.xlsx_bytes(["x", "y"], iter([("1", None), (None, " "), ("é", "<z>")]))
    assert formats.xlsx_text(book) == "## Sheet: chunks\nx\ty\n1\t\né\t<z>"
    assert formats.xlsx_text(book, 1).endswith("... truncated (1 rows max) in sheet 'chunks' ...")
    assert formats.docx_blocks(docx(("H2", "One"), ("Body", "text"), ("Body", " "))) == [(0, "heading", "heading 2", "One"), (1, "paragraph", "Body", "text")]
    assert formats.pdf_pages(pdf("Hello \\(x\\)", "two")) == ["Hello (x)", "two"]
    with pytest.raises(ValueError):
        formats.pdf_pages(b"%PDF-broken")
    assert [len(p) for p in export.split_utf8("é".encode() * 50, 65)] == [64, 36]


def test_paths(tmp_path):
    for n in ("b.txt", "a.txt", ".hidden", "_u.txt"):
        (tmp_path / n).write_text("x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.txt").write_text("x")
    assert [os.path.basename(p) for p in files.collect_paths(str(tmp_path))] == ["_u.txt", "a.txt", "b.txt"]
    assert len(files.collect_paths(str(tmp_path), True)) == 4 and files.collect_paths(str(tmp_path / "none")) == [] and files.collect_paths(str(tmp_path / ".hidden"))


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.txt").write_text("SECTION 09 62 29 - CORK\n" + "word " * 60)
    (d / "b.pdf").write_bytes(b"%PDF-broken")
    (d / "c.docx").write_bytes(docx(("H2", "One"), ("Body", "alpha beta"), ("H2", "Two"), ("Body", "gamma")))
    (d / "d.csv").write_text("x,y\nfoo,bar\n")
    (d / "e.txt").write_bytes(b"")
    (d / "f.pdf").write_bytes(pdf("p" * 50, "q"))
    (d / "g.zzz").write_bytes(b"?")
    (d / "h.txt").write_bytes(b"bad \xff byte =1+1")
    (d / "i.png").write_bytes(b"image")
    return d


class Fake(ocr.NoProvider):
    def is_available(self):
        return True

    def read_image(self, image, language="eng"):
        return ocr.OcrResult("seen " + image.decode(), 0.9, "fake")

    def read_pdf_page(self, pdf, page_number, language="eng"):
        return ocr.OcrResult(f"page {page_number}", 0.5, "fake")


def test_images_and_pages_are_recognised(spark, folder):
    rows, outcomes = batch.process(files.read_files(spark, files.collect_paths(str(folder))), CFG, provider=Fake)
    got = {r.source_filename: r for r in rows.collect()}
    assert got["i.png"].chunk_text == "seen image" and got["i.png"].extracted_method == "ocr" and got["i.png"].ocr_confidence == 0.9
    assert got["f.pdf"].chunk_text.endswith("q\n\npage 2") and got["f.pdf"].extracted_method == "hybrid" and got["f.pdf"].ocr_confidence == 0.725
    plan = rows._jdf.queryExecution().toString()
    assert "MapInPandas" not in plan and plan.count("FileScan") == 0  # decoded and recognised once, before


def test_files_that_cannot_be_read(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("gone.txt", "a.txt", "large.txt")] + [str(tmp_path)]
    (tmp_path / "a.txt").write_text("some words")
    (tmp_path / "large.txt").write_text("x" * 100)
    seen = []
    got = batch.run_uploads(spark, paths, cfg=CFG, limits=IntakeLimits(50), on_file_done=lambda *a: seen.append(a))
    outcomes = {r.source_filename: r for r in got.outcomes.collect()}
    assert {n: r.failure_stage for n, r in outcomes.items() if not r.success} == {"gone.txt": "intake", "large.txt": "intake", tmp_path.name: "intake"}
    assert outcomes["large.txt"].error_message == "File too large (100 bytes); max 50 bytes" and outcomes["large.txt"].document_id is None
    assert seen == [(1, 4, 0), (2, 4, 1), (3, 4, 1), (4, 4, 1)]
    with pytest.raises(ValueError):
        batch.run_uploads(spark, [])


def test_portal_order_and_parts(spark):
    rows = [(1, "n.txt", "d2", 1, "d2-1", 1, 1, None, "b"), (0, "n.txt", "d1", 2, "d1-2", 1, 2, "T", "é" * 400), (0, "n.txt", "d1", 1, "d1-1", 1, 1, None, "a"), (1, "n.txt", "d2", 2, "d2-2", 1, 1, None, "c")]
    chunks = spark.createDataFrame(rows, "file_idx int, source_filename string, document_id string, chunk_index int, chunk_id string, page_start int, page_end int, section_title string, chunk_text string").repartition(3)
    got = export.portal_files(chunks, 400).orderBy("file_index").collect()
    assert [r.file_index for r in got] == list(range(len(got))) and [r.chunk_id for r in got if r.part == 1] == ["d1-1", "d1-2", "d2-1", "d2-2"]
    assert got[0].name == "00000_n_p1-1_c0001.txt" and got[1].name.endswith(f"_c0002_part01of{got[1].parts:02d}.txt") and got[1].parts > 2
    assert all(len(r.body.encode()) <= 400 for r in got)
    assert "".join(r.body.split("\n", 6)[-1] for r in got if r.chunk_id == "d1-2") == "é" * 400
    small = [x for p in (260, 300) for x in export.portal_parts("w" * 1000, p, lambda k, n: "#" * 150 + f"{k} {n}\n")]
    assert all(len(x) <= 300 for x in small) and sum(x.count("w") for x in small) == 2000
    with pytest.raises(ValueError):
        export.portal_parts("w", 200, lambda k, n: "#" * 150)


def test_exports_of_records_and_for_spreadsheets(spark, tmp_path):
    record = spark.createDataFrame([("d", "f.txt", "txt", "d-1", 1, 1, None, "unknown", "parse", 1.0, "a\x00b\x01", "2024-01-01")], "document_id string, source_filename string, original_file_type string, chunk_id string, page_start int, page_end int, section_title string, detected_document_type string, extraction_method string, extraction_confidence double, chunk_text string, processing_timestamp string")
    table = export.ingestion_from_records(record.withColumn("processing_timestamp", F.to_timestamp("processing_timestamp")))
    r = table.first()
    assert tuple(table.columns) == export.INGESTION and (r.chunk_text, r.extraction_mode, r.chunk_quality_score, r.document_needs_review) == ("ab\x01", "native", 0.0, False)
    export.write_csv(table, str(tmp_path / "c"), bom=True)
    text = next((tmp_path / "c").glob("part-*")).read_bytes()
    assert text.startswith(b"\xef\xbb\xbfdocument_id,source_filename") and b"\x01" not in text
    book = export.xlsx_bytes(["x"], iter([("a\x01\ufffeb",)]))
    assert formats.xlsx_text(book) == "## Sheet: chunks\nx\nab"
    with pytest.raises(ValueError):
        old, export.SHEET_ROWS = export.SHEET_ROWS, 3
        try:
            export.xlsx_bytes(["x"], iter([("a",)] * 3))
        finally:
            export.SHEET_ROWS = old


def test_workbook_values():
    sheet = f'<worksheet xmlns="{formats._S[1:-1]}"><sheetData><row>' + "".join(f'<c s="{s}"><v>{v}</v></c>' for s, v in ((0, "5"), (0, "1.10"), (0, "1E3"), (1, "45292"), (1, "45292.5"), (2, "0.25"), (3, "1.5"), (4, "2"), (1, "59"))) + '<c t="b"><v>1</v></c><c t="e"><v>#N/A</v></c></row></sheetData></worksheet>'
    styles = f'<styleSheet xmlns="{formats._S[1:-1]}"><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm"/><numFmt numFmtId="165" formatCode="[h]:mm"/><numFmt numFmtId="166" formatCode="0.00&quot;d&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/><xf numFmtId="166"/></cellXfs></styleSheet>'
    book = export.xlsx_bytes(["x"], iter([]))
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(book)) as a, zipfile.ZipFile(out, "w") as b:
        for n in a.namelist():
            b.writestr(n, sheet if n.endswith("sheet1.xml") else styles if n.endswith("styles.xml") else a.read(n))
    cells = formats.xlsx_text(out.getvalue()).split("\n")[1].split("\t")
    assert cells == ["5", "1.1", "1000.0", "2024-01-01 00:00:00", "2024-01-01 12:00:00", "06:00:00", "1 day, 12:00:00", "2", "1900-02-28 00:00:00", "True", "#N/A"]


def test_report_and_zip(spark, folder, tmp_path):
    out = tmp_path / "out"
    got = batch.run(spark, str(folder), str(out), ("jsonl", "txt"), cfg=CFG)
    report = json.loads((out / "processing_report.json").read_text())
    assert report["summary"]["files_submitted"] == 9 and report["summary"]["failures"] == 2 and report["summary"]["chunks_created"] == got.artifacts["rows"]
    assert report["portal_txt"]["txt_files"] == got.artifacts["portal_txt"]["files_written"] > 0 and len(report["summary"]["per_file"]) == 9
    meta = batch.job_metadata(got, report["input_files"], IntakeLimits(), ("jsonl", "txt"))
    assert meta["pipeline"]["chunk_sizing"]["max_words"] == 120 and not meta["include_xlsx"]
    with zipfile.ZipFile(export.zip_outputs(str(out), str(tmp_path / "job.zip"), {"job_metadata.json": meta})) as z:
        names = z.namelist()
    assert "job_metadata.json" in names and "output/run_manifest.json" in names and any(n.startswith("output/portal_txt/00000_a_p1-1_c0001") for n in names)


def test_run(spark, folder, tmp_path):
    out = tmp_path / "out"
    got = batch.run(spark, str(folder), str(out), ("jsonl", "csv", "xlsx", "txt"), cfg=CFG, portal_bytes=4096)
    per_file = {r["source_filename"]: r for r in json.loads((out / "per_file_results.json").read_text())}
    assert list(per_file) == sorted(per_file) and [k for k, r in per_file.items() if not r["success"]] == ["b.pdf", "g.zzz"] and per_file["b.pdf"]["failure_stage"] == "extract"
    assert per_file["e.txt"]["success"] and per_file["e.txt"]["chunks_created"] == 0
    rows = {r.source_filename: r for r in got.rows.collect()}
    assert rows["a.txt"].section_title == "SECTION 09 62 29 - CORK" and rows["c.docx"].section_title == "One / Two" and rows["d.csv"].chunk_text == "x y\nfoo bar"
    assert rows["f.pdf"].percent_empty_pages == 50.0 and "�" in rows["h.txt"].chunk_text
    lines = [json.loads(x) for p in (out / "chunks.jsonl").glob("part-*") for x in p.read_text().splitlines()]
    assert len(lines) == len(rows) and list(lines[0]) == list(export.INGESTION) and lines[0]["processing_timestamp"].endswith("+00:00")
    head = next(p for p in (out / "chunks.csv").glob("part-*") if p.read_text()).read_text().splitlines()[0]
    assert head == ",".join(export.INGESTION)
    assert formats.xlsx_text((out / "chunks.xlsx").read_bytes()).startswith("## Sheet: chunks\ndocument_id")
    assert all(len(p.read_bytes()) <= 4096 for p in (out / "portal_txt").iterdir())
    manifest = json.loads((out / "run_manifest.json").read_text())
    assert manifest["files_seen"] == 9 and manifest["rows"] == len(rows) and len(manifest["errors"]) == 2
    master = [json.loads(x) for p in (out / "master.jsonl").glob("part-*") for x in p.read_text().splitlines()]
    assert list(master[0]) == list(export.MASTER) and {m["section_number"] for m in master if m["source_spec"] == "a"} == {"09 62 29"}


def test_limits(spark, folder):
    got = files.intake(files.read_files(spark, files.collect_paths(str(folder))), IntakeLimits(15, frozenset({".txt", ".csv"})))
    errors = {r.source_filename: r.error for r in got.collect()}
    assert errors["a.txt"].startswith("File too large (") and errors["g.zzz"] == "Extension '.zzz' not in allowed set" and errors["d.csv"] is None


def test_stream(spark, folder, tmp_path):
    from loomdoc.streaming.ingest import watch

    for _ in range(2):  # the second run finds nothing new
        watch(spark, str(folder), str(tmp_path / "s"), str(tmp_path / "ck"), CFG).awaitTermination()
    assert {r.source_filename for r in spark.read.parquet(str(tmp_path / "s" / "chunks")).collect()} == {"a.txt", "c.docx", "d.csv", "f.pdf", "h.txt"}
    assert spark.read.parquet(str(tmp_path / "s" / "outcomes")).filter("not success").count() == 2


def test_cli(spark, folder, tmp_path, capsys):
    from loomdoc.cli import main

    assert main(["run", str(folder), "--out", str(tmp_path / "o"), "--formats", "jsonl"]) == 0
    assert "b.pdf: [extract]" in capsys.readouterr().out
