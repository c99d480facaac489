"""Export schemas and sinks: delimited files, JSON lines, spreadsheets, portal text files, the slim master table."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from pathlib import Path
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomdoc.config import PORTAL_BYTES
from loomdoc.functions.text import excel_cell, preview, safe_stem, section_number, source_spec, strip, strip_control, strip_nul
from loomdoc.storage import cut

# Column orders that readers rely on.
INGESTION = ("document_id", "source_filename", "original_file_type", "chunk_id", "page_start", "page_end", "section_title", "document_type", "extraction_method", "extraction_confidence", "extraction_mode", "ocr_used", "ocr_confidence", "percent_empty_pages", "section_detection_confidence", "chunk_quality_score", "low_quality_chunk", "document_needs_review", "chunk_text", "processing_timestamp")
MASTER = ("source_file", "source_spec", "section_number", "section_title", "chunk_id", "chunk_text", "page_start", "page_end", "extraction_method")
TITLE_CHARS = 4000


def ingestion(chunks: DataFrame, timestamp: Column | None = None, semantic_type: Column | None = None) -> DataFrame:
    """The 20 columns of the ingestion export; a title over 4000 characters is cut, not an error of the whole batch."""
    clean = lambda c: strip(strip_nul(F.col(c)))
    when = timestamp if timestamp is not None else F.current_timestamp()
    return chunks.select(
        "document_id", clean("source_filename").alias("source_filename"), F.col("document_type").alias("original_file_type"), "chunk_id", "page_start", "page_end",
        F.substring(clean("section_title"), 1, TITLE_CHARS).alias("section_title"), (semantic_type if semantic_type is not None else F.lit("unknown")).alias("document_type"),
        F.col("extracted_method").alias("extraction_method"), F.col("confidence").alias("extraction_confidence"), "extraction_mode", "ocr_used", "ocr_confidence", "percent_empty_pages",
        "section_detection_confidence", "chunk_quality_score", "low_quality_chunk", "document_needs_review", clean("chunk_text").alias("chunk_text"), when.alias("processing_timestamp"),
    )


def master(chunks: DataFrame) -> DataFrame:
    return chunks.select(F.col("source_filename").alias("source_file"), source_spec(F.col("source_filename")).alias("source_spec"), section_number(F.col("section_title")).alias("section_number"), "section_title", "chunk_id", "chunk_text", "page_start", "page_end", F.col("extracted_method").alias("extraction_method"))


def _stamped(df: DataFrame) -> DataFrame:
    if "processing_timestamp" not in df.columns:
        return df
    return df.withColumn("processing_timestamp", F.date_format("processing_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One object a line, nulls written, in part files."""
    _stamped(df).write.mode(mode).option("ignoreNullFields", "false").json(path)


def ingestion_from_records(records: DataFrame) -> DataFrame:
    """The ingestion columns of canonical export records, which know nothing of quality: its columns take their defaults.

    records: document_id, source_filename, original_file_type, chunk_id, page_start, page_end, section_title,
    detected_document_type, extraction_method, extraction_confidence, chunk_text, processing_timestamp.
    """
    defaults = {"extraction_mode": F.lit("native"), "ocr_used": F.lit(False), "ocr_confidence": F.lit(None).cast("double"), "percent_empty_pages": F.lit(0.0), "section_detection_confidence": F.lit(None).cast("double"), "chunk_quality_score": F.lit(0.0), "low_quality_chunk": F.lit(False), "document_needs_review": F.lit(False)}
    return records.withColumns({**defaults, "document_type": F.col("detected_document_type"), "chunk_text": strip_nul(F.col("chunk_text"))}).select(*INGESTION)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", line_end: str = "\n", bom: bool = False) -> None:
    """Quoted where needed, quotes doubled, null as nothing, True and False as words, no control characters in texts.

    bom: a byte-order mark before the header of each part, for spreadsheets.
    """
    text = {c for c in df.columns if c in ("section_title", "chunk_text")}
    cols = [F.initcap(F.col(c).cast("string")).alias(c) if t == "boolean" else strip_control(F.col(c)).alias(c) if c in text else F.col(c) for c, t in _stamped(df).dtypes]
    out = _stamped(df).select(*cols)
    if bom:
        out = out.withColumnRenamed(out.columns[0], "\ufeff" + out.columns[0])
    out.write.mode(mode).options(header=True, quote='"', escape='"', emptyValue="", nullValue="", lineSep=line_end, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


#: What XML can't hold, and the rows of a sheet (a fixed value).
_NOT_XML = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ud800-\udfff\ufffe\uffff]")
SHEET_ROWS = 1_048_576


def xlsx_bytes(columns: list[str], rows: Iterator) -> bytes:
    """A workbook of one sheet named chunks, its header bold, cells as inline strings or numbers."""

    def cell(v, style: str = "") -> str:
        if v is None:
            return f"<c{style}/>"
        if isinstance(v, bool):
            return f'<c t="b"{style}><v>{int(v)}</v></c>'
        if isinstance(v, (int, float)):
            return f"<c{style}><v>{v}</v></c>"
        return f'<c t="inlineStr"{style}><is><t xml:space="preserve">{escape(re.sub(_NOT_XML, "", str(v)))}</t></is></c>'

    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/></Types>')
        z.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook {ns} xmlns:r="{rel}"><sheets><sheet name="chunks" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{rel}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<?xml version="1.0"?><styleSheet {ns}><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>')
        with z.open("xl/worksheets/sheet1.xml", "w") as sheet:
            sheet.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet {ns}><sheetData><row>'.encode())
            sheet.write("".join(cell(c, ' s="1"') for c in columns).encode() + b"</row>")
            for n, r in enumerate(rows, 2):
                if n > SHEET_ROWS:
                    raise ValueError(f"a sheet holds {SHEET_ROWS} rows; write another format")
                sheet.write(("<row>" + "".join(map(cell, r)) + "</row>").encode())
            sheet.write(b"</sheetData></worksheet>")
    return out.getvalue()


def write_xlsx(df: DataFrame, path: str) -> None:
    """A single workbook, for result sets that a spreadsheet can hold; rows stream through the driver."""
    safe = [excel_cell(F.col(c)).alias(c) if c in ("section_title", "chunk_text") else F.col(c) for c in _stamped(df).columns]
    data = xlsx_bytes(df.columns, _stamped(df).select(*safe).toLocalIterator())
    with open(path, "wb") as f:
        f.write(data)


def split_utf8(data: bytes, most: int) -> list[bytes]:
    """Parts of at most most bytes (64 at least), cut between characters."""
    if most < 64:
        raise ValueError("a part has 64 bytes at least")
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + most)
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        parts.append(data[at:end])
        at = end
    return parts or [b""]


# Fixed format: the lines before a portal file's text.
def portal_header(chunk_id: str, source: str, start: int, stop: int, title: str | None, part: int = 1, of: int = 1) -> str:
    lines = [f"# chunk_id: {chunk_id}", f"# source: {source}", f"# pages: {start}-{stop}"]
    if title:
        title = title.replace("\n", " ").strip()
        lines.append(f"# section: {title if len(title) <= 500 else title[:497] + '...'}")
    if of > 1:
        lines.append(f"# split_part: {part} of {of}")
    return "\n".join(["# chunk text export (UTF-8)", *lines, ""])


def portal_parts(text: str, most: int, header) -> list[str]:
    """A chunk's files of at most most bytes, header(part, of) before each; no byte of the text is left out.

    A part's text has what is left beside the header and 64 bytes, but 256 bytes where the file has room for them.
    """
    data = text.encode()
    worst = len(header(10**6, 10**6).encode())
    body = max(min(256, most - worst), most - len(header(1, 2).encode()) - 64)
    if body < 64:
        raise ValueError(f"files of {most} bytes have no room for the header and 64 bytes of text")
    parts = split_utf8(data, body)
    return [header(k, len(parts)) + p.decode() for k, p in enumerate(parts, 1)]


def portal_files(chunks: DataFrame, most: int = PORTAL_BYTES) -> DataFrame:
    """file_index (from 0), chunk_id, part, parts, name, body: the text files of chunks in order, none over most bytes.

    Chunks are in the order of their files (file_idx, where there is one, then name), documents and chunk_index. Parts
    are made in Python, as bytes are counted, once, and written; their running number is the number in a range of the
    order beside the numbers of the ranges before, so that no task gets all rows.
    """

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                title = None if pd.isna(r.section_title) else r.section_title
                bodies = portal_parts(r.chunk_text, most, lambda k, n: portal_header(r.chunk_id, r.source_filename, r.page_start, r.page_end, title, k, n))
                out += [(r.file_idx, r.source_filename, r.document_id, r.chunk_index, r.chunk_id, r.page_start, r.page_end, k, len(bodies), x) for k, x in enumerate(bodies, 1)]
            yield pd.DataFrame(out, columns=["file_idx", "source_filename", "document_id", "chunk_index", "chunk_id", "page_start", "page_end", "part", "parts", "body"])

    place = F.coalesce(F.col("file_idx"), F.lit(0)) if "file_idx" in chunks.columns else F.lit(0)
    cols = chunks.select(place.cast("int").alias("file_idx"), "source_filename", "document_id", "chunk_index", "chunk_id", "page_start", "page_end", strip_control(F.col("section_title")).alias("section_title"), strip_control(F.col("chunk_text")).alias("chunk_text"))
    order = ("file_idx", "source_filename", "document_id", "chunk_index", "part")
    files = cols.mapInPandas(split, "file_idx int, source_filename string, document_id string, chunk_index int, chunk_id string, page_start int, page_end int, part int, parts int, body string")
    ranged = cut(files.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("p", F.spark_partition_id()).withColumn("i", F.monotonically_increasing_id()))
    counts = ranged.groupBy("p").agg(F.count("*").alias("n"), F.count_if(F.col("part") == 1).alias("c"))
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("cbase"))
    within = Window.partitionBy("p").orderBy("i")
    numbered = ranged.join(base, "p").withColumn("file_index", F.col("base") + F.row_number().over(within) - 1).withColumn("seq", F.col("cbase") + F.sum((F.col("part") == 1).cast("int")).over(within))
    name = F.concat(F.format_string("%05d_%s_p%d-%d_c%04d", "file_index", safe_stem(F.col("source_filename")), "page_start", "page_end", "seq"), F.when(F.col("parts") > 1, F.format_string("_part%02dof%02d", "part", "parts")).otherwise(""), F.lit(".txt"))
    return numbered.select("file_index", "chunk_id", "part", "parts", name.alias("name"), "body")


def preview_text(df: DataFrame, limit: int = 3, chars: int = 120) -> str:
    """A few rows of an ingestion table for people, texts cut."""
    rows = df.select("document_id", "source_filename", "chunk_id", "page_start", "page_end", "document_type", preview(F.col("chunk_text"), chars).alias("t")).limit(limit).collect()
    lines = ["document_id | source_filename | chunk_id | pages | document_type | chunk_text…", "-" * 72]
    lines += [f"{r.document_id[:12]}… | {r.source_filename[:24]} | {r.chunk_id[-16:]} | {r.page_start}-{r.page_end} | {r.document_type} | {r.t}" for r in rows]
    more = df.count() - len(rows)
    return "\n".join([*lines, f"… and {more} more row(s)."] if more > 0 else lines)


def processing_report(job_id: str, manifest: dict, per_file: list[dict], names: list[str], finished_at: str, warnings: list[str] = ()) -> dict:
    """The report of a job for those who sent its files: what became of each, quality, and the portal's files."""
    portal = manifest.get("portal_txt") or {"files_written": 0, "max_bytes_per_file": PORTAL_BYTES, "directory": None}
    return {
        "job_id": job_id, "schema": "processing_report_v3", "started_at": manifest["started_at"], "finished_at": finished_at, "input_files": names,
        "summary": {"files_submitted": len(names), "files_processed_ok": max(0, manifest["files_seen"] - len(manifest["errors"])), "failures": len(manifest["errors"]), "chunks_created": manifest["rows"], "errors": manifest["errors"], "per_file": per_file},
        "quality_summary": manifest["quality_summary"], "warnings": list(warnings),
        "portal_txt": {"txt_files": portal["files_written"], "max_bytes_per_txt": portal["max_bytes_per_file"], "directory": portal["directory"]},
    }


def zip_outputs(folder: str, target: str, extra: dict[str, dict] | None = None) -> str:
    """A ZIP of a run's folder under output/, in order of names, and JSON files beside it; returns its path."""
    root = Path(folder)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*")):
            if f.is_file() and not f.name.startswith((".", "_")):
                z.write(f, f"output/{f.relative_to(root).as_posix()}")
        for name, value in (extra or {}).items():
            z.writestr(name, json.dumps(value, ensure_ascii=False, indent=2, default=str))
    return target


def write_json(path: str, value) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=2, default=str)
