"""Decoders of file formats with the standard library: delimited text, workbooks, word-processor files, simple PDF text."""

from __future__ import annotations

import csv
import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

from loomdoc.config import MAX_TABLE_ROWS

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def csv_text(content: bytes, max_rows: int = MAX_TABLE_ROWS) -> str:
    """Rows of a delimited file with tabs between cells; the delimiter is guessed from the first 4096 characters."""
    text = content.decode("utf-8-sig", errors="replace")
    try:
        dialect = csv.Sniffer().sniff(text[:4096], delimiters=",;\t|")
    except csv.Error:
        dialect = csv.excel
    lines = []
    for i, row in enumerate(csv.reader(io.StringIO(text, newline=""), dialect)):
        if i >= max_rows:
            lines.append(f"... truncated after {max_rows} data rows ...")
            break
        lines.append("\t".join(row))
    return "\n".join(lines)


def _column(ref: str) -> int:
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


# Numbers of built-in formats that show dates, times or spans of time.
_DATES, _SPANS = {*range(14, 23), 45, 47}, {46}


def _styles(z: zipfile.ZipFile) -> list[str]:
    """For each cell style whether it shows a date, a span of time or a number: date, span or an empty text."""
    if "xl/styles.xml" not in z.namelist():
        return []
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): f.get("formatCode") or "" for f in root.iter(f"{_S}numFmt")}

    def shows(n: int) -> str:
        if n not in own:
            return "span" if n in _SPANS else "date" if n in _DATES else ""
        code = re.sub(r'"[^"]*"|\\.|_.|\*.', "", own[n].split(";")[0])
        if re.search(r"\[(h+|m+|s+)\]", code, re.I):
            return "span"
        return "date" if re.search("[dmhys]", re.sub(r"\[[^\]]*\]", "", code).replace("General", ""), re.I) else ""

    xfs = root.find(f"{_S}cellXfs")
    return [shows(int(x.get("numFmtId") or 0)) for x in xfs] if xfs is not None else []


def _number(raw: str, shows: str, epoch: datetime) -> str:
    """A number as Python prints it: whole, with a fraction, or the date, time or span that its format shows."""
    value = float(raw) if set(raw) & set(".eE") else int(raw)
    if not shows:
        return str(value)
    days, part = divmod(value, 1)
    past = timedelta(milliseconds=round(part * 86_400_000))
    if shows == "span":
        return str(timedelta(days=days) + past)
    if 0 <= value < 1 and not past.days:
        return str((datetime.min + past).time())
    if 0 < value < 60 and epoch.year == 1899:  # the format's calendar has a 29th of February 1900
        days += 1
    return str(epoch + timedelta(days=days) + past)


def _sheet_rows(z: zipfile.ZipFile, name: str, shared: list[str], styles: list[str], epoch: datetime) -> Iterator[list[str]]:
    """Rows of a sheet, read as a stream; absent cells are empty, cached values stand for formulas."""
    with z.open(name) as f:
        for _, row in ElementTree.iterparse(f):
            if row.tag != f"{_S}row":
                continue
            cells: list[str] = []
            for c in row.iter(f"{_S}c"):
                at = _column(c.get("r", "")) if c.get("r") else len(cells)
                kind, v, style = c.get("t"), c.find(f"{_S}v"), int(c.get("s") or 0)
                if kind == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter(f"{_S}t"))
                elif v is None or v.text is None:
                    value = ""
                elif kind == "s":
                    value = shared[int(v.text)]
                elif kind == "b":
                    value = "True" if v.text == "1" else "False"
                elif kind in (None, "n"):
                    value = _number(v.text, styles[style] if style < len(styles) else "", epoch)
                else:
                    value = v.text
                cells += [""] * (at - len(cells)) + [value]
            yield cells
            row.clear()


def xlsx_text(content: bytes, max_rows: int = MAX_TABLE_ROWS) -> str:
    """Every sheet in order: a line with its name, then its rows that aren't blank, tabs between cells."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{_S}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall(f"{_S}si")]
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        out, styles, book = [], _styles(z), ElementTree.fromstring(z.read("xl/workbook.xml"))
        settings = book.find(f"{_S}workbookPr")
        epoch = datetime(1904, 1, 1) if settings is not None and settings.get("date1904") in ("1", "true") else datetime(1899, 12, 30)
        for sheet in book.iter(f"{_S}sheet"):
            name, target = sheet.get("name"), targets[sheet.get(f"{_R}id")]
            out.append(f"## Sheet: {name}")
            path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            for i, row in enumerate(_sheet_rows(z, path, shared, styles, epoch)):
                if i >= max_rows:
                    out.append(f"... truncated ({max_rows} rows max) in sheet '{name}' ...")
                    break
                if any(c.strip() for c in row):
                    out.append("\t".join(row))
    return "\n".join(out)


def docx_blocks(content: bytes) -> list[tuple[int, str, str | None, str]]:
    """Order, kind (heading or paragraph), style name and text of the body's paragraphs that have text; tables are left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        styles = {}
        if "word/styles.xml" in z.namelist():
            for s in ElementTree.fromstring(z.read("word/styles.xml")).iter(f"{_W}style"):
                n = s.find(f"{_W}name")
                styles[s.get(f"{_W}styleId")] = n.get(f"{_W}val") if n is not None else None
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    out = []
    for p in body.findall(f"{_W}p"):
        parts = []
        for x in p.iter():
            if x.tag == f"{_W}t":
                parts.append(x.text or "")
            elif x.tag in (f"{_W}br", f"{_W}cr"):
                parts.append("\n")
            elif x.tag == f"{_W}tab":
                parts.append("\t")
        text = "".join(parts).strip()
        if not text:
            continue
        ref = p.find(f"{_W}pPr/{_W}pStyle")
        style = styles.get(ref.get(f"{_W}val"), ref.get(f"{_W}val")) if ref is not None else "Normal"
        out.append((len(out), "heading" if "heading" in (style or "").lower() else "paragraph", style, text))
    return out


_OBJ = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)endobj", re.S)
_STRING = re.compile(rb"\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>|\bT\*|\bT[dDmjJ]\b|'|\"|\bET\b", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _pdf_string(raw: bytes) -> str:
    if raw[:1] == b"<":
        data = bytes.fromhex((h := re.sub(rb"\s", b"", raw[1:-1]).decode()) + "0" * (len(h) % 2))
    else:
        data = re.sub(rb"\\([0-7]{1,3}|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1][:1].isdigit() else _ESCAPES.get(m[1], m[1]), raw[1:-1], flags=re.S)
    return data[2:].decode("utf-16-be", "replace") if data[:2] == b"\xfe\xff" else data.decode("latin-1")


def pdf_pages(content: bytes) -> list[str]:
    """Text of each page: by PyMuPDF where it is installed, else of files with plain or deflated text streams.

    Raises ValueError for what is no such file.
    """
    try:
        import fitz
    except ImportError:
        return _plain_pdf_pages(content)
    try:
        with fitz.open(stream=content, filetype="pdf") as doc:
            return [page.get_text("text") for page in doc]
    except Exception as e:
        raise ValueError(f"PDF can't be read: {e}") from e


def _plain_pdf_pages(content: bytes) -> list[str]:
    if not content.startswith(b"%PDF-") or b"endobj" not in content:
        raise ValueError("PDF can't be read: no header or no objects")
    objects = {int(m[1]): m[2] for m in _OBJ.finditer(content)}

    def stream(body: bytes) -> bytes:
        m = re.search(rb"stream\r?\n(.*?)\r?\n?endstream", body, re.S)
        if not m:
            return b""
        return zlib.decompress(m[1]) if b"FlateDecode" in body.split(b"stream", 1)[0] else m[1]

    pages = [b for b in objects.values() if re.search(rb"/Type\s*/Page\b", b)]
    if not pages:
        raise ValueError("PDF can't be read: no pages in plain objects")
    out = []
    for page in pages:
        m = re.search(rb"/Contents\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", page)
        refs = [int(n) for n in re.findall(rb"(\d+)\s+\d+\s+R", m[1])] if m else []
        text = []
        for t in _STRING.findall(b"\n".join(stream(objects.get(r, b"")) for r in refs)):
            if t[:1] in b"(<":
                text.append(_pdf_string(t))
            elif t in (b"T*", b"Td", b"TD", b"Tm", b"'", b'"', b"ET"):
                text.append("\n")
        out.append(re.sub("\n+", "\n", "".join(text)).strip())
    return out
