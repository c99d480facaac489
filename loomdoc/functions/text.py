"""Scalar functions on text: columns in, columns out, all inside the JVM.

White space is what Unicode says, as in Python, not the ASCII set of Java's patterns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: One white-space character.
WS = r"(?U)[\s\x1c-\x1f]"


def strip(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, rf"^{WS}+", ""), rf"{WS}+\z", "")


def normalize_whitespace(c: Column) -> Column:
    """Line ends to \\n, runs of blanks to one space, three or more line ends to two, no white space at the ends."""
    c = F.regexp_replace(c, "\r\n?", "\n")
    c = F.regexp_replace(c, "[ \t]+", " ")
    return strip(F.regexp_replace(c, "\n{3,}", "\n\n"))


def words(c: Column) -> Column:
    return F.filter(F.split(c, f"{WS}+"), lambda w: w != "")


def count_words(c: Column) -> Column:
    return F.size(words(c))


def join_words(ws: Column, start, count) -> Column:
    return F.array_join(F.slice(ws, start, count), " ")


def tail_words(c: Column, n: int) -> Column:
    """The last n words joined by spaces; a shorter text as it stands, without white space at its ends."""
    if n <= 0:
        return F.lit("")
    w = words(c)
    return F.when(F.size(w) > n, F.array_join(F.slice(w, -n, n), " ")).otherwise(strip(c))


def cap_words(c: Column, most) -> Column:
    """The first words joined by spaces; a shorter text as it stands, without white space at its ends."""
    w = words(c)
    most = F.lit(most) if isinstance(most, int) else most
    return F.when(F.size(w) > most, F.array_join(F.slice(w, 1, F.greatest(most, F.lit(0))), " ")).otherwise(strip(c))


def split_sentences(c: Column) -> Column:
    return F.filter(F.transform(F.split(strip(c), rf"(?<=[.!?]){WS}+"), strip), lambda s: s != "")


def non_whitespace_chars(c: Column) -> Column:
    return F.length(F.regexp_replace(c, f"{WS}+", ""))


def needs_ocr(c: Column, least: int) -> Column:
    return non_whitespace_chars(c) < least


def document_id(content: Column, name: Column) -> Column:
    """SHA-256 of the bytes, a bar and the name."""
    return F.sha2(F.concat(content.cast("binary"), F.lit(b"|"), F.encode(name, "utf-8")), 256)


def chunk_id(doc: Column, index: Column) -> Column:
    return F.format_string("%s-chunk-%04d", doc, index)


def legacy_chunk_id(doc: Column, seq: Column) -> Column:
    return F.format_string("%s:%06d", F.substring(doc, 1, 16), seq)


def extraction_mode(method: Column) -> Column:
    return F.when(method == "parse", "native").when(method == "ocr", "ocr").otherwise("hybrid")


def ocr_used(method: Column) -> Column:
    return method.isin("ocr", "hybrid")


def strip_control(c: Column) -> Column:
    """Without control characters below 32 but tab and line ends."""
    return F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")


def strip_nul(c: Column) -> Column:
    return F.replace(c, F.lit("\x00"), F.lit(""))


def excel_cell(c: Column) -> Column:
    """Text that a spreadsheet takes for a formula gets an apostrophe before it."""
    return F.when(c.rlike(r"\A(?:[=+\-@]|\t[=+])"), F.concat(F.lit("'"), c)).otherwise(c)


def preview(c: Column, most: int = 160) -> Column:
    one = strip(F.regexp_replace(c, f"{WS}+", " "))
    return F.when(F.length(one) <= most, one).otherwise(F.concat(F.substring(one, 1, most - 1), F.lit("…")))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*\z", 1)


def source_spec(path: Column) -> Column:
    """The file name without its last suffix; a name that begins with its only dot is kept."""
    name = base_name(path)
    return F.when(name.rlike(r".\.[^.]+\z"), F.regexp_replace(name, r"(?s)(.)\.[^.]+\z", "$1")).otherwise(name)


def section_number(title: Column) -> Column:
    """The first number like 09 65 00, else the first like 1.2.3, else null."""
    csi = F.regexp_replace(F.regexp_extract(title, r"(?U)\b(\d\d\s+\d\d\s+\d\d)\b", 1), f"{WS}+", " ")
    dotted = F.regexp_extract(title, r"(?U)\b(\d+(?:\.\d+)+)\b", 1)
    return F.coalesce(F.nullif(csi, F.lit("")), F.nullif(dotted, F.lit("")))


def safe_stem(path: Column, most: int = 48) -> Column:
    """A stem for file names: letters, digits, dots, dashes and single underscores."""
    s = F.regexp_replace(source_spec(path), r"[^\p{L}\p{N}._-]", "_")
    s = F.regexp_replace(F.regexp_replace(s, "_+", "_"), r"^[._]+|[._]+\z", "")
    return F.substring(F.when(s == "", "source").otherwise(s), 1, most)


def valid_sha256(c: Column) -> Column:
    """The digest in lower case without white space; null where it is none."""
    d = F.lower(strip(c))
    return F.when(d.rlike(r"\A[0-9a-f]{64}\z"), d)


def optional(c: Column) -> Column:
    """A cell of a delimited file: empty for null."""
    return F.coalesce(c.cast("string"), F.lit(""))


def document_kind(name: Column) -> Column:
    """Kind by the name's suffix, then by its MIME type."""
    import mimetypes

    # Suffixes of each kind.
    kinds = {"pdf": (".pdf",), "docx": (".docx",), "txt": (".txt", ".md", ".log"), "csv": (".csv", ".tsv"), "xlsx": (".xlsx", ".xlsm"), "image": (".png", ".jpg", ".jpeg", ".tif", ".tiff", ".webp")}
    suffix = F.lower(F.regexp_extract(base_name(name), r"(?s)\A.+(\.[^.]+)\z", 1))
    out = F.when(F.lit(False), "")
    for kind, ends in kinds.items():
        out = out.when(suffix.isin(*ends), kind)
    known = {e for ends in kinds.values() for e in ends}
    types = mimetypes.MimeTypes(filenames=()).types_map[True]
    for kind, prefix in (("txt", "text/"), ("image", "image/")):
        out = out.when(suffix.isin(*sorted(e for e, t in types.items() if t.startswith(prefix) and e not in known)), kind)
    return out.otherwise("unknown")
