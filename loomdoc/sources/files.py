"""Files as tables: intake with limits, extraction by kind, a file's failure as a row.

Small listings come from the driver, as Spark's binaryFile leaves out empty files and names that begin with an
underscore; stores that only Spark reads go through binaryFile.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdoc.config import IntakeLimits, MIN_NATIVE_CHARS
from loomdoc.functions.text import base_name, document_id, document_kind, needs_ocr, normalize_whitespace
from loomdoc.operators.ocr import default_provider, recognise
from loomdoc.sources import formats
from loomdoc.storage import cut


def collect_paths(path: str, recursive: bool = False) -> list[str]:
    """A file by itself; a folder's regular files in order, without names that begin with a dot; nothing if it is missing."""
    p = Path(path)
    if p.is_file():
        return [str(p)]
    if not p.is_dir():
        return []
    return [str(x) for x in sorted(p.rglob("*") if recursive else p.iterdir()) if x.is_file() and not x.name.startswith(".")]


def read_files(spark: SparkSession, paths: list[str], partitions: int | None = None, limits: IntakeLimits = IntakeLimits()) -> DataFrame:
    """path, source_filename, content, byte_size, file_idx and read_error of files that every executor can open, in the order given.

    A file over the limit is not read, and one that can't be read is a row with the reason; both have no content.
    """
    rows = spark.createDataFrame([(i, os.path.abspath(p)) for i, p in enumerate(paths)], "file_idx int, path string").repartition(partitions or max(1, min(len(paths), spark.sparkContext.defaultParallelism)), "file_idx")

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, p in zip(b["file_idx"], b["path"], strict=True):
                data, n, error = None, None, None
                try:
                    n = os.path.getsize(p)
                    if not os.path.isfile(p):
                        error = f"Not a file: {p}"
                    elif limits.max_bytes is None or n <= limits.max_bytes:
                        with open(p, "rb") as f:
                            data = f.read()
                except OSError as e:
                    error = str(e)
                yield pd.DataFrame({"file_idx": [i], "path": [p], "content": [data], "byte_size": pd.array([n], "Int64"), "read_error": [error]})

    got = rows.mapInPandas(load, "file_idx int, path string, content binary, byte_size long, read_error string")
    return got.select("path", base_name(F.col("path")).alias("source_filename"), "content", "byte_size", "file_idx", "read_error")


def scan_store(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """The same columns from any store that Spark reads; file_idx is null."""
    got = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    return got.select("path", base_name(F.col("path")).alias("source_filename"), "content", F.col("length").alias("byte_size"), F.lit(None).cast("int").alias("file_idx"))


def intake(files: DataFrame, limits: IntakeLimits = IntakeLimits()) -> DataFrame:
    """files with document_id, source_sha256, kind and error; error is null, and the id isn't, for files that are taken.

    What is looked at, in this order: whether the file could be read, its size, its suffix.
    """
    suffix = F.lower(F.regexp_extract("source_filename", r"(?s)\A.+(\.[^.]+)\z", 1))
    error = F.lit(None).cast("string")
    if limits.allowed_suffixes is not None:
        error = F.when(~suffix.isin(*sorted(limits.allowed_suffixes)), F.concat(F.lit("Extension '"), suffix, F.lit("' not in allowed set")))
    if limits.max_bytes is not None:
        error = F.when(F.col("byte_size") > limits.max_bytes, F.concat(F.lit("File too large ("), F.col("byte_size"), F.lit(f" bytes); max {limits.max_bytes} bytes"))).otherwise(error)
    if "read_error" in files.columns:
        error = F.coalesce(F.col("read_error"), error)
    taken = files.withColumns({"kind": document_kind(F.col("source_filename")), "error": error})
    good = F.col("error").isNull()
    return taken.withColumns({"document_id": F.when(good, document_id(F.col("content"), F.col("source_filename"))), "source_sha256": F.when(good, F.sha2("content", 256))})


def _decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each page or block of files in binary formats; what can't be read is a row with an error."""
    for b in batches:
        out = []
        for doc, kind, path, data in zip(b["document_id"], b["kind"], b["path"], b["content"], strict=True):
            try:
                data = bytes(data)
                if kind == "csv":
                    out.append((doc, "page", 1, None, formats.csv_text(data), None))
                elif kind == "xlsx":
                    out.append((doc, "page", 1, None, formats.xlsx_text(data), None))
                elif kind == "docx":
                    out += [(doc, k, i, style, text, None) for i, k, style, text in formats.docx_blocks(data)]
                elif kind == "pdf":
                    out += [(doc, "pdf", i, None, text.strip(), None) for i, text in enumerate(formats.pdf_pages(data), 1)]
                elif kind == "image":
                    out.append((doc, "image", 1, None, "", None))
                else:
                    raise ValueError(f"Unsupported file type (kind='{kind}'): {path}")
            except Exception as e:  # one file's failure is a row; the batch goes on
                out.append((doc, "error", 0, None, None, str(e)))
        yield pd.DataFrame(out, columns=["document_id", "part", "n", "style_name", "text", "error"])


def extract(taken: DataFrame, provider=default_provider) -> tuple[DataFrame, DataFrame, DataFrame]:
    """pages, word-processor blocks and errors of files that intake accepted.

    Plain text is decoded inside the JVM, with replacement of invalid bytes; binary formats reach Python, each file
    once, and what they hold is written; only pages with little text, and images, reach the provider, whose pages are
    written too. Nothing of what follows reads a file again.
    """
    good = taken.filter("error is null")
    parse = [F.lit("parse").alias("method"), F.lit(1.0).alias("confidence")]
    text = good.filter("kind = 'txt'").select("document_id", F.lit(1).alias("page_number"), normalize_whitespace(F.expr("make_valid_utf8(cast(content as string))")).alias("text"), *parse)
    binary = good.filter("kind <> 'txt'")
    parts = cut(binary.select("document_id", "kind", "path", "content").mapInPandas(_decoded, "document_id string, part string, n int, style_name string, text string, error string"))
    tables = parts.filter("part = 'page'").select("document_id", F.col("n").alias("page_number"), normalize_whitespace(F.col("text")).alias("text"), *parse)
    blocks = parts.filter("part in ('heading', 'paragraph')").select("document_id", F.col("n").alias("order_index"), F.col("part").alias("kind"), "style_name", "text")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("order_index", "text"))), lambda p: p["text"]), "\n\n")
    errors = parts.filter("part = 'error'").select("document_id", "error")
    empty = good.filter("kind = 'docx'").select("document_id").join(parts.select("document_id").distinct(), "document_id", "left_anti")
    docx = blocks.groupBy("document_id").agg(whole.alias("text")).unionByName(empty.withColumn("text", F.lit(""))).select("document_id", F.lit(1).alias("page_number"), normalize_whitespace(F.col("text")).alias("text"), *parse)
    native = parts.filter("part in ('pdf', 'image')").select("document_id", F.col("n").alias("page_number"), F.col("part").alias("kind"), normalize_whitespace(F.col("text")).alias("text"))
    little = (F.col("kind") == "image") | needs_ocr(F.col("text"), MIN_NATIVE_CHARS)
    plain = native.filter(~little).select("document_id", "page_number", "text", *parse)
    pages = text.unionByName(tables).unionByName(docx).unionByName(plain)
    if not native.filter(little).isEmpty():
        pages = pages.unionByName(recognise(native.filter(little), binary, provider))
    return cut(pages), blocks, errors


def provenance(pages: DataFrame, taken: DataFrame) -> DataFrame:
    """Pages with the file's name and digest."""
    return pages.join(taken.select("document_id", "source_filename", "source_sha256"), "document_id")
