"""Queries over files that are made from the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdoc.config import ChunkingConfig, IntakeLimits
from loomdoc.plans.batch import process
from loomdoc.sources import files as source
from loomdoc.storage import shared_dir

LIMIT = 20_000


def _files(df: DataFrame) -> DataFrame:
    """df (source_filename, content) with the other columns of a file table."""
    return df.select(F.concat(F.lit("/in/"), F.col("source_filename")).alias("path"), "source_filename", F.col("content").cast("binary").alias("content"), F.length(F.col("content").cast("binary")).cast("long").alias("byte_size"), F.lit(0).alias("file_idx"))


def csv_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A semicolon file for each region, through intake and extraction."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    rows = F.array_sort(F.collect_list(F.struct("n_nationkey", F.concat_ws(";", "n_nationkey", "n_name").alias("t"))))
    content = F.concat(F.lit("key;name\n"), F.array_join(F.transform(rows, lambda r: r["t"]), "\n"))
    made = n.groupBy("n_regionkey").agg(content.alias("content")).select(F.format_string("r%d.csv", "n_regionkey").alias("source_filename"), "content")
    taken = source.intake(_files(made))
    return source.extract(taken)[0].join(taken.select("document_id", "source_filename"), "document_id").select("source_filename", "page_number", "text", "method")


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    suffix = F.when(d % 10 == 3, ".bin").when(d % 10 == 7, ".pdf").otherwise(".txt")
    return _files(spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.concat(F.lit("d"), d, suffix).alias("source_filename"), F.col("text").alias("content")))


def per_file_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good files, files of unknown kind, files that are no PDF, files over the limit: one outcome each."""
    _, outcomes = process(_named(spark, sf_dir), ChunkingConfig(), IntakeLimits(max_bytes=LIMIT))
    return outcomes.select("source_filename", "document_id", "success", "failure_stage", "error_message")


def streaming_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of four text files, each with every fourth line, that a stream picks up from a folder."""
    from loomdoc.streaming.ingest import watch

    base = f"{shared_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    rows = F.array_sort(F.collect_list(F.struct("item_id", "text")))
    lines = spark.read.parquet(f"{sf_dir}/benchmark.parquet").groupBy((F.col("item_id") % 4).alias("n")).agg(F.array_join(F.transform(rows, lambda r: r["text"]), "\n").alias("text"))
    lines.repartitionByRange(4, "n").select("text").write.text(f"{base}/in")
    watch(spark, f"{base}/in", f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out/chunks").select("chunk_index", "total_chunks", "chunk_text", "chunk_word_count")


def queries():
    return {f.__name__: f for f in (csv_flatten, per_file_outcomes, streaming_ingest)}


def oracle_sql():
    from loomdoc.plans.queries import DEFAULT, _chunk_sql, _norm

    text = "string_agg(text, chr(10) ORDER BY item_id)"
    lines = _chunk_sql(DEFAULT, f"SELECT CAST(item_id % 4 AS VARCHAR) AS document_id, 'file' AS source_filename, {_norm(text)} AS text FROM benchmark GROUP BY item_id % 4")
    name = "'d' || doc_id || CASE WHEN doc_id % 10 = 3 THEN '.bin' WHEN doc_id % 10 = 7 THEN '.pdf' ELSE '.txt' END"
    return {
        "csv_flatten": "SELECT 'r' || n_regionkey || '.csv' AS source_filename, 1 AS page_number, 'key name' || chr(10) || string_agg(n_nationkey || ' ' || n_name, chr(10) ORDER BY n_nationkey) AS text, 'parse' AS method FROM nation GROUP BY n_regionkey",
        "streaming_ingest": f"WITH RECURSIVE {lines} SELECT chunk_index, total_chunks, chunk_text, chunk_word_count FROM chunks",
        "per_file_outcomes": f"""SELECT n AS source_filename, CASE WHEN stage = 'intake' THEN NULL ELSE sha256(text || '|' || n) END AS document_id, stage IS NULL AS success, stage AS failure_stage,
  CASE WHEN stage = 'intake' THEN 'File too large (' || strlen(text) || ' bytes); max {LIMIT} bytes' WHEN k = 3 THEN 'Unsupported file type (kind=''unknown''): /in/' || n WHEN stage = 'extract' THEN 'PDF can''t be read: no header or no objects' END AS error_message
FROM (SELECT text, {name} AS n, doc_id % 10 AS k, CASE WHEN strlen(text) > {LIMIT} THEN 'intake' WHEN doc_id % 10 IN (3, 7) THEN 'extract' END AS stage FROM documents)""",
    }
