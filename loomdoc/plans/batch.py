"""A run over files: intake, extraction, sections, chunks, quality, outcomes, artifacts and a manifest."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdoc.config import PORTAL_BYTES, ChunkingConfig, IntakeLimits
from loomdoc.operators import chunking, export, quality, sections
from loomdoc.operators.ocr import default_provider
from loomdoc.sources import files as source
from loomdoc.storage import cut

FORMATS = ("jsonl", "csv", "xlsx", "txt")


@dataclass
class BatchResult:
    run_id: str
    started_at: str
    rows: DataFrame
    outcomes: DataFrame
    config: ChunkingConfig
    portal_bytes: int = PORTAL_BYTES
    artifacts: dict = field(default_factory=dict)


def process(files: DataFrame, cfg: ChunkingConfig = ChunkingConfig(), limits: IntakeLimits = IntakeLimits(), provider=default_provider, enrich=None) -> tuple[DataFrame, DataFrame]:
    """Chunk rows and outcomes of files. Repeated files (same bytes and name) are one document.

    What is decoded, pages, sections and raw chunks are written as the plan is made, so each file is decoded once; the
    rows and outcomes returned are read from there. Serves streams' batches too.
    """
    taken = source.intake(files, limits)
    names = cut(taken.drop("content"))
    one = taken.filter("error is null").dropDuplicates(["document_id"])
    pages, blocks, errors = source.extract(one, provider)
    docs = quality.document_summary(pages)
    chunks = chunking.chunk_documents(pages, sections.detect_sections(pages, blocks), cfg)
    rows = quality.with_quality(chunks, docs, cfg.min_words)
    first = names.filter("error is null").groupBy("document_id").agg(*(F.min_by(c, F.coalesce("file_idx", F.lit(0))).alias(c) for c in ("source_filename", "source_sha256", "kind", "file_idx")))
    rows = rows.join(first.withColumnRenamed("kind", "document_type"), "document_id").withColumn("schema_version", F.lit("3"))
    if enrich:
        rows = rows.transform(enrich)
    made = rows.groupBy("document_id").agg(F.count("*").alias("chunks_created"))
    outcomes = (
        names.select("file_idx", "source_filename", "document_id", F.col("error").alias("intake_error"))
        .join(errors, "document_id", "left").join(made, "document_id", "left")
        .select(
            "file_idx", "source_filename", "document_id", F.coalesce("intake_error", "error").isNull().alias("success"),
            F.when(F.coalesce("intake_error", "error").isNull(), F.coalesce("chunks_created", F.lit(0))).otherwise(0).alias("chunks_created"),
            F.when(F.col("intake_error").isNotNull(), "intake").when(F.col("error").isNotNull(), "extract").alias("failure_stage"),
            F.coalesce("intake_error", "error").alias("error_message"),
        )
    )
    return rows, outcomes


def run(spark: SparkSession, path: str, out_dir: str | None = None, formats=("jsonl", "csv", "txt"), recursive: bool = False, cfg: ChunkingConfig = ChunkingConfig(), limits: IntakeLimits = IntakeLimits(), provider=default_provider, portal_bytes: int = PORTAL_BYTES, on_file_done: Callable[[int, int, int], None] | None = None) -> BatchResult:
    """Run over a file or folder; with out_dir, artifacts are written there."""
    return run_paths(spark, source.collect_paths(path, recursive), path, out_dir, formats, cfg, limits, provider, portal_bytes, on_file_done)


def run_uploads(spark: SparkSession, paths: list[str], out_dir: str | None = None, **settings) -> BatchResult:
    """Run over files handed in one by one, in their order; none is an error."""
    if not paths:
        raise ValueError("no input files")
    return run_paths(spark, list(paths), ", ".join(os.path.basename(p) for p in paths), out_dir, **settings)


def run_paths(spark: SparkSession, paths: list[str], shown: str, out_dir: str | None = None, formats=("jsonl", "csv", "txt"), cfg: ChunkingConfig = ChunkingConfig(), limits: IntakeLimits = IntakeLimits(), provider=default_provider, portal_bytes: int = PORTAL_BYTES, on_file_done: Callable[[int, int, int], None] | None = None) -> BatchResult:
    """Run over files in the order given; shown: what the manifest calls the input.

    on_file_done gets files done, files in all and chunks so far, for each file in order. Files are done together, so
    the calls come when all are.
    """
    formats = {"xlsx" if f == "excel" else f for f in formats}
    if formats - set(FORMATS):
        raise ValueError(f"unknown formats: {sorted(formats - set(FORMATS))}")
    started = datetime.now(timezone.utc)
    rows, outcomes = process(source.read_files(spark, paths, limits=limits), cfg, limits, provider)
    result = BatchResult(str(uuid.uuid4()), started.isoformat(), rows, outcomes, cfg, portal_bytes)
    if on_file_done:
        so_far = 0
        for n, r in enumerate(outcomes.select("file_idx", "chunks_created").orderBy("file_idx").toLocalIterator(), 1):
            so_far += r.chunks_created
            on_file_done(n, len(paths), so_far)
    if out_dir:
        write_artifacts(spark, result, shown, out_dir, formats)
    return result


def write_artifacts(spark: SparkSession, result: BatchResult, path: str, out_dir: str, formats: set[str]) -> dict:
    """Exports in the formats, the master table, outcomes, the manifest and the report.

    Chunks are written to the shared folder once and read again by each. Lists of files go through the driver, as the
    reports for people that they are.
    """
    os.makedirs(out_dir, exist_ok=True)
    at = lambda name: os.path.join(os.path.abspath(out_dir), name)
    rows = cut(result.rows)
    table = export.ingestion(rows.orderBy("file_idx", "document_id", "chunk_index"), F.lit(result.started_at).cast("timestamp"))
    if "jsonl" in formats:
        export.write_jsonl(table, at("chunks.jsonl"))
    if "csv" in formats:
        export.write_csv(table, at("chunks.csv"))
    if "xlsx" in formats:
        export.write_xlsx(table, at("chunks.xlsx"))
    portal = None
    if "txt" in formats:
        portal = write_portal(export.portal_files(rows, result.portal_bytes), at("portal_txt"))
    n = rows.count()
    if n:
        export.write_jsonl(export.master(rows), at("master.jsonl"))
        export.write_csv(export.master(rows), at("master.csv"), line_end="\r\n")
    per_file = [r.asDict() for r in result.outcomes.orderBy("file_idx").toLocalIterator()]
    failed = [r for r in per_file if not r["success"]]
    summary = quality.job_summary(rows).first().asDict()
    if not n:
        summary.pop("fraction_low_quality")
    errors = [{"stage": r["failure_stage"], "message": r["error_message"], "source_filename": r["source_filename"], "document_id": r["document_id"], "detail": None} for r in failed]
    finished = datetime.now(timezone.utc).isoformat()
    manifest = {"run_id": result.run_id, "created_at": finished, "started_at": result.started_at, "input": path, "out_dir": out_dir, "formats": sorted(formats), "files_seen": len(per_file), "rows": n, "quality_summary": summary, "errors": errors}
    if portal is not None:
        manifest["portal_txt"] = {"files_written": portal, "max_bytes_per_file": result.portal_bytes, "directory": at("portal_txt")}
    outcomes = [{k: r[k] for k in ("source_filename", "success", "document_id", "chunks_created", "failure_stage", "error_message")} for r in per_file]
    if per_file:
        export.write_json(at("per_file_results.json"), outcomes)
    export.write_json(at("errors_report.json"), {"run_id": result.run_id, "failure_count": len(failed), "errors": errors})
    export.write_json(at("run_manifest.json"), manifest)
    export.write_json(at("processing_report.json"), export.processing_report(result.run_id, manifest, outcomes, [r["source_filename"] for r in per_file], finished))
    result.artifacts = manifest
    return manifest


def job_metadata(result: BatchResult, names: list[str], limits: IntakeLimits, formats) -> dict:
    """The settings that a job ran with."""
    return {"job_id": result.run_id, "created_at": datetime.now(timezone.utc).isoformat(), "input_files": names, "include_xlsx": "xlsx" in formats, "portal_txt_files": (result.artifacts.get("portal_txt") or {}).get("files_written", 0), "pipeline": {"intake_max_bytes": limits.max_bytes, "chunk_sizing": asdict(result.config), "portal_txt_max_bytes": result.portal_bytes}}


def write_portal(parts: DataFrame, folder: str) -> int:
    """One file a row, streamed through the driver, as names and folders are for people; returns their number."""
    os.makedirs(folder, exist_ok=True)
    n = 0
    for r in parts.select("name", "body").toLocalIterator():
        with open(os.path.join(folder, r["name"]), "w", encoding="utf-8", newline="") as f:
            f.write(r["body"])
        n += 1
    return n
