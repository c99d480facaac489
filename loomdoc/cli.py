"""python -m loomdoc run INPUT --out DIR --formats jsonl,csv,txt"""

from __future__ import annotations

import argparse
import logging

from loomdoc.config import ChunkingConfig


def session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("loomdoc").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    """Exit status 0 even when files fail; their errors are printed and reported."""
    p = argparse.ArgumentParser(prog="loomdoc")
    r = p.add_subparsers(dest="command", required=True).add_parser("run")
    r.add_argument("input")
    r.add_argument("--out", default="./out")
    r.add_argument("--formats", default="jsonl,csv,txt")
    r.add_argument("--recursive", action="store_true")
    r.add_argument("--max-words", type=int, default=2000)
    r.add_argument("--min-words", type=int, default=500)
    r.add_argument("--ocr", choices=("tesseract", "none"), default="tesseract", help="what recognises images and pages without text; where it is not installed, such pages keep the text they have")
    r.add_argument("--verbose", action="store_true")
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if a.verbose else logging.INFO)
    from loomdoc.operators.ocr import NoProvider, TesseractProvider
    from loomdoc.plans.batch import run

    cfg = ChunkingConfig(min_words=a.min_words, max_words=a.max_words)
    got = run(session(), a.input, a.out, [f for f in a.formats.split(",") if f], a.recursive, cfg, provider=TesseractProvider if a.ocr == "tesseract" else NoProvider).artifacts
    print(f"files: {got['files_seen']}  rows: {got['rows']}  manifest: {a.out}/run_manifest.json")
    for e in got["errors"]:
        print(f"{e['source_filename']}: [{e['stage']}] {e['message']}")
    return 0
