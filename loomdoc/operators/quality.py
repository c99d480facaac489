"""Quality columns of documents and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomdoc.config import EMPTY_PAGE_CHARS, LOW_CHUNK_SCORE, LOW_SECTION_CONFIDENCE, REVIEW_CONFIDENCE, REVIEW_EMPTY_PERCENT, REVIEW_OCR_CONFIDENCE
from loomdoc.functions.text import extraction_mode, ocr_used, strip


def method_combine(methods: Column) -> Column:
    """The method of a document from the set of its pages' methods."""
    return F.when(F.size(methods) == 0, "parse").when(F.size(methods) == 1, methods[0]).otherwise("hybrid")


def document_summary(pages: DataFrame) -> DataFrame:
    """A row for each document: method, confidence (mean of its pages'), percent_empty_pages and review flags.

    read_pages holds number and confidence of the pages that weren't parsed, for means over chunks' spans.
    """
    got = pages.groupBy("document_id").agg(
        F.sort_array(F.collect_set("method")).alias("methods"), F.avg("confidence").alias("mean"),
        F.collect_list(F.when(F.col("method") != "parse", F.struct("page_number", "confidence"))).alias("read_pages"),
        F.count("*").alias("n_pages"), F.count_if(F.length(strip(F.col("text"))) < EMPTY_PAGE_CHARS).alias("n_empty"),
    )
    got = got.select("document_id", method_combine(F.col("methods")).alias("extracted_method"), F.coalesce("mean", F.lit(0.0)).alias("confidence"), F.round(100.0 * F.col("n_empty") / F.greatest(F.lit(1), F.col("n_pages")), 2).alias("percent_empty_pages"), "n_pages", F.array_sort("read_pages").alias("read_pages"))
    return with_review(got)


def with_review(docs: DataFrame) -> DataFrame:
    """docs (extracted_method, confidence, percent_empty_pages) with mode, ocr_used, document_needs_review, review_reasons."""
    used = ocr_used(F.col("extracted_method"))
    reasons = F.array_compact(F.array(
        F.when(F.col("confidence") < REVIEW_CONFIDENCE, f"overall_confidence<{REVIEW_CONFIDENCE}"),
        F.when(F.col("percent_empty_pages") >= REVIEW_EMPTY_PERCENT, f"empty_pages_percent>={REVIEW_EMPTY_PERCENT}"),
        F.when(used & (F.col("confidence") < REVIEW_OCR_CONFIDENCE), "ocr_overall_confidence_low"),
    ))
    return docs.withColumns({"extraction_mode": extraction_mode(F.col("extracted_method")), "ocr_used": used, "document_needs_review": F.size(reasons) > 0, "review_reasons": reasons})


def ocr_confidence(chunks: DataFrame, pages: DataFrame) -> DataFrame:
    """document_id, chunk_index, ocr_confidence: the mean over pages in the chunk's span that weren't parsed, to 4 places.

    An equi-join on the document with the span as residual condition; only pages of recognised text take part.
    """
    read = pages.filter("method <> 'parse'").select("document_id", "page_number", "confidence")
    spans = chunks.select("document_id", "chunk_index", "page_start", "page_end")
    return spans.join(read, "document_id").filter("page_number between page_start and page_end").groupBy("document_id", "chunk_index").agg(F.round(F.avg("confidence"), 4).alias("ocr_confidence"))


def chunk_score(confidence: Column, section: Column, n_words: Column, min_words: int) -> Column:
    clamp = lambda c: F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))
    base = confidence * F.when(section.isNull(), 0.9).otherwise(0.65 + 0.35 * clamp(section))
    return F.round(clamp(base * F.when(n_words < min_words, 0.88).otherwise(1.0)), 4)


def span_confidence(read_pages: Column, start: Column, end: Column) -> Column:
    """As ocr_confidence(), of one chunk and its document's read_pages; null where none is in the span."""
    inside = F.filter(read_pages, lambda p: (p["page_number"] >= start) & (p["page_number"] <= end))
    total = F.aggregate(inside, F.lit(0.0), lambda a, p: a + p["confidence"])
    return F.when(F.size(inside) > 0, F.round(total / F.size(inside), 4))


def with_quality(chunks: DataFrame, docs: DataFrame, min_words: int) -> DataFrame:
    """chunks with their document's columns, OCR confidence, score and low-quality flag; docs: of document_summary()."""
    joined = chunks.join(docs, "document_id")
    score = chunk_score(F.col("confidence"), F.col("section_detection_confidence"), F.col("chunk_word_count"), min_words)
    low = (F.col("chunk_quality_score") < LOW_CHUNK_SCORE) | F.coalesce(F.col("section_detection_confidence") < LOW_SECTION_CONFIDENCE, F.lit(False))
    read = F.when(F.col("ocr_used"), span_confidence(F.col("read_pages"), F.col("page_start"), F.col("page_end")))
    return joined.withColumn("chunk_quality_score", score).withColumn("low_quality_chunk", low).withColumn("ocr_confidence", read).drop("read_pages")


def job_summary(chunks: DataFrame) -> DataFrame:
    """One row: chunks, low ones, documents to review, mean score, fraction low (null without chunks)."""
    n = F.count("*")
    return chunks.agg(
        n.alias("chunks_total"), F.count_if("low_quality_chunk").alias("low_quality_chunks"),
        F.countDistinct(F.when(F.col("document_needs_review"), F.col("document_id"))).alias("documents_needing_review"),
        F.round(F.avg("chunk_quality_score"), 4).alias("mean_chunk_quality_score"),
        F.when(n > 0, F.round(F.count_if("low_quality_chunk") / F.greatest(n, F.lit(1)), 4)).alias("fraction_low_quality"),
    )
