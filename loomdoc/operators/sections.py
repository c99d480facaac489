"""Sections: pages to lines, a running count of headings, lines to sections again.

Tables: pages (document_id, page_number, text), docx blocks (document_id, order_index, kind, text). Sections:
document_id, section_index, heading_text, body_text, page_start, page_end, heading_source, confidence, strategy. The
windows and groups are by document, so a document is a task's largest unit, never a source or a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomdoc.functions.text import normalize_whitespace, strip
from loomdoc.operators.headings import NOISE_COUNT, NOISE_FRACTION, THRESHOLD, heading_reasons, heading_score

COLUMNS = ("document_id", "section_index", "heading_text", "body_text", "page_start", "page_end", "heading_source", "confidence", "reasons", "strategy", "notes")
# Characters under which a document is short, and what is noted of documents and sections.
SHORT = 400
NOTES = {
    "noisy": "Fallback: too many heading-like lines (possible TOC/forms noise); using one section per page.",
    "short": "Short document with no heading patterns; single section.",
    "none": "No strong heading lines; merged into one section (fallback).",
    "unstyled": "DOCX had no styled headings; fell back to line-pattern detection on flattened text.",
    "below": "No line met the construction heading threshold.",
    "preamble": "Preamble before first detected heading.",
}


def lines(pages: DataFrame) -> DataFrame:
    """A row for each line of each page, with its heading score."""
    out = pages.select("document_id", "page_number", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return out.withColumn("score", heading_score(F.col("line")))


def joined(*parts: str, sep: str = "\n", order: tuple[str, ...] = ("page_number", "line_no"), value: str = "line"):
    """The group's values in order, joined; the order is made explicit, as collect_list has none."""
    pairs = F.array_sort(F.collect_list(F.struct(*order, value)))
    return F.array_join(F.transform(pairs, lambda p: p[value]), sep)


def document_stats(scored: DataFrame) -> DataFrame:
    """Candidates, non-empty lines and whether there are too many candidates, for each document."""
    stats = scored.groupBy("document_id").agg(F.count_if(F.col("score") >= THRESHOLD).alias("candidates"), F.count_if(strip(F.col("line")) != "").alias("nonempty"))
    many = (F.col("candidates") > NOISE_COUNT) | ((F.col("nonempty") > 50) & (F.col("candidates") > F.greatest(F.lit(15), F.floor(F.col("nonempty") * NOISE_FRACTION))))
    return stats.withColumn("noisy", many)


def heuristic_sections(pages: DataFrame) -> DataFrame:
    """Sections of documents without usable styles: by headings, or by page where there are too many, or one.

    A document's lines are sorted once; its counts come from the same window partitioning, so the exchange on
    document_id is the only one.
    """
    scored = lines(pages)
    doc = Window.partitionBy("document_id")
    upto = doc.orderBy("page_number", "line_no").rowsBetween(Window.unboundedPreceding, 0)
    hit = F.coalesce(F.col("score") >= THRESHOLD, F.lit(False))
    marked = scored.withColumns({
        "candidates": F.count_if(hit).over(doc), "nonempty": F.count_if(strip(F.col("line")) != "").over(doc),
        "hit": hit, "number": F.sum(hit.cast("int")).over(upto),
        "chars": F.sum(F.length("line") + (F.col("line_no") > 0).cast("int")).over(doc),  # of its pages, line ends included
    })
    noisy = (F.col("candidates") > NOISE_COUNT) | ((F.col("nonempty") > 50) & (F.col("candidates") > F.greatest(F.lit(15), F.floor(F.col("nonempty") * NOISE_FRACTION))))
    strategy = F.when(noisy, "fallback_page").when(F.col("candidates") == 0, "fallback_single").otherwise("text_heuristic")
    keyed = marked.withColumn("strategy", strategy).withColumn("key", F.when(noisy, F.col("page_number")).otherwise(F.col("number")))
    body = F.when(F.col("hit") & (F.col("strategy") == "text_heuristic"), F.lit(None)).otherwise(F.col("line"))
    grouped = keyed.withColumn("body", body).withColumn("title", F.when(F.col("hit") & (F.col("strategy") == "text_heuristic"), F.struct("page_number", "line_no", strip(F.col("line")).alias("text"), F.col("score").alias("score"))))
    got = grouped.groupBy("document_id", "strategy", "key").agg(
        F.min("title").alias("title"),
        F.array_join(F.transform(F.filter(F.array_sort(F.collect_list(F.struct("page_number", "line_no", "body"))), lambda p: p["body"].isNotNull()), lambda p: p["body"]), "\n").alias("raw"),
        F.min("page_number").alias("page_start"), F.max("page_number").alias("page_end"), F.max("chars").alias("chars"),
    )
    got = got.withColumn("body_text", normalize_whitespace(F.col("raw"))).filter("strategy <> 'text_heuristic' or title is not null or body_text <> ''")
    confidence = F.when(F.col("strategy") == "fallback_page", 0.35).when(F.col("strategy") == "fallback_single", 0.40).when(F.col("title").isNull(), 0.5).otherwise(F.least(F.lit(0.95), 0.55 + F.col("title.score") / 20.0))
    number = F.row_number().over(Window.partitionBy("document_id").orderBy("key")) - 1
    source = F.when(F.col("strategy") == "fallback_page", "fallback_page").when(F.col("strategy") == "fallback_single", "fallback_single").otherwise("pattern")
    why = F.when(F.col("title").isNotNull(), heading_reasons(F.col("title.text"))).when(F.col("strategy") == "text_heuristic", F.array(F.lit(NOTES["preamble"]))).when(F.col("strategy") == "fallback_single", F.array(F.lit(NOTES["below"]))).otherwise(F.array(F.col("strategy")))
    single = F.when(F.col("chars") < SHORT, NOTES["short"]).otherwise(NOTES["none"])
    notes = F.when(F.col("strategy") == "fallback_page", F.array(F.lit(NOTES["noisy"]))).when(F.col("strategy") == "fallback_single", F.array(single)).otherwise(F.array().cast("array<string>"))
    return got.select("document_id", number.alias("section_index"), F.col("title.text").alias("heading_text"), "body_text", "page_start", "page_end", source.alias("heading_source"), confidence.alias("confidence"), why.alias("reasons"), "strategy", notes.alias("notes"))


def docx_sections(blocks: DataFrame) -> DataFrame:
    """Sections of word-processor files by their heading styles; blocks before the first heading make one of their own."""
    upto = Window.partitionBy("document_id").orderBy("order_index").rowsBetween(Window.unboundedPreceding, 0)
    head = F.col("kind") == "heading"
    keyed = blocks.withColumn("key", F.sum(head.cast("int")).over(upto))
    got = keyed.groupBy("document_id", "key").agg(
        F.min(F.when(head, F.struct("order_index", strip(F.col("text")).alias("text")))).alias("title"),
        F.array_join(F.transform(F.filter(F.array_sort(F.collect_list(F.struct("order_index", "kind", "text"))), lambda p: p["kind"] != "heading"), lambda p: p["text"]), "\n\n").alias("raw"),
    )
    got = got.withColumn("body_text", strip(F.col("raw"))).filter("title is not null or body_text <> ''")
    number = F.row_number().over(Window.partitionBy("document_id").orderBy("key")) - 1
    return got.select("document_id", number.alias("section_index"), F.col("title.text").alias("heading_text"), "body_text", F.lit(1).alias("page_start"), F.lit(1).alias("page_end"), F.lit("docx_style").alias("heading_source"), F.when(F.col("title").isNull(), 0.55).otherwise(0.92).alias("confidence"), F.array(F.lit("docx_styles")).alias("reasons"), F.lit("docx_styles").alias("strategy"), F.array().cast("array<string>").alias("notes"))


def detect_sections(pages: DataFrame, blocks: DataFrame | None = None) -> DataFrame:
    """Styles where a document has a heading block, lines otherwise; notes say why it is not what one would expect."""
    if blocks is None:
        return heuristic_sections(pages)
    kinds = blocks.groupBy("document_id").agg(F.bool_or(F.col("kind") == "heading").alias("styled"))
    styled = kinds.filter("styled").select("document_id")
    by_line = heuristic_sections(pages.join(styled, "document_id", "left_anti")).join(kinds.filter("not styled"), "document_id", "left")
    noted = by_line.withColumn("notes", F.when(F.col("styled").isNull(), F.col("notes")).otherwise(F.concat(F.array(F.lit(NOTES["unstyled"])), "notes"))).drop("styled")
    return docx_sections(blocks.join(styled, "document_id", "left_semi")).unionByName(noted)
