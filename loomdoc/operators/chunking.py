"""Chunks: adjacent sections merged, long ones split, neighbours overlapped, rows numbered.

The folds depend on word counts only, so they run over arrays of counts within a document; text moves once, afterwards.
Columns of sections: document_id, section_index, heading_text, body_text, page_start, page_end, confidence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomdoc.config import ChunkingConfig
from loomdoc.functions.text import cap_words, chunk_id, count_words, strip, tail_words, words
from loomdoc.storage import cut


def _merge_groups(counts: Column, cfg: ChunkingConfig) -> Column:
    """The group of each section: one joins the group before it if either is short and both fit."""
    zero = F.struct(F.lit(-1).alias("group"), F.lit(0).alias("held"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, n: Column) -> Column:
        join = (s["group"] >= 0) & ((s["held"] < cfg.min_words) | (n < cfg.min_words)) & (s["held"] + n <= cfg.max_words)
        group = F.when(join, s["group"]).otherwise(s["group"] + 1)
        return F.struct(group.alias("group"), F.when(join, s["held"] + n).otherwise(n).alias("held"), F.concat(s["out"], F.array(group)).alias("out"))

    return F.aggregate(counts, zero, step, lambda s: s["out"])


def merge_sections(sections: DataFrame, cfg: ChunkingConfig) -> DataFrame:
    """document_id, group_id, title, text, page_start, page_end, confidence of merged sections."""
    row = F.struct("section_index", count_words(F.col("body_text")).alias("n"), "heading_text", "body_text", "page_start", "page_end", "confidence")
    docs = sections.groupBy("document_id").agg(F.array_sort(F.collect_list(row)).alias("s"))
    groups = docs.withColumn("g", _merge_groups(F.transform("s", lambda x: x["n"]), cfg))
    flat = groups.select("document_id", F.explode(F.arrays_zip("s", "g")).alias("z")).select("document_id", F.col("z.g").alias("group_id"), "z.s.*")
    ordered = F.array_sort(F.collect_list(F.struct("section_index", "heading_text", "body_text")))
    keep = lambda field: F.array_compact(F.transform(F.col("rows"), lambda r: r[field]))
    merged = flat.groupBy("document_id", "group_id").agg(ordered.alias("rows"), F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"), F.min("confidence").alias("confidence"))
    titles = keep("heading_text")
    return merged.select("document_id", "group_id", F.when(F.size(titles) > 0, F.array_join(titles, " / ")).alias("title"), strip(F.array_join(keep("body_text"), "\n\n")).alias("text"), "page_start", "page_end", "confidence")


def window_cuts(ws: Column, cfg: ChunkingConfig) -> Column:
    """Ends of the windows of a word array: each ends with the last sentence that leaves min_words, else at the target."""
    n = F.size(ws)
    ends = F.filter(F.transform(ws, lambda w, i: F.when(w.rlike(r"[.!?]\z"), i + 1)), lambda e: e.isNotNull())

    def cut(ends: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

        def step(s: Column, _: Column) -> Column:
            ideal = F.least(s["at"] + min(cfg.target, cfg.max_words), n)
            snap = F.array_max(F.filter(ends, lambda e: (e >= s["at"] + cfg.min_words) & (e <= ideal)))
            end = F.when(n - s["at"] <= cfg.max_words, n).otherwise(F.coalesce(snap, ideal))
            return F.when(s["at"] >= n, s).otherwise(F.struct(end.alias("at"), F.concat(s["out"], F.array(end)).alias("out")))

        turns = F.floor(n / max(1, min(cfg.min_words, cfg.target, cfg.max_words))).cast("int") + 1
        return F.aggregate(F.sequence(F.lit(0), turns), zero, step, lambda s: s["out"])

    return F.transform(F.array(ends), cut)[0]


def word_windows(text: Column, cfg: ChunkingConfig) -> Column:
    """Pieces of at most max_words; a text that fits stays as it is."""

    def cut(ws: Column) -> Column:
        return F.transform(F.array(window_cuts(ws, cfg)), lambda c: F.transform(c, lambda e, i: F.array_join(F.slice(ws, F.when(i == 0, 1).otherwise(F.get(c, i - 1) + 1), e - F.when(i == 0, 0).otherwise(F.get(c, i - 1))), " ")))[0]

    long = F.transform(F.array(words(text)), cut)[0]
    return F.when(count_words(text) > cfg.max_words, long).when(strip(text) == "", F.array().cast("array<string>")).otherwise(F.array(strip(text)))


def _pack_groups(counts: Column, cfg: ChunkingConfig) -> Column:
    """The group of each paragraph; one over max_words gets a group to itself."""
    zero = F.struct(F.lit(0).alias("group"), F.lit(0).alias("held"), F.lit(False).alias("open"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, n: Column) -> Column:
        fits = s["held"] + n + s["open"].cast("int") <= cfg.max_words
        full = fits & ~((s["held"] + n <= cfg.target_words_high) | (s["held"] < cfg.min_words))
        over = n > cfg.max_words
        here = F.when(over | ~fits, s["group"] + s["open"].cast("int")).otherwise(s["group"])
        closed = over | (full & ~over)
        return F.struct(
            F.when(closed, here + 1).otherwise(here).alias("group"),
            F.when(closed, 0).when(fits, s["held"] + n).otherwise(n).alias("held"),
            (~closed).alias("open"),
            F.concat(s["out"], F.array(here)).alias("out"),
        )

    return F.aggregate(counts, zero, step, lambda s: s["out"])


def split_oversized(text: Column, cfg: ChunkingConfig) -> Column:
    """Pieces of at most max_words: whole paragraphs where they fit, windows of words where one doesn't."""

    def packed(paras: Column) -> Column:
        groups = _pack_groups(F.transform(paras, count_words), cfg)

        def build(g: Column) -> Column:
            members = F.transform(F.array_distinct(g), lambda k: F.filter(paras, lambda _, i: F.get(g, i) == k))
            return F.flatten(F.transform(members, lambda m: F.when(F.size(m) > 1, F.array(F.array_join(m, "\n\n"))).otherwise(word_windows(m[0], cfg))))

        return F.transform(F.array(groups), build)[0]

    paras = F.filter(F.transform(F.split(text, r"\n(?U)[\s\x1c-\x1f]*\n", -1), strip), lambda p: p != "")
    several = F.transform(F.array(paras), lambda p: F.when(F.size(p) > 1, packed(p)).otherwise(word_windows(text, cfg)))[0]
    return F.when(count_words(text) <= cfg.max_words, F.filter(F.array(strip(text)), lambda t: t != "")).otherwise(several)


def raw_chunks(merged: DataFrame, cfg: ChunkingConfig) -> DataFrame:
    """document_id, pos, title, text, page_start, page_end, confidence; pos orders a document's chunks."""
    parts = merged.select("document_id", "group_id", "title", "page_start", "page_end", "confidence", F.posexplode(split_oversized(F.col("text"), cfg)).alias("part", "text"))
    return parts.select("document_id", F.struct("group_id", "part").alias("pos"), "title", "text", "page_start", "page_end", "confidence")


def paragraph_sections(pages: DataFrame) -> DataFrame:
    """Every paragraph of every page as a section without title or confidence."""
    rows = pages.select("document_id", "page_number", F.posexplode(F.split("text", r"\n(?U)[\s\x1c-\x1f]*\n", -1)).alias("n", "body_text"))
    rows = rows.withColumn("body_text", strip(F.col("body_text"))).filter("body_text <> ''")
    number = F.row_number().over(Window.partitionBy("document_id").orderBy("page_number", "n")) - 1
    return rows.select("document_id", number.alias("section_index"), F.lit(None).cast("string").alias("heading_text"), "body_text", F.col("page_number").alias("page_start"), F.col("page_number").alias("page_end"), F.lit(None).cast("double").alias("confidence"))


def overlapped(raw: DataFrame, cfg: ChunkingConfig) -> DataFrame:
    """raw with each text led in by the end of the one before it, within max_words; words_dropped counts what then no longer fits."""
    before = F.lag("text").over(Window.partitionBy("document_id").orderBy("pos"))
    tail = tail_words(F.col("before"), cfg.overlap)
    room = cfg.max_words - count_words(tail)
    led = F.when((cfg.overlap > 0) & F.col("before").isNotNull() & (tail != ""), F.concat(tail, F.lit(" "), F.array_join(F.slice(words(F.col("text")), 1, F.greatest(room, F.lit(0))), " ")))
    out = raw.withColumn("before", before).withColumn("led", strip(led))
    dropped = F.when(F.col("led").isNull(), F.greatest(F.lit(0), count_words(F.col("text")) - cfg.max_words)).otherwise(F.greatest(F.lit(0), count_words(F.col("text")) - room))
    return out.withColumn("words_dropped", dropped).withColumn("text", F.coalesce("led", cap_words(F.col("text"), cfg.max_words))).drop("before", "led")


def chunk_rows(raw: DataFrame, cfg: ChunkingConfig) -> DataFrame:
    """Overlapped chunks with chunk_index, total_chunks, chunk_id, chunk_word_count and a diagnosis of each."""
    doc = Window.partitionBy("document_id")
    out = overlapped(raw, cfg).withColumns({"chunk_index": F.row_number().over(doc.orderBy("pos")), "total_chunks": F.count("*").over(doc).cast("int")})
    n = F.col("chunk_word_count")
    last = F.col("chunk_index") == F.col("total_chunks")
    issue = F.when(n > cfg.max_words, "error: over max_words").when((n == 0) & ~last, "warning: empty").when((n < cfg.min_words) & ~last, "warning: under min_words")
    return out.withColumn("chunk_word_count", count_words(F.col("text"))).select("document_id", chunk_id(F.col("document_id"), F.col("chunk_index")).alias("chunk_id"), "chunk_index", "total_chunks", F.col("title").alias("section_title"), F.col("text").alias("chunk_text"), "chunk_word_count", "page_start", "page_end", F.col("confidence").alias("section_detection_confidence"), "words_dropped", issue.alias("issue"))


def chunk_documents(pages: DataFrame, sections: DataFrame, cfg: ChunkingConfig) -> DataFrame:
    """The cascade: sections' chunks; paragraphs where a document's sections have no text; nothing where it has none.

    Sections are written once, as three things come from them: which documents they give text for, the paragraphs of
    the others, and the chunks, which both go through together. Raw chunks are written before they are numbered.
    """
    fields = ("document_id", "section_index", "heading_text", "body_text", "page_start", "page_end", "confidence")
    found = cut(sections.select(*fields))
    solid = lambda c: F.col(c).rlike(r"(?U)[^\s\x1c-\x1f]")
    # documents whose sections are headings alone; a document without any section is one too
    full = found.filter(solid("body_text")).select("document_id").distinct()
    left = pages.filter(solid("text")).join(full, "document_id", "left_anti")
    bodies = found.join(full, "document_id", "left_semi").unionByName(paragraph_sections(left).select(*fields))
    return chunk_rows(cut(raw_chunks(merge_sections(bodies, cfg), cfg)), cfg)
