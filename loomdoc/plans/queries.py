"""Queries of the document engine over the driver's tables, each with SQL that another engine can run.

Raw documents hold no headings, so several queries first write structure into their lines, by document and line number,
the same in both languages. Documents become pages of twelve lines; conversations are documents of a page a turn.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdoc.config import ChunkingConfig
from loomdoc.functions import text as T
from loomdoc.operators import checks, chunking, classify, export, headings, ocr, quality, sections

DEFAULT = ChunkingConfig()
SMALL = ChunkingConfig(20, 120, 60, 80, 5, 15)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def keep(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return keep


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as one-page text files."""
    docs = _table(spark, sf_dir, "documents")
    name = F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".txt"))
    return docs.select("doc_id", name.alias("source_filename"), T.document_id(F.col("text"), name).alias("document_id"), "text")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _raw(spark, sf_dir)
    return docs.select("document_id", F.lit(1).alias("page_number"), T.normalize_whitespace(F.col("text")).alias("text"), F.lit("parse").alias("method"), F.lit(1.0).alias("confidence"))


def _structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of documents into whose lines headings, blank lines and numbering are written."""
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    k = F.col("doc_id") + F.col("i")
    line = (
        F.when(F.col("doc_id") % 50 == 0, F.concat(F.lit("1."), F.col("i"), F.lit(" Item of the list")))
        .when(k % 11 == 0, F.concat(F.lit("SECTION 09 65 "), F.lpad((F.col("i") % 100).cast("string"), 2, "0"), F.lit(" FLOORING")))
        .when(k % 13 == 0, F.concat(F.lit("PART "), F.col("i"), F.lit(" - GENERAL")))
        .when(k % 17 == 0, F.concat(F.lit("1."), F.col("i"), F.lit(" Scope")))
        .when(k % 19 == 0, F.lit("")).when(k % 23 == 0, F.lit("ARTICLE 5")).when(k % 29 == 0, F.lit("CAST-IN-PLACE CONCRETE"))
        .otherwise(F.col("line"))
    )
    rows = rows.select("doc_id", "i", line.alias("line"), (F.floor(F.col("i") / 12) + 1).cast("int").alias("page_number"))
    return rows.groupBy("doc_id", "page_number").agg(sections.joined(order=("i",)).alias("text")).select(F.concat(F.lit("doc_"), F.col("doc_id")).alias("document_id"), "page_number", "text")


def _conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page a turn; roles and turns decide how a page was read."""
    c = _table(spark, sf_dir, "conversations")
    method = F.when(F.col("turn") % 3 == 0, "parse").when(F.col("role") == "user", "ocr").otherwise("hybrid")
    conf = F.when(F.col("turn") % 3 == 0, 1.0).otherwise(0.5 + (F.col("conv_id") % 40) / 100.0)
    return c.select(F.concat(F.lit("conv_"), F.col("conv_id")).alias("document_id"), (F.col("turn") + 1).cast("int").alias("page_number"), F.col("text"), method.alias("method"), conf.alias("confidence"))


# SQL pieces ---------------------------------------------------------------------------------------------------

def _norm(c: str) -> str:
    return f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '\\r\\n?', chr(10), 'g'), '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+', ''), '\\s+$', '')"


def _strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^\\s+', ''), '\\s+$', '')"


def _words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '\\s+'), lambda x: x <> '')"


_STRUCTURED = """lines0 AS (
  SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
lines1 AS (
  SELECT 'doc_' || doc_id AS document_id, i, CAST(i // 12 + 1 AS INTEGER) AS page_number, CASE
    WHEN doc_id % 50 = 0 THEN '1.' || i || ' Item of the list'
    WHEN (doc_id + i) % 11 = 0 THEN 'SECTION 09 65 ' || lpad(CAST(i % 100 AS VARCHAR), 2, '0') || ' FLOORING'
    WHEN (doc_id + i) % 13 = 0 THEN 'PART ' || i || ' - GENERAL'
    WHEN (doc_id + i) % 17 = 0 THEN '1.' || i || ' Scope'
    WHEN (doc_id + i) % 19 = 0 THEN ''
    WHEN (doc_id + i) % 23 = 0 THEN 'ARTICLE 5'
    WHEN (doc_id + i) % 29 = 0 THEN 'CAST-IN-PLACE CONCRETE'
    ELSE line END AS line FROM lines0)"""

_SCORE = """CASE WHEN length(s) BETWEEN 3 AND 220 AND NOT contains(s, '...') THEN nullif(
    CASE WHEN regexp_matches(s, '^(SECTION|Section)\\s+((\\d{2}\\s\\d{2}\\s\\d{2})|(\\d{6}))\\b') THEN 6.0 WHEN regexp_matches(s, '^(SECTION|Section)\\s+\\S+') AND length(s) < 120 THEN 3.5 ELSE 0.0 END
  + CASE WHEN regexp_matches(s, '^(PART|Part)\\s+(\\d+|[IVXLCDM]+)\\s*[-–—]\\s*(.+)$') THEN 5.5 WHEN regexp_matches(s, '^(PART|Part)\\s+(\\d+|[IVXLCDM]+)\\s*$') THEN 3.0 ELSE 0.0 END
  + CASE WHEN regexp_matches(s, '^(DIVISION|Division)\\s+(\\d+|[IVXLCDM]+)\\b') THEN 4.5 ELSE 0.0 END
  + CASE WHEN regexp_matches(s, '^(\\d{1,2}\\.\\d+(\\.\\d+)?)\\s+(\\S.{0,200})$') THEN 3.5 WHEN regexp_matches(s, '^(\\d{1,2}\\.\\d+(\\.\\d+)?)\\s*$') AND length(s) < 40 THEN 2.0 ELSE 0.0 END
  + CASE WHEN regexp_matches(s, '^(ARTICLE|Article)\\s+\\d+') THEN 4.0 ELSE 0.0 END
  + CASE WHEN length(s) < 100 AND length(s) > 6 AND upper(s) = s AND NOT regexp_matches(s, '[^\\x00-\\x7f]') AND regexp_matches(s, '[A-Z]') AND NOT suffix(s, '.') THEN 1.5 ELSE 0.0 END, 0.0) END"""

_SCORED = f"""{_STRUCTURED},
scored AS (SELECT document_id, page_number, i, line, CAST({_SCORE} AS DOUBLE) AS score FROM (SELECT *, {_strip('line')} AS s FROM lines1)),
stats AS (SELECT document_id, count(*) FILTER (score >= 2.5) AS candidates, count(*) FILTER ({_strip('line')} <> '') AS nonempty FROM scored GROUP BY 1),
plan AS (SELECT *, CASE WHEN candidates > 40 OR (nonempty > 50 AND candidates > greatest(15, floor(nonempty * 0.12))) THEN 'fallback_page' WHEN candidates = 0 THEN 'fallback_single' ELSE 'text_heuristic' END AS strategy FROM stats)"""

_SECTIONS = f"""{_SCORED},
numbered AS (
  SELECT s.*, strategy, coalesce(score >= 2.5, false) AND strategy = 'text_heuristic' AS title,
    CASE WHEN strategy = 'fallback_page' THEN page_number ELSE sum(CASE WHEN score >= 2.5 THEN 1 ELSE 0 END) OVER (PARTITION BY document_id ORDER BY page_number, i ROWS UNBOUNDED PRECEDING) END AS key
  FROM scored s JOIN plan USING (document_id)),
gathered AS (
  SELECT document_id, strategy, key, {_strip("max(line) FILTER (title)")} AS heading_text, max(score) FILTER (title) AS score,
    coalesce({_norm("string_agg(line, chr(10) ORDER BY page_number, i) FILTER (NOT title)")}, '') AS body_text, min(page_number) AS page_start, max(page_number) AS page_end
  FROM numbered GROUP BY 1, 2, 3),
sections AS (
  SELECT document_id, CAST(row_number() OVER (PARTITION BY document_id ORDER BY key) - 1 AS INTEGER) AS section_index, heading_text, body_text, page_start, page_end, strategy,
    CAST(CASE WHEN strategy = 'fallback_page' THEN 0.35 WHEN strategy = 'fallback_single' THEN 0.40 WHEN heading_text IS NULL THEN 0.5 ELSE least(0.95, 0.55 + score / 20.0) END AS DOUBLE) AS confidence
  FROM gathered WHERE strategy <> 'text_heuristic' OR heading_text IS NOT NULL OR body_text <> '')"""


def _merged_sql(c: ChunkingConfig, before: str = _SECTIONS, bodies: str = "sections") -> str:
    fit = f"(f.held < {c.min_words} OR s.n < {c.min_words}) AND f.held + s.n <= {c.max_words}"
    return f"""{before},
counted AS (SELECT *, len({_words('body_text')}) AS n FROM {bodies}),
folded AS (
  SELECT document_id, section_index, 0 AS grp, n AS held FROM counted WHERE section_index = 0
  UNION ALL SELECT s.document_id, s.section_index, CASE WHEN {fit} THEN f.grp ELSE f.grp + 1 END, CASE WHEN {fit} THEN f.held + s.n ELSE s.n END
  FROM folded f JOIN counted s ON s.document_id = f.document_id AND s.section_index = f.section_index + 1),
merged AS (
  SELECT document_id, grp AS group_id, string_agg(heading_text, ' / ' ORDER BY section_index) AS title, {_strip("string_agg(body_text, chr(10) || chr(10) ORDER BY section_index)")} AS text, min(page_start) AS page_start, max(page_end) AS page_end, min(confidence) AS confidence
  FROM folded JOIN counted USING (document_id, section_index) GROUP BY 1, 2)"""


def _windows_sql(c: ChunkingConfig) -> str:
    """Windows of table long_texts (key, w): parts (key, part, a, b), words a + 1 to b."""
    ideal = f"least(a + {min(c.target, c.max_words)}, n)"
    cut = f"CASE WHEN n - a <= {c.max_words} THEN n ELSE coalesce(list_max(list_filter(ends, lambda e: e >= a + {c.min_words} AND e <= {ideal})), {ideal}) END"
    return f"""ended AS (SELECT key, w, len(w) AS n, list_filter(list_transform(range(1, len(w) + 1), lambda e: CASE WHEN regexp_matches(w[e], '[.!?]$') THEN e END), lambda e: e IS NOT NULL) AS ends FROM long_texts),
parts AS (
  SELECT key, 0 AS part, CAST(0 AS BIGINT) AS a, {cut.replace(' a ', ' 0 ').replace('- a', '- 0').replace('(a ', '(0 ')} AS b FROM ended
  UNION ALL SELECT key, part + 1, b, {cut.replace(' a ', ' b ').replace('- a', '- b').replace('(a ', '(b ')} FROM parts JOIN ended USING (key) WHERE b < n)"""


# Scalar functions ---------------------------------------------------------------------------------------------

@_query(f"SELECT doc_id, {_norm('text')} AS text FROM documents")
def normalize_whitespace(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", T.normalize_whitespace(F.col("text")).alias("text"))


@_query(f"SELECT doc_id, CAST(len({_words('text')}) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '\\s+', '', 'g')) AS BIGINT) AS n_chars_solid, length(regexp_replace(text, '\\s+', '', 'g')) < 40 AS needs_ocr FROM documents")
def count_words(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", T.count_words(F.col("text")).cast("long").alias("n_words"), T.non_whitespace_chars(F.col("text")).cast("long").alias("n_chars_solid"), T.needs_ocr(F.col("text"), 40).alias("needs_ocr"))


@_query("SELECT doc_id, sha256(text || '|' || 'doc_' || doc_id || '.txt') AS document_id, sha256(text) AS source_sha256, sha256(text || '|' || 'doc_' || doc_id || '.txt') || '-chunk-0001' AS first_chunk, substring(sha256(text || '|' || 'doc_' || doc_id || '.txt'), 1, 16) || ':000007' AS legacy FROM documents")
def document_identity(spark, sf_dir):
    d = F.col("document_id")
    return _raw(spark, sf_dir).select("doc_id", "document_id", F.sha2("text", 256).alias("source_sha256"), T.chunk_id(d, F.lit(1)).alias("first_chunk"), T.legacy_chunk_id(d, F.lit(7)).alias("legacy"))


_NAMES = [".pdf", ".DOCX", ".txt", ".md", ".log", ".csv", ".tsv", ".xlsx", ".xlsm", ".png", ".jpeg", ".html", ".py", ".bin", ""]
_KINDS = ["pdf", "docx", "txt", "txt", "txt", "csv", "csv", "xlsx", "xlsx", "image", "image", "txt", "txt", "unknown", "unknown"]


@_query(f"SELECT page_id, 'folder/p.' || page_id || {_NAMES}[page_id % {len(_NAMES)} + 1] AS name, CASE WHEN page_id % {len(_NAMES)} = {len(_NAMES) - 1} THEN 'unknown' ELSE {_KINDS}[page_id % {len(_NAMES)} + 1] END AS kind, CASE WHEN page_id % {len(_NAMES)} = {len(_NAMES) - 1} THEN 'p' ELSE 'p.' || page_id END AS stem FROM pages")
def kind_detection(spark, sf_dir):
    suffix = F.get(F.array(*map(F.lit, _NAMES)), (F.col("page_id") % len(_NAMES)).cast("int"))
    named = _table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("folder/p."), F.col("page_id"), suffix).alias("name"))
    return named.withColumns({"kind": T.document_kind(F.col("name")), "stem": T.source_spec(F.col("name"))})


@_query(f"SELECT doc_id, CASE WHEN len(w) > 30 THEN array_to_string(w[-30:], ' ') ELSE {_strip('text')} END AS tail, CASE WHEN len(w) > 25 THEN array_to_string(w[:25], ' ') ELSE {_strip('text')} END AS head FROM (SELECT *, {_words('text')} AS w FROM documents)")
def tail_and_cap_words(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", T.tail_words(F.col("text"), 30).alias("tail"), T.cap_words(F.col("text"), 25).alias("head"))


@_query("SELECT item_id, CASE WHEN regexp_matches(t, '^([=+@-]|\\t[=+])') THEN '''' || t ELSE t END AS cell, regexp_replace(t || chr(1) || chr(9), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g') AS clean, CASE WHEN length(o) <= 60 THEN o ELSE substring(o, 1, 59) || '…' END AS preview FROM (SELECT item_id, t, trim(regexp_replace(t, '\\s+', ' ', 'g')) AS o FROM (SELECT item_id, CASE item_id % 5 WHEN 0 THEN '=' WHEN 1 THEN '+' WHEN 2 THEN '-' WHEN 3 THEN '@' ELSE '' END || text AS t FROM benchmark))")
def sanitize_text(spark, sf_dir):
    lead = F.get(F.array(*map(F.lit, "=+-@"), F.lit("")), (F.col("item_id") % 5).cast("int"))
    rows = _table(spark, sf_dir, "benchmark").select("item_id", F.concat(lead, F.col("text")).alias("t"))
    t = F.col("t")
    return rows.select("item_id", T.excel_cell(t).alias("cell"), T.strip_control(F.concat(t, F.lit("\x01\t"))).alias("clean"), T.preview(t, 60).alias("preview"))


@_query("SELECT doc_id, title, coalesce(nullif(regexp_replace(regexp_extract(title, '\\b(\\d\\d\\s+\\d\\d\\s+\\d\\d)\\b', 1), '\\s+', ' ', 'g'), ''), nullif(regexp_extract(title, '\\b(\\d+(\\.\\d+)+)\\b', 1), '')) AS section_number FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'SECTION 09 62  ' || (10 + doc_id % 80) || ' - CORK' WHEN 1 THEN '1.' || doc_id || '.3 Scope' ELSE 'Scope of work' END AS title FROM documents)")
def section_number(spark, sf_dir):
    d = F.col("doc_id")
    title = F.when(d % 3 == 0, F.concat(F.lit("SECTION 09 62  "), 10 + d % 80, F.lit(" - CORK"))).when(d % 3 == 1, F.concat(F.lit("1."), d, F.lit(".3 Scope"))).otherwise("Scope of work")
    return _table(spark, sf_dir, "documents").select("doc_id", title.alias("title")).withColumn("section_number", T.section_number(F.col("title")))


_SENTENCES = f"list_filter(list_transform(string_split(regexp_replace({_strip('text')}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: {_strip('x')}), lambda x: x <> '')"


@_query(f"SELECT doc_id, CAST(i - 1 AS INTEGER) AS place, s[i] AS sentence FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, {_SENTENCES} AS s FROM documents))")
def split_sentences(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(T.split_sentences(F.col("text"))).alias("place", "sentence"))


# Recognised text ----------------------------------------------------------------------------------------------

@_query(f"""SELECT conv_id, turn, CASE WHEN n <> '' AND o <> '' THEN {_norm("n || chr(10) || chr(10) || o")} WHEN o <> '' THEN o ELSE n END AS text,
  CASE WHEN n <> '' AND o <> '' THEN 'hybrid' WHEN o <> '' THEN 'ocr' ELSE 'parse' END AS method,
  CAST(CASE WHEN n <> '' AND o <> '' THEN least(1.0, (0.95 + c) / 2) WHEN o <> '' THEN c WHEN n <> '' THEN 0.35 ELSE 0.0 END AS DOUBLE) AS confidence
  FROM (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN {_strip('text')} ELSE '' END AS n, CASE WHEN turn % 3 = 0 THEN {_strip('text')} ELSE '' END AS o, CAST((conv_id % 100) / 100.0 AS DOUBLE) AS c FROM conversations)""")
def ocr_merge_rule(spark, sf_dir):
    c = _table(spark, sf_dir, "conversations")
    m = ocr.merge_text(F.when(F.col("turn") % 2 == 0, F.col("text")).otherwise(""), F.when(F.col("turn") % 3 == 0, F.col("text")).otherwise(""), (F.col("conv_id") % 100) / 100.0)
    return c.select("conv_id", "turn", m.alias("m")).select("conv_id", "turn", "m.*")


_CONV = "conv AS (SELECT 'conv_' || conv_id AS document_id, CAST(turn + 1 AS INTEGER) AS page_number, text, CASE WHEN turn % 3 = 0 THEN 'parse' WHEN role = 'user' THEN 'ocr' ELSE 'hybrid' END AS method, CAST(CASE WHEN turn % 3 = 0 THEN 1.0 ELSE 0.5 + (conv_id % 40) / 100.0 END AS DOUBLE) AS confidence FROM conversations)"
_SUMMARY = f"""{_CONV}, summed AS (
  SELECT document_id, CASE WHEN count(DISTINCT method) = 1 THEN min(method) ELSE 'hybrid' END AS extracted_method, avg(confidence) AS confidence, round(100.0 * count(*) FILTER (length({_strip('text')}) < 40) / count(*), 2) AS percent_empty_pages, count(*) AS n_pages FROM conv GROUP BY 1),
summary AS (SELECT *, CASE extracted_method WHEN 'parse' THEN 'native' WHEN 'ocr' THEN 'ocr' ELSE 'hybrid' END AS extraction_mode, extracted_method IN ('ocr', 'hybrid') AS ocr_used,
  confidence < 0.72 OR percent_empty_pages >= 18 OR (extracted_method IN ('ocr', 'hybrid') AND confidence < 0.65) AS document_needs_review FROM summed)"""


@_query(f"WITH {_SUMMARY} SELECT document_id, extracted_method, round(confidence, 6) AS confidence, CAST(percent_empty_pages AS DOUBLE) AS percent_empty_pages, n_pages, extraction_mode, ocr_used, document_needs_review FROM summary")
def document_review_flags(spark, sf_dir):
    d = quality.document_summary(_conversation_pages(spark, sf_dir))
    return d.select("document_id", "extracted_method", F.round("confidence", 6).alias("confidence"), "percent_empty_pages", "n_pages", "extraction_mode", "ocr_used", "document_needs_review")


@_query(f"WITH {_CONV}, span AS (SELECT document_id, 1 AS chunk_index, 1 AS page_start, 3 AS page_end FROM (SELECT DISTINCT document_id FROM conv) UNION ALL SELECT document_id, 2, 3, 6 FROM (SELECT DISTINCT document_id FROM conv)) SELECT s.document_id, s.chunk_index, round(avg(c.confidence), 4) AS ocr_confidence FROM span s JOIN conv c ON s.document_id = c.document_id AND c.page_number BETWEEN s.page_start AND s.page_end AND c.method <> 'parse' GROUP BY 1, 2")
def ocr_confidence_in_span(spark, sf_dir):
    pages = _conversation_pages(spark, sf_dir)
    spans = pages.select("document_id").distinct().select("document_id", F.explode(F.expr("array(struct(1 as chunk_index, 1 as page_start, 3 as page_end), struct(2 as chunk_index, 3 as page_start, 6 as page_end))")).alias("s")).select("document_id", "s.*")
    return quality.ocr_confidence(spans, pages)


# Headings and sections ----------------------------------------------------------------------------------------

@_query(f"WITH {_SCORED} SELECT document_id, page_number, line, score, coalesce(score >= 2.5, false) AS is_heading FROM scored")
def heading_score(spark, sf_dir):
    out = sections.lines(_structured(spark, sf_dir))
    return out.select("document_id", "page_number", "line", "score", headings.is_heading(F.col("line")).alias("is_heading"))


@_query(f"WITH {_SCORED} SELECT document_id, candidates, nonempty, strategy = 'fallback_page' AS noisy FROM plan")
def noise_fallback(spark, sf_dir):
    return sections.document_stats(sections.lines(_structured(spark, sf_dir)))


def _section_query(strategy: str | None):
    where = f" WHERE strategy = '{strategy}'" if strategy else ""
    sql = f"WITH {_SECTIONS} SELECT document_id, section_index, heading_text, body_text, page_start, page_end, round(confidence, 6) AS confidence, strategy FROM sections{where}"

    def run(spark, sf_dir):
        out = sections.detect_sections(_structured(spark, sf_dir))
        out = out.filter(F.col("strategy") == strategy) if strategy else out
        return out.select("document_id", "section_index", "heading_text", "body_text", "page_start", "page_end", F.round("confidence", 6).alias("confidence"), "strategy")

    return run, sql


for _name, _strategy in (("detect_sections", None), ("sections_text_heuristic", "text_heuristic"), ("sections_per_page", "fallback_page"), ("sections_single", "fallback_single")):
    _QUERIES[_name], _SQL[_name] = _section_query(_strategy)


@_query("""WITH b AS (SELECT conv_id, turn, turn % 3 = 1 AS head, text FROM conversations), k AS (SELECT *, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS key FROM b),
g AS (SELECT conv_id, key, max(trim(text)) FILTER (head) AS heading_text, coalesce(trim(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (NOT head)), '') AS body_text FROM k GROUP BY 1, 2)
SELECT 'conv_' || conv_id AS document_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY key) - 1 AS INTEGER) AS section_index, heading_text, body_text, CAST(CASE WHEN heading_text IS NULL THEN 0.55 ELSE 0.92 END AS DOUBLE) AS confidence FROM g WHERE heading_text IS NOT NULL OR body_text <> ''""")
def docx_style_sections(spark, sf_dir):
    c = _table(spark, sf_dir, "conversations")
    blocks = c.select(F.concat(F.lit("conv_"), F.col("conv_id")).alias("document_id"), F.col("turn").alias("order_index"), F.when(F.col("turn") % 3 == 1, "heading").otherwise("paragraph").alias("kind"), "text")
    return sections.docx_sections(blocks).select("document_id", "section_index", "heading_text", "body_text", "confidence")


# Chunks -------------------------------------------------------------------------------------------------------

@_query(f"WITH RECURSIVE {_merged_sql(SMALL)} SELECT document_id, CAST(group_id AS INTEGER) AS group_id, title, text, page_start, page_end, round(confidence, 6) AS confidence FROM merged")
def merge_adjacent_sections(spark, sf_dir):
    out = chunking.merge_sections(sections.detect_sections(_structured(spark, sf_dir)), SMALL)
    return out.withColumn("confidence", F.round("confidence", 6))


def _window_query(c: ChunkingConfig):
    sql = f"""WITH RECURSIVE long_texts AS (SELECT doc_id AS key, {_words('text')} AS w FROM documents WHERE len({_words('text')}) > {c.max_words}), {_windows_sql(c)}
SELECT key AS doc_id, CAST(part AS INTEGER) AS part, array_to_string(w[a + 1:b], ' ') AS text FROM parts JOIN ended USING (key)
UNION ALL SELECT doc_id, 0, {_strip('text')} FROM documents WHERE len({_words('text')}) BETWEEN 1 AND {c.max_words}"""

    def run(spark, sf_dir):
        return _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.word_windows(F.col("text"), c)).alias("part", "text"))

    return run, sql


_QUERIES["word_window_split"], _SQL["word_window_split"] = _window_query(SMALL)
_QUERIES["word_window_split_default"], _SQL["word_window_split_default"] = _window_query(DEFAULT)


def _split_sql(c: ChunkingConfig) -> str:
    """Table pieces (key, part, text) of table src (key, text): as it is, packed paragraphs, windows of long paragraphs."""
    fits = f"f.held + p.n + (CASE WHEN f.open THEN 1 ELSE 0 END) <= {c.max_words}"
    full = f"({fits}) AND NOT (f.held + p.n <= {c.target_words_high} OR f.held < {c.min_words})"
    over = f"p.n > {c.max_words}"
    here = f"CASE WHEN {over} OR NOT ({fits}) THEN f.grp + (CASE WHEN f.open THEN 1 ELSE 0 END) ELSE f.grp END"
    closed = f"({over} OR ({full}))"
    return f"""p0 AS (SELECT key, unnest(l) AS para, unnest(range(len(l))) AS i FROM (SELECT key, regexp_split_to_array(text, '\\n\\s*\\n') AS l FROM src)),
p AS (SELECT key, row_number() OVER (PARTITION BY key ORDER BY i) AS rn, {_strip('para')} AS para, len({_words('para')}) AS n FROM p0 WHERE {_strip('para')} <> ''),
f AS (SELECT key, CAST(0 AS BIGINT) AS rn, 0 AS here, 0 AS grp, CAST(0 AS BIGINT) AS held, false AS open FROM (SELECT DISTINCT key FROM p)
  UNION ALL SELECT p.key, p.rn, {here}, CASE WHEN {closed} THEN {here} + 1 ELSE {here} END, CASE WHEN {closed} THEN 0 WHEN {fits} THEN f.held + p.n ELSE p.n END, NOT {closed} FROM f JOIN p ON p.key = f.key AND p.rn = f.rn + 1),
total AS (SELECT key, sum(n) AS words FROM p GROUP BY 1),
packed AS (SELECT key AS whole, here, string_agg(para, chr(10) || chr(10) ORDER BY f.rn) AS text, count(*) AS members, max(n) AS n FROM f JOIN p USING (key, rn) JOIN total USING (key) WHERE words > {c.max_words} GROUP BY 1, 2),
long_texts AS (SELECT struct_pack(whole := whole, here := here) AS key, {_words('text')} AS w FROM packed WHERE members = 1 AND n > {c.max_words}),
{_windows_sql(c)},
cuts AS (SELECT key.whole AS key, key.here AS here, part AS sub, array_to_string(w[a + 1:b], ' ') AS text FROM parts JOIN ended USING (key)
  UNION ALL SELECT whole, here, 0, text FROM packed WHERE NOT (members = 1 AND n > {c.max_words})
  UNION ALL SELECT key, 0, 0, {_strip('text')} FROM src JOIN total USING (key) WHERE words <= {c.max_words}),
pieces AS (SELECT key, CAST(row_number() OVER (PARTITION BY key ORDER BY here, sub) - 1 AS INTEGER) AS part, text FROM cuts)"""


@_query(f"""WITH RECURSIVE one AS (SELECT doc_id, unnest(l) AS para, unnest(range(len(l))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
src AS (SELECT doc_id AS key, string_agg({_strip('para')}, chr(10) || chr(10) ORDER BY i) AS text FROM one WHERE {_strip('para')} <> '' GROUP BY 1), {_split_sql(SMALL)} SELECT key AS doc_id, part, text FROM pieces""")
def split_oversized(spark, sf_dir):
    """Lines as paragraphs, every document: as it is, packed, or with windows of the words of paragraphs over the limit."""
    paras = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), T.strip), lambda p: p != "")
    return _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.split_oversized(F.array_join(paras, "\n\n"), SMALL)).alias("part", "text"))


@_query(f"WITH p0 AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS para, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents) SELECT 'doc_' || doc_id AS document_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS section_index, {_strip('para')} AS body_text FROM p0 WHERE {_strip('para')} <> ''")
def paragraph_fallback(spark, sf_dir):
    pages = _table(spark, sf_dir, "documents").select(F.concat(F.lit("doc_"), F.col("doc_id")).alias("document_id"), F.lit(1).alias("page_number"), F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return chunking.paragraph_sections(pages).select("document_id", "section_index", "body_text")


_DOC = f"SELECT sha256(text || '|' || 'doc_' || doc_id || '.txt') AS document_id, 'doc_' || doc_id || '.txt' AS source_filename, {_norm('text')} AS text FROM documents"


def _led_sql(c: ChunkingConfig, keep: str = "") -> str:
    """Table led (document_id, part, chunk_text, columns of keep) of table raw, whose parts are in order."""
    return f"""lagged AS (SELECT *, {_words('text')} AS w, lag({_words('text')}) OVER (PARTITION BY document_id ORDER BY part) AS before, lag(text) OVER (PARTITION BY document_id ORDER BY part) AS before_text FROM raw),
led AS (SELECT document_id, part{keep}, CASE WHEN before IS NULL THEN text ELSE CASE WHEN len(before) > {c.overlap} THEN array_to_string(before[-{c.overlap}:], ' ') ELSE before_text END || ' ' || array_to_string(w[:{c.max_words} - least(len(before), {c.overlap})], ' ') END AS chunk_text FROM lagged)"""


def _chunk_sql(c: ChunkingConfig, doc: str = _DOC) -> str:
    """Chunks of one-page documents without headings: windows, overlap, numbers. Their one section is at 0.40."""
    return f"""doc AS ({doc}),
long_texts AS (SELECT document_id AS key, {_words('text')} AS w FROM doc WHERE len({_words('text')}) > {c.max_words}),
{_windows_sql(c)},
raw AS (SELECT key AS document_id, part, array_to_string(w[a + 1:b], ' ') AS text FROM parts JOIN ended USING (key)
  UNION ALL SELECT document_id, 0, text FROM doc WHERE len({_words('text')}) <= {c.max_words} AND text <> ''),
{_led_sql(c)},
chunks AS (SELECT document_id, source_filename, CAST(row_number() OVER (PARTITION BY document_id ORDER BY part) AS INTEGER) AS chunk_index, CAST(count(*) OVER (PARTITION BY document_id) AS INTEGER) AS total_chunks, chunk_text, CAST(len({_words('chunk_text')}) AS INTEGER) AS chunk_word_count FROM led JOIN doc USING (document_id)),
scored_chunks AS (SELECT c.*, document_id || '-chunk-' || lpad(CAST(chunk_index AS VARCHAR), 4, '0') AS chunk_id, round((0.65 + 0.35 * 0.40) * CASE WHEN chunk_word_count < {c.min_words} THEN 0.88 ELSE 1.0 END, 4) AS chunk_quality_score, length({_strip('text')}) < 40 AS document_needs_review, chunk_quality_score < 0.45 OR 0.40 < 0.42 AS low_quality_chunk FROM chunks c JOIN (SELECT document_id, text FROM doc) USING (document_id))"""


def _chunked(spark, sf_dir, c: ChunkingConfig) -> DataFrame:
    """The whole plan over one-page documents: sections, chunks, quality."""
    docs, pages = _raw(spark, sf_dir), _pages(spark, sf_dir)
    chunks = chunking.chunk_documents(pages, sections.detect_sections(pages), c)
    out = quality.with_quality(chunks, quality.document_summary(pages), c.min_words)
    return out.join(docs.select("document_id", "source_filename").distinct(), "document_id").withColumn("document_type", F.lit("txt"))


_CHUNK_COLUMNS = ("document_id", "chunk_id", "chunk_index", "total_chunks", "chunk_text", "chunk_word_count", "chunk_quality_score", "low_quality_chunk", "document_needs_review")


def _chunk_query(c: ChunkingConfig):
    sql = f"WITH RECURSIVE {_chunk_sql(c)} SELECT document_id, chunk_id, chunk_index, total_chunks, chunk_text, chunk_word_count, CAST(chunk_quality_score AS DOUBLE) AS chunk_quality_score, low_quality_chunk, document_needs_review FROM scored_chunks"
    return lambda spark, sf_dir: _chunked(spark, sf_dir, c).select(*_CHUNK_COLUMNS), sql


_QUERIES["chunk_documents"], _SQL["chunk_documents"] = _chunk_query(DEFAULT)
_QUERIES["overlap_chunks"], _SQL["overlap_chunks"] = _chunk_query(SMALL)


@_query(f"WITH RECURSIVE {_chunk_sql(SMALL)} SELECT document_id, chunk_index, CASE WHEN chunk_word_count > 120 THEN 'error: over max_words' WHEN chunk_word_count = 0 AND chunk_index < total_chunks THEN 'warning: empty' WHEN chunk_word_count < 20 AND chunk_index < total_chunks THEN 'warning: under min_words' END AS issue FROM chunks")
def chunk_validation(spark, sf_dir):
    return _chunked(spark, sf_dir, SMALL).select("document_id", "chunk_index", "issue")


@_query(f"WITH RECURSIVE {_chunk_sql(DEFAULT)} SELECT count(*) AS chunks_total, count(*) FILTER (low_quality_chunk) AS low_quality_chunks, count(DISTINCT document_id) FILTER (document_needs_review) AS documents_needing_review, CAST(round(avg(chunk_quality_score), 4) AS DOUBLE) AS mean_chunk_quality_score, round(count(*) FILTER (low_quality_chunk) / count(*), 4) AS fraction_low_quality FROM scored_chunks")
def job_quality_summary(spark, sf_dir):
    return quality.job_summary(_chunked(spark, sf_dir, DEFAULT))


@_query(f"WITH RECURSIVE {_chunk_sql(DEFAULT)} SELECT document_id, source_filename, 'txt' AS original_file_type, chunk_id, 1 AS page_start, 1 AS page_end, CAST(NULL AS VARCHAR) AS section_title, 'unknown' AS document_type, 'parse' AS extraction_method, CAST(1.0 AS DOUBLE) AS extraction_confidence, 'native' AS extraction_mode, false AS ocr_used, CAST(NULL AS DOUBLE) AS ocr_confidence, CAST(CASE WHEN document_needs_review THEN 100.0 ELSE 0.0 END AS DOUBLE) AS percent_empty_pages, CAST(0.4 AS DOUBLE) AS section_detection_confidence, CAST(chunk_quality_score AS DOUBLE) AS chunk_quality_score, low_quality_chunk, document_needs_review, chunk_text FROM scored_chunks")
def ingestion_export(spark, sf_dir):
    return export.ingestion(_chunked(spark, sf_dir, DEFAULT)).drop("processing_timestamp")


@_query(f"WITH RECURSIVE {_chunk_sql(DEFAULT)} SELECT source_filename AS source_file, regexp_replace(source_filename, '\\.txt$', '') AS source_spec, CAST(NULL AS VARCHAR) AS section_number, CAST(NULL AS VARCHAR) AS section_title, chunk_id, chunk_text, 1 AS page_start, 1 AS page_end, 'parse' AS extraction_method FROM scored_chunks")
def master_export(spark, sf_dir):
    return export.master(_chunked(spark, sf_dir, DEFAULT))


_PORTAL_BYTES = 1024
# the header's bytes: its fixed words, the chunk's id, the file's name; those of a split file in two parts, and of any
_HEAD = "'# chunk text export (UTF-8)' || chr(10) || '# chunk_id: ' || chunk_id || chr(10) || '# source: ' || source_filename || chr(10) || '# pages: 1-1' || chr(10)"


@_query(f"""WITH RECURSIVE {_chunk_sql(DEFAULT)},
plain AS (SELECT source_filename, document_id, chunk_index, chunk_id, {_HEAD} AS head, regexp_replace(regexp_replace(chunk_text, '[^\\x00-\\x7f]', '?', 'g'), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g') AS t FROM scored_chunks),
sized AS (SELECT *, greatest(least(256, {_PORTAL_BYTES} - strlen(head || '# split_part: 1000000 of 1000000' || chr(10))), {_PORTAL_BYTES} - strlen(head || '# split_part: 1 of 2' || chr(10)) - 64) AS body FROM plain),
counted AS (SELECT *, greatest(1, CAST(ceil(strlen(t) / body) AS INTEGER)) AS parts, row_number() OVER (ORDER BY source_filename, document_id, chunk_index) AS seq FROM sized),
filed AS (SELECT *, unnest(range(1, parts + 1)) AS part FROM counted)
SELECT row_number() OVER (ORDER BY seq, part) - 1 AS file_index, chunk_id, CAST(part AS INTEGER) AS part, parts,
  printf('%05d_%s_p1-1_c%04d', row_number() OVER (ORDER BY seq, part) - 1, regexp_replace(source_filename, '\\.txt$', ''), seq) || CASE WHEN parts > 1 THEN printf('_part%02dof%02d', part, parts) ELSE '' END || '.txt' AS name,
  head || CASE WHEN parts > 1 THEN '# split_part: ' || part || ' of ' || parts || chr(10) ELSE '' END || substring(t, CAST((part - 1) * body + 1 AS BIGINT), body) AS body FROM filed""")
def portal_txt_parts(spark, sf_dir):
    """Texts in ASCII, so that SQL can count bytes by characters."""
    chunks = _chunked(spark, sf_dir, DEFAULT)
    return export.portal_files(chunks.withColumn("chunk_text", F.regexp_replace("chunk_text", r"[^\x00-\x7f]", "?")), most=_PORTAL_BYTES)


# Whole documents with headings --------------------------------------------------------------------------------

def _headings_only(spark, sf_dir) -> DataFrame:
    """The structured pages; of every 25th document the pages hold headings and blank lines alone."""
    pages = _structured(spark, sf_dir)
    n = F.regexp_extract("document_id", r"(\d+)", 1).cast("long")
    bare = F.concat(F.lit("PART "), F.col("page_number"), F.lit(" - GENERAL\n\nARTICLE 5\n\nSECTION 09 65 00 FLOORING"))
    k = (n + F.col("page_number")) % 3
    return pages.withColumns({"text": F.when(n % 25 == 7, bare).otherwise(F.col("text")), "method": F.when(k == 0, "parse").when(k == 1, "ocr").otherwise("hybrid"), "confidence": F.when(k == 0, 1.0).otherwise(0.5 + (n % 45) / 97.0)})


_BARE = _STRUCTURED.replace("lines1 AS (", "lines2 AS (", 1) + """,
lines1 AS (
  SELECT document_id, i, page_number, line FROM lines2 WHERE CAST(substring(document_id, 5) AS BIGINT) % 25 <> 7
  UNION ALL SELECT document_id, unnest([0, 1, 2, 3, 4]) AS i, page_number, unnest(['PART ' || page_number || ' - GENERAL', '', 'ARTICLE 5', '', 'SECTION 09 65 00 FLOORING']) AS line
  FROM (SELECT DISTINCT document_id, page_number FROM lines2 WHERE CAST(substring(document_id, 5) AS BIGINT) % 25 = 7))"""

_CASCADE = f"""{_SECTIONS.replace(_STRUCTURED, _BARE)},
page AS (SELECT document_id, page_number, string_agg(line, chr(10) ORDER BY i) AS text, CAST(substring(document_id, 5) AS BIGINT) AS d FROM lines1 GROUP BY 1, 2),
read AS (SELECT document_id, page_number, text, CASE (d + page_number) % 3 WHEN 0 THEN 'parse' WHEN 1 THEN 'ocr' ELSE 'hybrid' END AS method, CAST(CASE (d + page_number) % 3 WHEN 0 THEN 1.0 ELSE 0.5 + (d % 45) / 97.0 END AS DOUBLE) AS confidence FROM page),
solid AS (SELECT DISTINCT document_id FROM sections WHERE {_strip('body_text')} <> ''),
para0 AS (SELECT document_id, page_number, unnest(l) AS para, unnest(range(len(l))) AS i FROM (SELECT document_id, page_number, regexp_split_to_array(text, '\\n\\s*\\n') AS l FROM page ANTI JOIN solid USING (document_id))),
bodies AS (
  SELECT document_id, section_index, heading_text, body_text, page_start, page_end, confidence FROM sections SEMI JOIN solid USING (document_id)
  UNION ALL SELECT document_id, row_number() OVER (PARTITION BY document_id ORDER BY page_number, i) - 1, NULL, {_strip('para')}, page_number, page_number, NULL FROM para0 WHERE {_strip('para')} <> '')"""


@_query(f"""WITH RECURSIVE {_merged_sql(SMALL, _CASCADE, "bodies")},
src AS (SELECT struct_pack(d := document_id, g := group_id) AS key, text FROM merged), {_split_sql(SMALL)},
raw AS (SELECT document_id, row_number() OVER (PARTITION BY document_id ORDER BY group_id, part) AS part, title, pieces.text, page_start, page_end, confidence FROM pieces JOIN merged ON key.d = document_id AND key.g = group_id),
{_led_sql(SMALL, ", title, page_start, page_end, confidence")},
summed AS (SELECT document_id, CASE WHEN count(DISTINCT method) = 1 THEN min(method) ELSE 'hybrid' END AS extracted_method, avg(confidence) AS mean, round(100.0 * count(*) FILTER (length({_strip('text')}) < 40) / count(*), 2) AS percent_empty_pages FROM read GROUP BY 1),
chunks AS (
  SELECT l.document_id, CAST(part AS INTEGER) AS chunk_index, CAST(count(*) OVER (PARTITION BY l.document_id) AS INTEGER) AS total_chunks, title AS section_title, chunk_text, CAST(len({_words('chunk_text')}) AS INTEGER) AS chunk_word_count, page_start, page_end,
    l.confidence AS section, extracted_method, percent_empty_pages, mean, extracted_method IN ('ocr', 'hybrid') AS ocr_used,
    (SELECT round(avg(r.confidence), 4) FROM read r WHERE r.document_id = l.document_id AND r.page_number BETWEEN l.page_start AND l.page_end AND r.method <> 'parse') AS seen
  FROM led l JOIN summed s ON s.document_id = l.document_id),
rated AS (SELECT *, round(least(1.0, greatest(0.0, mean * CASE WHEN section IS NULL THEN 0.9 ELSE 0.65 + 0.35 * section END * CASE WHEN chunk_word_count < {SMALL.min_words} THEN 0.88 ELSE 1.0 END)), 4) AS score FROM chunks)
SELECT document_id, chunk_index, total_chunks, section_title, chunk_text, chunk_word_count, page_start, page_end, round(section, 6) AS section_detection_confidence, extracted_method, round(mean, 6) AS confidence, CAST(percent_empty_pages AS DOUBLE) AS percent_empty_pages,
  CASE WHEN ocr_used THEN seen END AS ocr_confidence, CAST(score AS DOUBLE) AS chunk_quality_score, score < 0.45 OR coalesce(section < 0.42, false) AS low_quality_chunk,
  mean < 0.72 OR percent_empty_pages >= 18 OR (ocr_used AND mean < 0.65) AS document_needs_review FROM rated""")
def structured_chunks(spark, sf_dir):
    """Documents of many pages with headings, read in different ways, through the whole cascade to quality columns."""
    pages = _headings_only(spark, sf_dir)
    chunks = chunking.chunk_documents(pages, sections.detect_sections(pages), SMALL)
    out = quality.with_quality(chunks, quality.document_summary(pages), SMALL.min_words)
    columns = ("document_id", "chunk_index", "total_chunks", "section_title", "chunk_text", "chunk_word_count", "page_start", "page_end", "extracted_method", "percent_empty_pages", "ocr_confidence", "low_quality_chunk", "document_needs_review")
    return out.select(*columns, F.round("section_detection_confidence", 6).alias("section_detection_confidence"), F.round("confidence", 6).alias("confidence"), "chunk_quality_score")


# Classes ------------------------------------------------------------------------------------------------------

def _class_docs(spark, sf_dir) -> DataFrame:
    """documents with rule words before their text, by document number."""
    d = F.col("doc_id")
    lead = F.when(d % 7 == 0, "SECTION 1\nPART 2 - PRODUCTS\n09 65 00 materials and execution\n").when(d % 7 == 1, "Transmittal\nissued for review cc: all\n").when(d % 7 == 2, "Dear all,\nsubject: submittal, product data and shop drawing\n").when(d % 7 == 3, "Review comment\nrevise and resubmit\n").otherwise("")
    name = F.concat(F.when(d % 5 == 0, "Submittal_").when(d % 5 == 1, "RFI review ").when(d % 5 == 2, "spec_section_").otherwise("doc_"), d, F.lit(".txt"))
    return _table(spark, sf_dir, "documents").select("doc_id", name.alias("source_filename"), F.concat(lead, F.col("text")).alias("text"))


_CLASS = """cls AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'Submittal_' WHEN 1 THEN 'RFI review ' WHEN 2 THEN 'spec_section_' ELSE 'doc_' END || doc_id || '.txt' AS source_filename,
  CASE doc_id % 7 WHEN 0 THEN 'SECTION 1' || chr(10) || 'PART 2 - PRODUCTS' || chr(10) || '09 65 00 materials and execution' || chr(10) WHEN 1 THEN 'Transmittal' || chr(10) || 'issued for review cc: all' || chr(10) WHEN 2 THEN 'Dear all,' || chr(10) || 'subject: submittal, product data and shop drawing' || chr(10) WHEN 3 THEN 'Review comment' || chr(10) || 'revise and resubmit' || chr(10) ELSE '' END || text AS text FROM documents)"""


def _sum(parts: list[str]) -> str:
    return " + ".join(parts) or "0.0"


def _name_sql(c: str) -> str:
    return _sum([f"CASE WHEN contains(lower(source_filename), '{s}') THEN {w} ELSE 0.0 END" for s, w in classify.FILENAME_HINTS[c].items()])


def _key_sql(c: str) -> str:
    return _sum([f"least(4.0, 2.0 * ln(1 + (length(lower(text)) - length(replace(lower(text), '{p}', ''))) / {len(p)}))" for p in classify.KEYWORDS[c]])


_ALL = (*classify.CATEGORIES, "mixed_package")


@_query(f"WITH {_CLASS} SELECT doc_id, {', '.join(f'CAST({_name_sql(c)} AS DOUBLE) AS {c}' for c in _ALL)} FROM cls")
def filename_scores(spark, sf_dir):
    d = _class_docs(spark, sf_dir)
    return d.select("doc_id", *(s.alias(c) for c, s in classify.filename_scores(F.col("source_filename")).items()))


@_query(f"WITH {_CLASS} SELECT doc_id, {', '.join(f'round({_key_sql(c)}, 6) AS {c}' for c in _ALL)} FROM cls")
def keyword_scores(spark, sf_dir):
    d = _class_docs(spark, sf_dir)
    return d.select("doc_id", *(F.round(s, 6).alias(c) for c, s in classify.keyword_scores(F.col("text")).items()))


_LINES = "list_filter(string_split(text, chr(10)), lambda x: true)"
_FORM = f"""{_CLASS}, cl AS (SELECT doc_id, regexp_replace(regexp_replace(unnest(string_split(text, chr(10))), '^\\s+', ''), '\\s+$', '') AS s FROM cls),
hl AS (SELECT doc_id, count(*) FILTER ({_SCORE} >= 2.5) AS headings FROM cl GROUP BY 1),
form AS (SELECT c.*, CAST(len(regexp_extract_all(text, '(?im)^(section|part|division)\\s+[\\d.]+')) AS INTEGER) AS spec_hits, CAST(len(regexp_extract_all(text, '(?m)^\\d{{2}}\\s?\\d{{2}}\\s?\\d{{2}}')) AS INTEGER) AS csi_hits, CAST(headings AS INTEGER) AS headings, contains(substring(lower(text), 1, 2500), 'transmittal') AS early,
  len(string_split(text, chr(10))) - CASE WHEN suffix(text, chr(10)) OR text = '' THEN 1 ELSE 0 END AS n_lines FROM cls c JOIN hl USING (doc_id)),
structure AS (SELECT *, CASE WHEN spec_hits > 0 OR csi_hits > 0 OR headings > 3 THEN least(6.0, 1.5 * spec_hits + 1.0 * csi_hits + 0.2 * headings) ELSE 0.0 END AS f_spec, CASE WHEN early AND n_lines < 80 THEN 2.0 ELSE 0.0 END AS f_trans FROM form)"""


@_query(f"WITH {_FORM} SELECT doc_id, spec_hits, csi_hits, headings, round(CAST(f_spec AS DOUBLE), 6) AS specification, CAST(f_trans AS DOUBLE) AS transmittal FROM structure")
def structure_scores(spark, sf_dir):
    d = _class_docs(spark, sf_dir)
    c = d.select("doc_id", *(v.alias(k) for k, v in classify.structure_counts(F.col("text")).items()))
    s = classify.structure_scores(*(F.col(k) for k in ("spec_hits", "csi_hits", "headings", "lines", "early")))
    return c.select("doc_id", "spec_hits", "csi_hits", "headings", F.round(s["specification"], 6).alias("specification"), s["transmittal"].alias("transmittal"))


_TOTALS = ", ".join(f"CAST({_name_sql(c)} AS DOUBLE) + CAST({_key_sql(c)} AS DOUBLE) + CAST({dict(specification='f_spec', transmittal='f_trans').get(c, '0.0')} AS DOUBLE) AS {c}" for c in classify.CATEGORIES)
_LONG = " UNION ALL ".join(f"SELECT doc_id, '{c}' AS category, {i} AS place, {c} AS score FROM totals" for i, c in enumerate(classify.CATEGORIES))


@_query(f"""WITH {_FORM}, totals AS (SELECT doc_id, text, {_TOTALS} FROM structure), long AS ({_LONG}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, place) AS r, sum(score) OVER (PARTITION BY doc_id) AS total FROM long),
top AS (SELECT doc_id, max(category) FILTER (r = 1) AS category, max(score) FILTER (r = 1) AS b, max(score) FILTER (r = 2) AS s, max(total) AS total FROM ranked GROUP BY 1)
SELECT doc_id, CASE WHEN {_strip('text')} = '' OR b <= 0 THEN 'unknown' WHEN s >= 0.55 * b AND b > 3 THEN 'mixed_package' WHEN b < 1 THEN 'unknown' ELSE category END AS category,
  round(CAST(CASE WHEN {_strip('text')} = '' THEN 0.1 WHEN b <= 0 THEN 0.15 WHEN s >= 0.55 * b AND b > 3 THEN least(0.95, b / (b + s + 1e-6)) WHEN b < 1 THEN least(0.5, b / (total + 1e-6)) ELSE least(0.99, b / (total + 1e-6)) END AS DOUBLE), 4) AS confidence FROM top JOIN totals USING (doc_id)""")
def classify_documents(spark, sf_dir):
    return classify.classify(_class_docs(spark, sf_dir)).select("doc_id", "category", "confidence")


def _evidence_sql() -> str:
    """A row for each rule that speaks, in the order of the rules."""
    n = lambda p: f"(length(lower(text)) - length(replace(lower(text), '{p}', ''))) / {len(p)}"
    found = [(f"'filename:{p}'", c, f"CASE WHEN contains(lower(source_filename), '{p}') THEN {w} ELSE 0.0 END") for c, hints in classify.FILENAME_HINTS.items() for p, w in hints.items()]
    found += [(f"'keyword:{c}:{p[:24]}'", c, f"least(4.0, 2.0 * ln(1 + {n(p)}))") for c, phrases in classify.KEYWORDS.items() for p in phrases]
    found += [("'structure:spec_headings'", "specification", "f_spec"), ("'structure:short_transmittal'", "transmittal", "f_trans")]
    return " UNION ALL ".join(f"SELECT doc_id, {i} AS i, {rule} AS rule_id, '{c}' AS category, CAST({w} AS DOUBLE) AS weight FROM structure WHERE {_strip('text')} <> ''" for i, (rule, c, w) in enumerate(found))


@_query(f"""WITH {_FORM}, totals AS (SELECT doc_id, text, {_TOTALS} FROM structure), long AS ({_LONG}),
top AS (SELECT doc_id, max(score) FILTER (r = 1) AS b, max(score) FILTER (r = 2) AS s FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, place) AS r FROM long) GROUP BY 1),
rules AS ({_evidence_sql()} UNION ALL SELECT doc_id, 1000000, 'meta:mixed_signals', 'mixed_package', b FROM top JOIN totals USING (doc_id) WHERE s >= 0.55 * b AND b > 3 AND {_strip('text')} <> ''),
placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(weight, 9) DESC, i) AS place FROM rules WHERE weight > 0)
SELECT doc_id, CAST(place - 1 AS INTEGER) AS place, rule_id, category, round(weight, 6) AS weight FROM placed WHERE place <= 25""")
def classification_evidence(spark, sf_dir):
    # outer, as the filter inferred for the other form is pushed to the texts and computes all of them again
    found = classify.classify(_class_docs(spark, sf_dir)).select("doc_id", F.posexplode_outer("evidence").alias("place", "e"))
    return found.filter("place is not null").select("doc_id", "place", "e.rule_id", "e.category", F.round("e.weight", 6).alias("weight"))


@_query(f"""WITH RECURSIVE {_chunk_sql(SMALL)} SELECT 'page_span' AS rule, CAST(0 AS BIGINT) AS violations UNION ALL SELECT 'digest', 0 UNION ALL SELECT 'score', 0 UNION ALL SELECT 'title', 0
  UNION ALL SELECT 'index', count(*) FILTER (chunk_index NOT BETWEEN 1 AND total_chunks) FROM chunks UNION ALL SELECT 'short_text', count(*) FILTER (length(chunk_text) < 40) FROM chunks""")
def constraint_checks(spark, sf_dir):
    rules = checks.CHUNK_RULES | {"short_text": "length(chunk_text) >= 40"}
    return checks.violations(_chunked(spark, sf_dir, SMALL).drop("confidence"), rules)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from loomdoc.plans import file_queries

    return _QUERIES | file_queries.queries()


def oracle_sql() -> dict[str, str]:
    from loomdoc.plans import file_queries

    return _SQL | file_queries.oracle_sql()
