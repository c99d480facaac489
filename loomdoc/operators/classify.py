"""Document classes by explainable rules: file names, phrases, structure."""

from __future__ import annotations

from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomdoc.functions.text import WS, base_name
from loomdoc.operators.headings import is_heading, may_be_heading

# Categories in the order that settles ties, then the two that no rule can win.
CATEGORIES = ("specification", "submittal", "transmittal", "review_comments", "correspondence")
# Substrings of file names and their weights.
FILENAME_HINTS = {
    "submittal": {"submittal": 3.0, "submit": 1.5},
    "specification": {"spec": 2.0, "specification": 3.0, "section": 1.0, "division": 1.5},
    "transmittal": {"transmittal": 3.0, "transmitt": 2.0},
    "review_comments": {"rfi": 2.0, "review": 1.5, "comment": 1.5, "ballot": 1.0},
    "correspondence": {"correspondence": 2.5, "letter": 1.0, "memo": 1.2},
    "mixed_package": {"package": 1.5, "volume": 1.0},
}
# Phrases counted in lower-cased text.
KEYWORDS = {
    "specification": ("section", "division", "part", "specification", "materials", "execution", "quality assurance", "related documents", "summary", "references"),
    "submittal": ("submittal", "shop drawing", "product data", "certificates", "test reports", "submit for review", "resubmittal"),
    "transmittal": ("transmittal", "transmitted", "cc:", "distribution", "record document", "issued for"),
    "review_comments": ("review", "comment", "resolution", "rfi", "ballot", "disapproved", "revise and resubmit", "approved as noted"),
    "correspondence": ("dear", "sincerely", "regards", "cc:", "subject:", "reference:", "pursuant"),
    "mixed_package": ("table of contents", "appendix", "attachment", "exhibit", "volume", "book"),
}
# Line patterns of specifications. (?d): only \n ends a line.
SPEC_LINE, CSI_LINE = r"(?imd)^(section|part|division)\s+[\d.]+", r"(?md)^\d{2}\s?\d{2}\s?\d{2}"
_LINE_ENDS = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"


def occurrences(text: Column, phrase: str | Column) -> Column:
    """How often the phrase occurs; bytes tell, as what goes are whole phrases. Most texts lack most phrases, which contains() sees sooner."""
    p = F.lit(phrase) if isinstance(phrase, str) else phrase
    n = ((F.octet_length(text) - F.octet_length(F.replace(text, p, F.lit("")))) / F.octet_length(p)).cast("int")
    return F.when(text.isNull() | text.contains(p), n).otherwise(0)


def keyword_weight(n: Column) -> Column:
    return F.least(F.lit(4.0), 2.0 * F.log1p(n))


def filename_scores(name: Column) -> dict[str, Column]:
    return _hinted(F.lower(base_name(name)))


def _hinted(low: Column) -> dict[str, Column]:
    return {c: reduce(Column.__add__, (F.when(low.contains(s), w).otherwise(0.0) for s, w in hints.items())) for c, hints in FILENAME_HINTS.items()}


def keyword_scores(text: Column) -> dict[str, Column]:
    low = F.lower(text)
    return {c: reduce(Column.__add__, (keyword_weight(occurrences(low, p)) for p in phrases)) for c, phrases in KEYWORDS.items()}


def text_parts(text: Column) -> Column:
    """Lines by every line end that Python knows, with an empty last one where a line end is last."""
    return F.split(text, _LINE_ENDS, -1)


def structure_counts(text: Column, parts: Column | None = None, low: Column | None = None) -> dict[str, Column]:
    """parts, low: columns that already hold text_parts(text) and the text in lower case."""
    parts = text_parts(text) if parts is None else parts
    return {
        "spec_hits": F.regexp_count(text, F.lit(SPEC_LINE)), "csi_hits": F.regexp_count(text, F.lit(CSI_LINE)),
        "headings": F.size(F.filter(parts, lambda line: may_be_heading(line) & is_heading(line))),
        "lines": F.size(parts) - F.when(F.element_at(parts, -1) == "", 1).otherwise(0),
        "early": F.substring(F.lower(text) if low is None else low, 1, 2500).contains("transmittal"),
    }


def structure_scores(spec: Column, csi: Column, headings: Column, lines: Column, early: Column) -> dict[str, Column]:
    hit = (spec > 0) | (csi > 0) | (headings > 3)
    return {
        "specification": F.when(hit, F.least(F.lit(6.0), 1.5 * spec + 1.0 * csi + 0.2 * headings)).otherwise(0.0),
        "transmittal": F.when(early & (lines < 80), 2.0).otherwise(0.0),
    }


class Classifier(Protocol):
    """What can stand in for the rules: a table in, the same table with category, confidence, scores, evidence, classifier_id out."""

    def __call__(self, docs: DataFrame, name_col: str = "source_filename", text_col: str = "text") -> DataFrame: ...


def untrained(docs: DataFrame, name_col: str = "source_filename", text_col: str = "text") -> DataFrame:
    """A place for a model: everything is unknown, at confidence 0."""
    return docs.selectExpr("*", "'unknown' as category", "0.0D as confidence", "cast(map() as map<string, double>) as scores", "cast(array() as array<struct<rule_id: string, category: string, weight: double, detail: string>>) as evidence", "'ml_stub' as classifier_id")


def classify_pages(pages: DataFrame, files: DataFrame, classifier: Classifier | None = None) -> DataFrame:
    """Classes of whole documents: pages joined by blank lines, with the name from files."""
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "text"))), lambda p: p["text"]), "\n\n")
    docs = pages.groupBy("document_id").agg(whole.alias("text")).join(files.select("document_id", "source_filename"), "document_id")
    return (classifier or classify)(docs)


def classify(docs: DataFrame, name_col: str = "source_filename", text_col: str = "text") -> DataFrame:
    """docs with category, confidence, scores (a map) and evidence (the 25 heaviest, stable among equals).

    What takes a pass over the text is a column of its own that later ones refer to several times, so that the optimizer
    keeps it as computed; a struct would be taken apart and its fields computed wherever they are used.
    """
    name, text = F.coalesce(F.col(name_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    at = {p: i for i, p in enumerate(dict.fromkeys(p for phrases in KEYWORDS.values() for p in phrases))}
    once = docs.withColumns({"_rule_low": F.lower(text), "_rule_parts": text_parts(text), "_rule_name": F.lower(base_name(name))})
    low_name, n, w = F.col("_rule_name"), F.col("_rule_n"), F.col("_rule_w")
    # one short array of all phrases: each is counted once
    found = F.transform(F.array(*map(F.lit, at)), lambda p: occurrences(F.col("_rule_low"), p))
    counted = once.withColumns({"_rule_n": found, "_rule_blank": text.rlike(rf"\A{WS}*\z"), **{f"_rule_{k}": v for k, v in structure_counts(text, F.col("_rule_parts"), F.col("_rule_low")).items()}})
    s = {k: F.col(f"_rule_{k}") for k in ("spec_hits", "csi_hits", "headings", "lines", "early")}
    weighed = counted.withColumns({"_rule_w": F.transform(n, keyword_weight), **{f"_rule_f_{c}": f for c, f in structure_scores(*s.values()).items()}})
    by_name = _hinted(low_name)
    by_word = {c: reduce(Column.__add__, (w[at[p]] for p in phrases)) for c, phrases in KEYWORDS.items()}
    by_form = {c: F.col(f"_rule_f_{c}") for c in ("specification", "transmittal")}
    total = {c: by_name[c] + by_word[c] + by_form.get(c, F.lit(0.0)) for c in (*CATEGORIES, "mixed_package")}
    scored = weighed.withColumns({f"_rule_t_{c}": v for c, v in total.items()})
    t = {c: F.col(f"_rule_t_{c}") for c in total}
    ranked = F.array_sort(F.array(*(F.struct((-t[c]).alias("minus"), F.lit(i).alias("place"), F.lit(c).alias("category")) for i, c in enumerate(CATEGORIES))))
    scored = scored.withColumn("_rule_r", ranked)
    best, second = -F.col("_rule_r")[0]["minus"], -F.col("_rule_r")[1]["minus"]
    every = reduce(Column.__add__, (t[c] for c in CATEGORIES))
    sure = best / (every + 1e-6)
    mixed = (second >= 0.55 * best) & (best > 3)
    blank = F.col("_rule_blank")
    category = F.when(blank | (best <= 0), "unknown").when(mixed, "mixed_package").when(best < 1, "unknown").otherwise(F.col("_rule_r")[0]["category"])
    confidence = F.when(blank, 0.1).when(best <= 0, 0.15).when(mixed, F.least(F.lit(0.95), best / (best + second + 1e-6))).when(best < 1, F.least(F.lit(0.5), sure)).otherwise(F.least(F.lit(0.99), sure))
    scores = F.map_from_arrays(F.array(*map(F.lit, (*total, "unknown"))), F.array(*(F.round(t[c], 4) for c in total), F.lit(0.0)))
    item = lambda rule, c, w, detail: F.when(w > 0, F.struct(F.lit(rule).alias("rule_id"), F.lit(c).alias("category"), w.alias("weight"), detail.alias("detail")))
    found = [item(f"filename:{p}", c, F.when(low_name.contains(p), w).otherwise(0.0), F.lit(f'Filename contains "{p}" → +{w} toward {c}')) for c, hints in FILENAME_HINTS.items() for p, w in hints.items()]
    for c, phrases in KEYWORDS.items():
        for p in phrases:
            i = at[p]
            found.append(item(f"keyword:{c}:{p[:24]}", c, w[i], F.format_string(f'Phrase "{p}" appears ~%d time(s) → +%.2f toward {c}', n[i], w[i])))
    found.append(item("structure:spec_headings", "specification", by_form["specification"], F.format_string("Found %d SECTION/PART/DIVISION-style headings, %d CSI-style prefixes, %d heading-like lines → +%.2f", s["spec_hits"], s["csi_hits"], s["headings"], by_form["specification"])))
    found.append(item("structure:short_transmittal", "transmittal", by_form["transmittal"], F.lit("Early 'transmittal' mention in a relatively short document → +2.0")))
    found.append(item("meta:mixed_signals", "mixed_package", F.when(mixed, best).otherwise(0.0), F.format_string("Top scores close (%s=%.2f, %s=%.2f) → mixed_package", F.col("_rule_r")[0]["category"], best, F.col("_rule_r")[1]["category"], second)))
    evidence = F.array_compact(F.array(*found))
    order = F.transform(evidence, lambda e, i: F.struct((-F.abs(e["weight"])).alias("minus"), i.alias("place"), e.alias("e")))
    top = F.transform(F.slice(F.array_sort(order), 1, 25), lambda x: x["e"])
    empty = F.slice(top, 1, 0)
    return scored.withColumns({"category": category, "confidence": F.round(confidence, 4), "scores": F.when(blank, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))).otherwise(scores), "evidence": F.when(blank, empty).otherwise(top), "classifier_id": F.lit("heuristic_v1")}).drop("_rule_low", "_rule_parts", "_rule_name", "_rule_n", "_rule_w", "_rule_blank", "_rule_r", *(f"_rule_{k}" for k in s), *(f"_rule_f_{c}" for c in by_form), *(f"_rule_t_{c}" for c in t))
