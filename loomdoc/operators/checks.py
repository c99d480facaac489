"""Constraints of the data model as conditions on rows, counted in one pass or enforced in the plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TITLE_CHARS = 4000

#: SQL conditions that chunk rows meet; null counts as met, as optional fields may be absent.
CHUNK_RULES = {
    "page_span": "page_start >= 1 and page_end >= page_start",
    "digest": "document_id rlike '^[0-9a-f]{64}$'",
    "score": "chunk_quality_score between 0 and 1",
    "title": f"length(section_title) <= {TITLE_CHARS}",
    "index": "chunk_index between 1 and total_chunks",
}
DOCUMENT_RULES = {
    "confidence": "confidence between 0 and 1",
    "percent_empty_pages": "percent_empty_pages between 0 and 100",
}


def violations(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """rule and the number of rows that break it."""
    counts = df.agg(*(F.count_if(~F.coalesce(F.expr(c), F.lit(True))).alias(k) for k, c in rules.items()))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(k).alias("rule"), F.col(k).alias("violations")) for k in rules))).alias("r")).select("r.*")


def enforced(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """df; a row that breaks a rule fails the query with the rule's name when it is read."""
    ok = F.lit(True)
    for k, c in rules.items():
        ok = ok & F.when(F.coalesce(F.expr(c), F.lit(True)), F.lit(True)).otherwise(F.raise_error(F.lit(f"rule broken: {k}")).cast("boolean"))
    return df.filter(ok)
