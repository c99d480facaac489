"""From raw documents to packed training sequences, in five stages.

Each stage takes all that the one before kept: the quality classifier drops what it rejects, SimHash near-dedup leaves one
document of each group linked by a similarity of five-word shingles of 0.8 or more, passages that occur earlier lose their later copies,
secrets are replaced by a mark, and what is left is packed into sequences of 2048 tokens. Stages meet as Parquet tables;
run() leaves them to Spark.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdoc.llm.common import free_name, remove, shared_dir, table
from loomdoc.llm.packing import pack_sequences
from loomdoc.llm.quality import keep_good
from loomdoc.llm.secrets import redact
from loomdoc.llm.simhash import keep_one
from loomdoc.llm.substring_dedup import remove_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated score is 0.3 or more; without labels all stay."""
    return keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked by a Jaccard similarity of five-word shingles of 0.8 or more, one document.

    It is the one with the smallest id. Rows that share an id are documents of their own.
    """
    return keep_one(docs, similarity=0.8, shingle=5)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows of 20 that start earlier; n_chars, where there is one, follows.

    Rows go only if they had words and every one was removed.
    """
    had = free_name(docs.columns, "had_text_")
    kept = remove_repeats(docs.withColumn(had, F.expr("coalesce(text, '') <> ''")), window=20)
    kept = kept.filter(F.expr(f"text is null or text <> '' or not {had}"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*(f"`{c}`" for c in docs.columns))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by [SECRET]; no document goes."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts' ids and their places in sequences of 2048."""
    import public_tokenizers

    return pack_sequences(docs, public_tokenizers.path("byte_bpe_50k.json"), size=2048, end_id=1)


STAGES = [("quality", quality), ("near_duplicates", near_duplicate), ("substrings", substrings), ("secrets", secrets), ("packing", packing)]

#: The classifier's weights and the tokenizer's merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's table is written to the shared folder, read by the next and then removed.

    The one before the last stays, as the rows returned are computed from it when they are read.
    """
    at = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
        if before:
            remove(spark, before)
        before = f"{at}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
