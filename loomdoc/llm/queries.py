"""The queries of this subpackage: each applies its operator to a whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomdoc.llm.common import table


def _path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomdoc.llm.secrets import scan

    return scan(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomdoc.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), _path("byte_bpe_50k.json"), budget=512, cuts=True)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomdoc.llm.substring_dedup import removed_words

    return removed_words(table(spark, sf_dir, "documents"), window=20)


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomdoc.llm.topk_nra import search

    return search(table(spark, sf_dir, "embeddings"), every=100, k=10, scale=1024)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomdoc.llm.quality import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op6_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomdoc.llm.multi_index import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomdoc.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), distance=4, shingle=4)


def op8_bitplane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomdoc.llm.bitplane import read_ids, write_ids

    return read_ids(spark, write_ids(table(spark, sf_dir, "documents"), _path("byte_bpe_50k.json"), end_id=2))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomdoc.llm.packing import pack_sequences

    return pack_sequences(table(spark, sf_dir, "documents"), _path("byte_bpe_50k.json"), size=2048, end_id=1)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomdoc.llm.spm_bpe import bpe_round_trip

    return bpe_round_trip(table(spark, sf_dir, "documents"), _path("byte_bpe_multi_50k.tiktoken"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_secrets, op2_token_counts, op3_substring_dedup, op4_topk, op5_quality, op6_embedding_neardup, op7_simhash, op8_bitplane_ids, op9_packing, op10_byte_bpe)}


#: Vectors that take part, as lists of integers.
_INTEGERS = """v AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(1024 * x)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""

_OP4 = f"""WITH {_INTEGERS}, s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""

_OP3 = """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(len(w) - 19)) AS i FROM w WHERE len(w) >= 20),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i + 1:i + 20], ' ') ORDER BY doc_id, i) AS r FROM starts),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM ranked WHERE r > 1),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""

_OP6 = """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1), degree AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM component LEFT JOIN degree USING (vec_id)"""


def oracle_sql() -> dict[str, str]:
    """The queries that SQL can express; tokenizers, XXH64 and fitted models are beyond it and are tested by brute force."""
    return {"op3_substring_dedup": _OP3, "op4_topk": _OP4, "op6_embedding_neardup": _OP6}
