"""One registered query for each operator of this subpackage, and its DuckDB statement where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cairnflow.llm.bpe import bpe_digest
from cairnflow.llm.exact_dedup import exact_dedup
from cairnflow.llm.langid import language_id
from cairnflow.llm.line_dedup import line_dedup_digest
from cairnflow.llm.packing import pack
from cairnflow.llm.pii import pii_scan
from cairnflow.llm.pivot_search import pivot_top_k
from cairnflow.llm.secrets import secret_scan
from cairnflow.llm.simhash import near_dedup_digest
from cairnflow.llm.toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), "toxic", folds=3, held_out=1, least=0.7)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup_digest(_documents(spark, sf_dir), size=3, distance=3)


def op3_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=50, k=5, scale=256.0)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_digest(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_documents(spark, sf_dir), keep="largest")


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return language_id(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), folds=4, held_out=2)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_digest(_documents(spark, sf_dir), min_docs=10, min_chars=1)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, size=1024, end_id=2)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_scan(_documents(spark, sf_dir))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(_documents(spark, sf_dir))


QUERIES |= {"op1_toxicity": op1_toxicity, "op6_langid": op6_langid, "op9_pii": op9_pii, "op10_secrets": op10_secrets, "op8_packing": op8_packing, "op3_pivot_search": op3_pivot_search, "op4_bpe": op4_bpe, "op2_simhash": op2_simhash, "op5_exact_dedup": op5_exact_dedup, "op7_line_dedup": op7_line_dedup}

ORACLE_SQL["op5_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

ORACLE_SQL["op7_line_dedup"] = r"""
WITH lines AS (
  SELECT row_number() OVER () AS row_no, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), keyed AS (
  SELECT row_no, doc_id, ls, list_transform(ls, lambda x: translate(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ks FROM lines
), frequent AS (
  SELECT k FROM (SELECT row_no, unnest(list_distinct(ks)) AS k FROM keyed) WHERE length(k) >= 1 GROUP BY k HAVING count(*) >= 10
), exploded AS (
  SELECT row_no, doc_id, unnest(ls) AS l, unnest(ks) AS k, generate_subscripts(ls, 1) AS pos FROM keyed
)
SELECT any_value(e.doc_id) AS doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
       sha256(coalesce(string_agg(e.l, chr(10) ORDER BY e.pos) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
FROM exploded e LEFT JOIN frequent f ON e.k = f.k GROUP BY e.row_no
"""

ORACLE_SQL["op3_pivot_search"] = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), queries AS (
  SELECT DISTINCT vec_id, v FROM vectors WHERE vec_id % 50 = 0
), scored AS (
  SELECT q.vec_id AS query_id, q.v, c.vec_id, coalesce(CAST(list_sum(list_transform(generate_series(1, len(q.v)), lambda i: q.v[i] * c.v[i])) AS BIGINT), 0) AS score
  FROM queries q JOIN vectors c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id, v ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
"""
