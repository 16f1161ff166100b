"""The corpus pipeline: language ID, line dedup, near-dedup, secret scans, packing; each stage on all that the one
before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnflow.llm.common import forget, only_results_stay, written
from cairnflow.llm.langid import known_language
from cairnflow.llm.line_dedup import line_dedup
from cairnflow.llm.packing import pack
from cairnflow.llm.secrets import redact_secrets
from cairnflow.llm.simhash import near_dedup, one_of_each


def _as_documents(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, n_chars counted again where it is one of them."""
    return df.select(*[F.char_length("text").cast(like.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in like.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that one of the learned languages explains better than letters drawn alone do; the others go, and so
    do null texts and texts without a letter."""
    return known_language(docs, public_tokenizers.path("piece_bpe_32k.model"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are found in ten or more of them."""
    return _as_documents(line_dedup(docs, min_docs=10, min_chars=1), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest id (five-word shingles, similarity of 0.8 or more
    among the pairs whose fingerprints differ in at most six bits or that share a band of seeded minima)."""
    return one_of_each(docs, near_dedup(docs, size=5, distance=6, similarity=0.8))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return _as_documents(redact_secrets(docs), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place in it."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, size=1024, end_id=2)


STAGES = [("language_id", language_id), ("line_dedup", lines), ("near_dedup", near_duplicates), ("secret_scan", secret_scan), ("packing", packing)]

#: Language models, fingerprints and tokens are beyond SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each but the last written to the shared folder and read again; what a stage wrote
    beside its result, and the result of the stage before, are deleted once the next one is there."""
    docs = before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with only_results_stay(spark) as kept:
            docs = written(stage(spark, docs, sf_dir), name)
            kept.append(docs)
        forget(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
