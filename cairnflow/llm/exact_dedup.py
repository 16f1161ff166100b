"""Exact deduplication by content hash, with the bytes compared inside each group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnflow.llm.common import keyed_texts, written


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by the 128-bit MD5 of the text, without the text: of a group that holds a third of all rows, each
    task sends one row. Only the texts of digests that more than one row has are then grouped by their bytes, so texts
    that collide stay apart; copies meet inside the tasks there too. The decision goes back to the rows by both
    digests, a join whose hot keys adaptive execution splits.

    keep: whether the smallest or the largest id of equal texts stays. A null text counts as empty. A null id never
    wins against another id; a group of null ids alone has keep_id null and keeps them all. Rows that repeat both id
    and text are the same row to this operator: all of them count in group_size and share the decision. No rows give
    none; other columns than the id and the text are not read.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    texts = keyed_texts(docs, id_col, text_col).withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    rows = texts.select("doc_id", "digest", F.unhex(F.sha2("text", 256)).alias("sha"))
    # written, so that its size is known before the texts are planned: where it is small they stay in their tasks
    several = written(texts.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"), "repeated-digests")
    groups = (
        texts.join(several, "digest")
        .groupBy("digest", "text")
        .agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select(F.col("digest").alias("of"), F.unhex(F.sha2("text", 256)).alias("as"), "keep_id", "group_size")
    )
    found = rows.join(groups, (F.col("digest") == F.col("of")) & (F.col("sha") == F.col("as")), "left").withColumn("alone", F.col("of").isNull())
    return found.select("doc_id", F.when(F.col("alone"), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), "sha").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )
