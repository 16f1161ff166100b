"""Tables on disk, their validation, and the registry's roles over the sample tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairnflow.model import TABLES, State, Table


class SchemaMismatch(ValueError):
    """A table on disk is not the declared one; the problems are listed."""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schema_problems(df: DataFrame, table: Table) -> list[str]:
    """Missing, unexpected and differently typed columns; files are never altered."""
    want, have = {f.name: f for f in table.schema}, {f.name: f for f in df.schema}
    out = [f"{table.name}: missing column {c}" for c in want if c not in have]
    out += [f"{table.name}: unexpected column {c}" for c in have if c not in want]
    return out + [f"{table.name}.{c}: {have[c].dataType.simpleString()} instead of {want[c].dataType.simpleString()}" for c in want if c in have and have[c].dataType != want[c].dataType]


def data_problems(df: DataFrame, table: Table, others: dict[str, DataFrame] | None = None) -> DataFrame:
    """constraint, violations: null, key, unique and reference violations in one row each, none where all hold."""
    nulls = df.agg(*[F.count_if(F.col(f.name).isNull()).alias(f"not null {f.name}") for f in table.schema if not f.nullable])
    out = nulls.unpivot([], list(nulls.columns), "constraint", "violations")
    for label, columns in (("key", table.key), *(("unique", (c,)) for c in table.unique)):
        twice = df.dropna(subset=list(columns)).groupBy(*columns).count().where("count > 1")
        out = out.unionByName(twice.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(f"{label} {', '.join(columns)}").alias("constraint"), "violations"))
    for column, (other, key) in table.references.items():
        if others and other in others:
            lost = df.where(F.col(column).isNotNull()).join(others[other].select(F.col(key).alias(column)), column, "left_anti")
            out = out.unionByName(lost.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(f"reference {column}").alias("constraint"), "violations"))
    return out.where("violations > 0")


def init(spark: SparkSession, root: str) -> None:
    """Create what is missing under ``root`` as empty tables and validate what is there."""
    problems = []
    for name, table in TABLES.items():
        path = f"{root}/{name}"
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            problems += schema_problems(spark.read.parquet(path), table)
        else:
            spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in table.schema])).write.parquet(path)
    if problems:
        raise SchemaMismatch("; ".join(problems))


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


# --- the registry's roles over the sample tables ---


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as artifacts: state, lane, sizes, digests and serials follow from the id."""
    d = read(spark, sf_dir, "documents")
    state = F.col("doc_id") % 7
    return d.select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("project"),
        F.concat("lang", F.lit("-"), F.expr("doc_id % 50")).alias("target_name"),
        F.col("lang").alias("subdir"),
        state.cast("int").alias("state"),
        (F.expr("doc_id div 7") % 2).cast("int").alias("lane"),
        F.col("n_chars").alias("size"),
        F.sha2("text", 256).alias("blob_sha256"),
        (F.col("doc_id") % 11 == 0).alias("yanked"),
        F.expr("doc_id div 10").alias("serial"),
        (F.col("doc_id") + 1).alias("change_seq"),
        F.when(state == int(State.DELETED), F.timestamp_add("MINUTE", F.col("doc_id").cast("int"), at("2024-01-01 00:00:00"))).alias("deleted_at"),
        F.timestamp_add("MINUTE", F.col("doc_id").cast("int"), at("2024-01-01 00:00:00")).alias("updated_at"),
    )


#: The same view for DuckDB.
ARTIFACTS_SQL = """artifacts AS (
  SELECT doc_id AS id, source AS project, lang || '-' || (doc_id % 50) AS target_name, lang AS subdir, CAST(doc_id % 7 AS INTEGER) AS state,
         CAST((doc_id // 7) % 2 AS INTEGER) AS lane, n_chars AS size, sha256(text) AS blob_sha256, doc_id % 11 = 0 AS yanked, doc_id // 10 AS serial, doc_id + 1 AS change_seq,
         CASE WHEN doc_id % 7 = 6 THEN TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) END AS deleted_at,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS updated_at
  FROM documents)"""
