"""Landed remote snapshots: index and project pages as JSON text, parsed by declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnflow.functions.scalars import http_class, metadata_digest, normalized_name, yanked_flag, yanked_reason

INDEX = "struct<meta:struct<`_last-serial`:bigint>,projects:array<struct<name:string,`_last-serial`:bigint>>>"
FILE = "struct<filename:string,url:string,hashes:map<string,string>,`core-metadata`:string,`dist-info-metadata`:string,size:bigint,`upload-time`:string,`requires-python`:string,yanked:string>"
PROJECT = f"struct<meta:struct<`_last-serial`:bigint>,files:array<{FILE}>>"


class ProtocolError(ValueError):
    """A page lacks what it must have."""


def index_rows(pages: DataFrame, body: str = "body") -> DataFrame:
    """name, serial, last_serial of an index page; a page without its serial or projects gives one row with an error."""
    p = pages.select(F.from_json(body, INDEX).alias("p"))
    bad = F.col("p.meta.`_last-serial`").isNull() | F.col("p.projects").isNull()
    none = F.array(F.lit(None).cast("struct<name:string,`_last-serial`:bigint>"))
    rows = p.select(F.when(bad, "protocol").alias("error"), F.col("p.meta.`_last-serial`").alias("last_serial"), F.explode(F.when(bad, none).otherwise(F.col("p.projects"))).alias("x"))
    return rows.select(normalized_name(F.col("x.name")).alias("name"), F.col("x.`_last-serial`").alias("serial"), "last_serial", "error")


def project_files(pages: DataFrame, project: str = "project", body: str = "body", suffix: str = ".whl") -> DataFrame:
    """One row per file of the kind wanted, with its digests, metadata digest, yank and sizes."""
    p = pages.select(F.col(project).alias("project"), F.from_json(body, PROJECT).alias("p"))
    rows = p.select("project", F.col("p.meta.`_last-serial`").alias("serial"), F.explode("p.files").alias("f")).where(F.col("f.filename").endswith(suffix))
    digest = metadata_digest(F.col("f.`core-metadata`"), F.col("f.`dist-info-metadata`"))
    # strings of the page come without their quotes through a string schema: true, false and objects keep their form
    quoted = F.when(F.col("f.yanked").isin("true", "false"), F.col("f.yanked")).otherwise(F.concat(F.lit('"'), F.col("f.yanked"), F.lit('"')))
    return rows.select(
        "project", "serial", F.col("f.filename").alias("filename"), F.col("f.url").alias("url"), F.try_element_at("f.hashes", F.lit("sha256")).alias("sha256"),
        F.nullif(digest, F.lit("")).alias("metadata_sha256"), digest.isNotNull().alias("has_metadata"), F.col("f.size").alias("size"), F.col("f.`upload-time`").alias("upload_time"),
        F.col("f.`requires-python`").alias("requires"), F.coalesce(yanked_flag(quoted), F.lit(False)).alias("yanked"), yanked_reason(quoted).alias("yanked_reason"),
    )


def responses(rows: DataFrame) -> DataFrame:
    """rows(url, status, content_type, body) with their class; a page of another content type or that is no JSON is a
    protocol error."""
    kind = http_class(F.col("status"), F.col("body"))
    broken = (kind == "ok") & (F.col("status") != 304) & (~F.coalesce(F.col("content_type"), F.lit("")).contains("json") | F.try_parse_json("body").isNull())
    return rows.withColumn("class", F.when(broken, "protocol").otherwise(kind))


def landed(spark: SparkSession, path: str) -> DataFrame:
    """Whole files under a path: name and body as text."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("body"))


def not_modified(current_etag: str | None, landed_etag: str | None) -> bool:
    return landed_etag is not None and landed_etag == current_etag
