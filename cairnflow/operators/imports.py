"""Import of an older corpus: preconditions, body validation, linking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnflow.functions.codec import inflated


def preconditions(files: DataFrame, bodies: DataFrame) -> DataFrame:
    """check, n: how much there is, sidecars without a key, keys without a body, filenames of several projects."""
    total = bodies.agg(F.count(F.lit(1)).alias("n")).select(F.lit("bodies").alias("check"), "n")
    size = bodies.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n")).select(F.lit("bytes").alias("check"), "n")
    bare = files.where("has_sidecar and sha256 is null").agg(F.count(F.lit(1)).alias("n")).select(F.lit("sidecar_without_key").alias("check"), "n")
    lost = files.where("sha256 is not null").join(bodies.select("sha256"), "sha256", "left_anti").agg(F.count(F.lit(1)).alias("n")).select(F.lit("key_without_body").alias("check"), "n")
    shared = files.groupBy("filename").agg(F.count_distinct("project").alias("p")).where("p > 1").agg(F.count(F.lit(1)).alias("n")).select(F.lit("filename_of_projects").alias("check"), "n")
    return total.union(size).union(bare).union(lost).union(shared)


def validated(bodies: DataFrame) -> DataFrame:
    """sha256, body, valid of bodies(sha256, z_body, n_bytes): what inflates to the digest and size that it claims."""
    raw = bodies.withColumn("body", inflated(F.col("z_body")))
    ok = F.coalesce((F.sha2("body", 256) == F.col("sha256")) & (F.length("body") == F.col("n_bytes")), F.lit(False))
    return raw.select("sha256", "body", ok.alias("valid"))


def link_outcomes(files: DataFrame, artifacts: DataFrame, blobs: DataFrame) -> DataFrame:
    """outcome, n of files(filename, sha256): unlinked (no such artifact), no_blob, deleted, already, conflict, linked."""
    j = files.join(artifacts.select("filename", "state", "blob_sha256"), "filename", "left").join(blobs.select("sha256").distinct().withColumn("_blob", F.lit(True)), "sha256", "left")
    outcome = (
        F.when(F.col("_blob").isNull(), "no_blob").when(F.col("state").isNull(), "unlinked").when(F.col("state") == 6, "deleted")
        .when(F.col("blob_sha256") == F.col("sha256"), "already").when(F.col("blob_sha256").isNotNull(), "conflict").otherwise("linked")
    )
    return j.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
