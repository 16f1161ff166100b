"""Queries of what a sync batch writes, of read durations and of log lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnflow.catalog import ARTIFACTS_SQL, artifacts, at, read
from cairnflow.operators import health, ingest
from cairnflow.plans.registry import query

GONE = ["src3", "src11"]


def _gone(spark):
    return spark.range(1).select(F.explode(F.array(*map(F.lit, GONE))).alias("project"))


@query("projects_gone", f"WITH {ARTIFACTS_SQL} SELECT id, CASE WHEN project IN ('src3', 'src11') THEN 6 ELSE state END AS state, CASE WHEN project IN ('src3', 'src11') AND state <> 6 THEN TIMESTAMP '2024-06-01 00:00:00' ELSE deleted_at END AS deleted_at FROM artifacts")
def projects_gone(spark, sf_dir):
    return ingest.without_projects(artifacts(spark, sf_dir), _gone(spark), at("2024-06-01 00:00:00")).select("id", "state", "deleted_at")


@query("index_without_gone", "SELECT source AS name, max(doc_id // 10) AS serial FROM documents WHERE source NOT IN ('src3', 'src11') GROUP BY 1")
def index_without_gone(spark, sf_dir):
    index = artifacts(spark, sf_dir).groupBy(F.col("project").alias("name")).agg(F.max("serial").alias("serial"))
    return ingest.index_without(index, _gone(spark))


@query("rows_of_projects", "SELECT doc_id AS id FROM documents WHERE source IN ('src3', 'src11')")
def rows_of_projects(spark, sf_dir):
    return ingest.project_rows(artifacts(spark, sf_dir), _gone(spark)).select("id")


@query("duplicate_filenames", "SELECT 'f' || doc_id AS filename, 'src' || (doc_id % 5) AS project, source AS owner FROM documents WHERE 'src' || (doc_id % 5) <> source")
def duplicate_filenames(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("filename"), F.col("source").alias("project"), "doc_id")
    files = d.select("filename", F.concat(F.lit("src"), (F.col("doc_id") % 5).cast("string")).alias("project"))
    return ingest.duplicate_filenames(files, d)


@query("project_routes", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'penalise' WHEN 1 THEN CASE WHEN o_custkey % 12 > 8 THEN 'quarantine_error' ELSE 'none' END WHEN 2 THEN 'tombstone' ELSE 'apply' END AS action FROM orders")
def project_routes(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.element_at(F.array(*map(F.lit, ["rate_limited", "retry", "gone", "ok"])), (F.col("o_orderkey") % 4 + 1).cast("int")).alias("kind"), (F.col("o_custkey") % 12).alias("attempts"))
    return ingest.routed(o, "kind", "attempts").select("o_orderkey", "action")


@query("batch_summary", "SELECT event_type AS action, count(*) AS n, count(DISTINCT user_id) AS projects FROM events GROUP BY 1")
def batch_summary(spark, sf_dir):
    return ingest.batch_summary(read(spark, sf_dir, "events"), "event_type", "user_id")


@query("sequence_behind_last", "SELECT doc_id, (SELECT max(doc_id) + 1 FROM documents) + row_number() OVER (ORDER BY doc_id) AS change_seq FROM labels")
def sequence_behind_last(spark, sf_dir):
    return ingest.sequenced_behind(read(spark, sf_dir, "labels").select("doc_id"), ["doc_id"], artifacts(spark, sf_dir))


@query("change_window", "SELECT doc_id AS id, doc_id + 1 AS change_seq FROM documents WHERE doc_id + 1 BETWEEN 50 AND 150")
def change_window(spark, sf_dir):
    """The window is the feature: both bounds are its parameters."""
    return ingest.change_window(artifacts(spark, sf_dir), 50, 150).select("id", "change_seq")


@query("read_durations", "SELECT max(value) AS longest_ms, count(*) FILTER (WHERE value > 50) AS over_budget FROM events")
def read_durations(spark, sf_dir):
    return health.read_durations(read(spark, sf_dir, "events"), "value", 50.0)


@query("log_lines", """SELECT '{"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00","level":"INFO","message":"' || event_type || '","event_id":' || event_id || ',"user_id":' || user_id || '}' AS line FROM events""")
def log_lines(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("level", F.lit("INFO"))
    return health.log_lines(e, "ts", "level", "event_type", ["event_id", "user_id"])
