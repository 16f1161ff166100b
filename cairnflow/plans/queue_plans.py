"""Queue, census, diff and outcome queries over the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from cairnflow.catalog import ARTIFACTS_SQL, artifacts, at, read
from cairnflow.functions import scalars as S
from cairnflow.operators import campaign, diff, health, queue
from cairnflow.plans.registry import query

NOW = "2001-01-01 00:00:00"
EVENTS_NOW = "2024-01-31 00:00:00"


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders that wait: the priority is the lane, the customer the project."""
    o = read(spark, sf_dir, "orders").where("o_orderstatus = 'O'")
    return o.select(F.substring("o_orderpriority", 1, 1).cast("int").alias("lane"), F.col("o_custkey").alias("project"), F.col("o_orderkey").alias("id"))


def _deferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_shipdate") > at(NOW))).select(F.col("l_orderkey").alias("id"))


QUEUE_SQL = """q AS (SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS lane, o_custkey AS project, o_orderkey AS id FROM orders WHERE o_orderstatus = 'O'
  AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R' AND l_shipdate > TIMESTAMP '2001-01-01 00:00:00'))"""


@query("queue_claim", f"WITH {QUEUE_SQL} SELECT * FROM q ORDER BY lane, project, id LIMIT 256")
def queue_claim(spark, sf_dir):
    return queue.claim(_queue(spark, sf_dir), _deferred(spark, sf_dir))


@query("queue_claim_keyset", f"WITH {QUEUE_SQL} SELECT * FROM q WHERE (lane, project, id) > (1, 100, 0) ORDER BY lane, project, id LIMIT 256")
def queue_claim_keyset(spark, sf_dir):
    return queue.claim(_queue(spark, sf_dir), _deferred(spark, sf_dir), cursor=(1, 100, 0))


@query("queue_claim_inflight", f"WITH {QUEUE_SQL} SELECT * FROM q WHERE id NOT IN (12, 99, 150, 201, 4000) ORDER BY lane, project, id LIMIT 100")
def queue_claim_inflight(spark, sf_dir):
    return queue.claim(_queue(spark, sf_dir), _deferred(spark, sf_dir), in_flight=[12, 99, 150, 201, 4000], limit=100)


@query("queue_chunks", "SELECT o_custkey AS project, o_orderkey AS id, CAST(floor((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) / 5) AS BIGINT) AS chunk FROM orders WHERE o_orderstatus = 'O'")
def queue_chunks(spark, sf_dir):
    return queue.keyset_chunks(_queue(spark, sf_dir).select("project", "id"), "project", "id", 5)


@query("queue_depth_by_lane", "SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS lane, count(*) AS depth FROM orders WHERE o_orderstatus = 'O' GROUP BY 1")
def queue_depth_by_lane(spark, sf_dir):
    return health.depth_by_lane(_queue(spark, sf_dir))


@query("oldest_pending", "SELECT min(o_orderdate) AS oldest, epoch(TIMESTAMP '2001-01-01 00:00:00') - epoch(min(o_orderdate)) AS age_s FROM orders WHERE o_orderstatus = 'O'")
def oldest_pending(spark, sf_dir):
    return health.oldest_pending(read(spark, sf_dir, "orders").where("o_orderstatus = 'O'"), "o_orderdate", at(NOW))


@query("state_census", f"WITH {ARTIFACTS_SQL}, s AS (SELECT * FROM (VALUES (0, 'NEED_METADATA'), (1, 'NO_METADATA'), (2, 'NEED_CONVERT'), (3, 'READY'), (4, 'SKIPPED'), (5, 'QUARANTINED'), (6, 'DELETED')) v(state, name)) SELECT s.state, s.name, count(a.id) AS n FROM s LEFT JOIN artifacts a ON a.state = s.state GROUP BY 1, 2")
def state_census(spark, sf_dir):
    return health.state_census(artifacts(spark, sf_dir))


@query("pending_backlog", f"WITH {ARTIFACTS_SQL} SELECT count(*) AS backlog, count(DISTINCT project) AS projects_stale FROM artifacts WHERE state IN (0, 2, 5)")
def pending_backlog(spark, sf_dir):
    return health.pending_backlog(artifacts(spark, sf_dir))


@query("errors_by_category_windows", "SELECT event_type AS category, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-30 23:00:00') AS last_hour, count(*) AS last_day FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' GROUP BY 1")
def errors_by_category_windows(spark, sf_dir):
    return health.errors_by_category(read(spark, sf_dir, "events"), "event_type", "ts", at(EVENTS_NOW))


@query("errors_recent", "SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-20 00:00:00' ORDER BY ts DESC, event_id DESC LIMIT 100")
def errors_recent(spark, sf_dir):
    return health.recent_errors(read(spark, sf_dir, "events"), "ts", "event_id", ("event_type", "error"), at("2024-01-20 00:00:00")).select("event_id", "ts", "user_id", "value")


STALE_SQL = """WITH remote AS (SELECT o_custkey AS name, max(o_orderkey) AS serial FROM orders GROUP BY 1), local AS (SELECT o_custkey AS name, max(o_orderkey) AS serial FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01 00:00:00' GROUP BY 1)"""


def _serials(spark, sf_dir, before=None):
    o = read(spark, sf_dir, "orders")
    o = o.where(F.col("o_orderdate") < at(before)) if before else o
    return o.groupBy(F.col("o_custkey").alias("name")).agg(F.max("o_orderkey").alias("serial"))


@query("stale_projects", f"{STALE_SQL} SELECT r.name, r.serial AS remote_serial, l.serial AS local_serial, 'stale' AS status FROM remote r LEFT JOIN local l ON l.name = r.name WHERE l.serial IS NULL OR r.serial > l.serial")
def stale_projects(spark, sf_dir):
    return diff.stale_projects(_serials(spark, sf_dir), _serials(spark, sf_dir, NOW))


@query("serial_regressions", f"{STALE_SQL} SELECT l.name, l.serial AS remote_serial, r.serial AS local_serial, 'regression' AS status FROM local l JOIN remote r ON l.name = r.name WHERE l.serial < r.serial")
def serial_regressions(spark, sf_dir):
    return diff.stale_projects(_serials(spark, sf_dir, NOW), _serials(spark, sf_dir)).where("status = 'regression'")


def _old_new(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return d.where("doc_id % 10 <> 0"), d.where("doc_id % 10 <> 1").withColumns({"n_chars": F.expr("if(doc_id % 13 = 0, n_chars + 1, n_chars)"), "lang": F.expr("if(doc_id % 17 = 0, null, lang)")})


DIFF_SQL = """WITH o AS (SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id % 10 <> 0),
n AS (SELECT doc_id, CASE WHEN doc_id % 17 <> 0 THEN lang END AS lang, source, CASE WHEN doc_id % 13 = 0 THEN n_chars + 1 ELSE n_chars END AS n_chars FROM documents WHERE doc_id % 10 <> 1),
d AS (SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, CASE WHEN o.doc_id IS NULL THEN 'new' WHEN n.doc_id IS NULL THEN 'vanished' WHEN o.lang IS DISTINCT FROM n.lang OR o.source IS DISTINCT FROM n.source OR o.n_chars IS DISTINCT FROM n.n_chars THEN 'changed' ELSE 'unchanged' END AS change,
  o.lang IS DISTINCT FROM n.lang AS c_lang, o.source IS DISTINCT FROM n.source AS c_source, o.n_chars IS DISTINCT FROM n.n_chars AS c_n_chars FROM o FULL JOIN n ON o.doc_id = n.doc_id)"""


@query("snapshot_diff", f"{DIFF_SQL} SELECT doc_id, change FROM d")
def snapshot_diff(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return diff.snapshot_diff(old, new, "doc_id", ["lang", "source", "n_chars"]).select("doc_id", "change")


@query("snapshot_diff_counts", f"{DIFF_SQL} SELECT change, count(*) AS n FROM d GROUP BY 1")
def snapshot_diff_counts(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return diff.snapshot_diff(old, new, "doc_id", ["lang", "source", "n_chars"]).groupBy("change").agg(F.count(F.lit(1)).alias("n"))


@query("changed_columns", f"{DIFF_SQL} SELECT doc_id, unnest(list_filter([CASE WHEN c_lang THEN 'lang' END, CASE WHEN c_source THEN 'source' END, CASE WHEN c_n_chars THEN 'n_chars' END], lambda x: x IS NOT NULL)) AS changed_column FROM d WHERE change = 'changed'")
def changed_columns(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return diff.snapshot_diff(old, new, "doc_id", ["lang", "source", "n_chars"]).select("doc_id", F.explode("changed").alias("changed_column"))


@query("new_and_vanished_keys", "SELECT 'new' AS side, count(*) AS n FROM (SELECT doc_id FROM documents WHERE doc_id % 10 <> 1 EXCEPT SELECT doc_id FROM documents WHERE doc_id % 10 <> 0) UNION ALL SELECT 'common', count(*) FROM (SELECT doc_id FROM documents WHERE doc_id % 10 <> 1 INTERSECT SELECT doc_id FROM documents WHERE doc_id % 10 <> 0)")
def new_and_vanished_keys(spark, sf_dir):
    old, new = (x.select("doc_id") for x in _old_new(spark, sf_dir))
    n = lambda df, side: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(side).alias("side"), "n")
    return n(new.subtract(old), "new").unionByName(n(new.intersect(old), "common"))


def _reconcile_sides(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    name = F.concat(F.lit("f"), F.col("doc_id").cast("string"))
    local = d.where("doc_id % 10 <> 0").select(
        name.alias("filename"), (F.col("doc_id") % 7).cast("int").alias("state"), F.when(F.col("doc_id") % 7 == 6, at(NOW)).alias("deleted_at"),
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("a"), F.col("source"))).alias("blob_sha256"), F.concat(F.lit("a"), F.col("source")).alias("metadata_sha256"), F.col("n_chars").alias("size"), F.lit(False).alias("yanked"),
    )
    remote = d.where("doc_id % 10 <> 1").select(
        name.alias("filename"), F.expr("if(doc_id % 19 = 0, 'b', 'a') || source").alias("metadata_sha256"), (F.col("doc_id") % 4 != 0).alias("has_metadata"),
        F.expr("if(doc_id % 13 = 0, n_chars + 1, n_chars)").alias("size"), (F.col("doc_id") % 23 == 0).alias("yanked"),
    )
    return local, remote, d.where("doc_id % 30 = 0").select(name.alias("filename"), F.lit("u").alias("sha256"))


RECONCILE_SQL = """
WITH l AS (SELECT 'f' || doc_id AS filename, CAST(doc_id % 7 AS INTEGER) AS state, doc_id % 7 = 6 AS dead, CASE WHEN doc_id % 3 = 0 THEN 'a' || source END AS blob, 'a' || source AS msha, n_chars AS size, FALSE AS yanked FROM documents WHERE doc_id % 10 <> 0),
r AS (SELECT 'f' || doc_id AS filename, CASE WHEN doc_id % 19 = 0 THEN 'b' ELSE 'a' END || source AS msha, doc_id % 4 <> 0 AS has_md, CASE WHEN doc_id % 13 = 0 THEN n_chars + 1 ELSE n_chars END AS size, doc_id % 23 = 0 AS yanked FROM documents WHERE doc_id % 10 <> 1),
u AS (SELECT 'f' || doc_id AS filename, 'u' AS sha FROM documents WHERE doc_id % 30 = 0),
j AS (SELECT coalesce(l.filename, r.filename) AS filename, l.filename IS NOT NULL AS is_l, r.filename IS NOT NULL AS is_r, l.state, coalesce(l.dead, FALSE) AS dead, l.blob, r.msha, r.has_md, u.sha,
  l.filename IS NOT NULL AND r.filename IS NOT NULL AND NOT coalesce(l.dead, FALSE) AND l.blob IS NOT NULL AND l.blob <> r.msha AS moved,
  l.filename IS NOT NULL AND r.filename IS NOT NULL AND NOT coalesce(l.dead, FALSE) AND l.state = 1 AND r.has_md AS appeared,
  l.msha IS DISTINCT FROM r.msha OR l.size IS DISTINCT FROM r.size OR l.yanked IS DISTINCT FROM r.yanked AS differs
  FROM l FULL JOIN r ON l.filename = r.filename LEFT JOIN u ON u.filename = coalesce(l.filename, r.filename)),
k AS (SELECT *, CASE WHEN NOT is_r AND dead THEN 'none' WHEN NOT is_r THEN 'tombstone' WHEN NOT is_l THEN 'insert' WHEN dead THEN 'resurrect' WHEN moved OR appeared OR differs THEN 'update' ELSE 'none' END AS action FROM j)
SELECT filename, action, CAST(CASE WHEN action = 'tombstone' THEN 6 WHEN action = 'insert' THEN CASE WHEN sha IS NOT NULL THEN 2 WHEN has_md THEN 0 ELSE 1 END WHEN action = 'resurrect' THEN CASE WHEN has_md THEN 0 ELSE 1 END WHEN moved OR appeared THEN 0 ELSE state END AS INTEGER) AS new_state,
  moved AS drop_payload, appeared AS drop_skip, CASE WHEN action = 'insert' THEN sha WHEN action = 'resurrect' OR moved THEN NULL ELSE blob END AS blob_sha256 FROM k"""


@query("reconcile_state", RECONCILE_SQL)
def reconcile_state(spark, sf_dir):
    out = diff.reconcile(*_reconcile_sides(spark, sf_dir))
    return out.select("filename", "action", "new_state", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("drop_payload", "drop_skip")], "blob_sha256")


@query("initial_state", "SELECT doc_id, CAST(CASE WHEN doc_id % 30 = 0 THEN 2 WHEN doc_id % 4 <> 0 THEN 0 ELSE 1 END AS INTEGER) AS state FROM documents")
def initial_state(spark, sf_dir):
    return _first_states(read(spark, sf_dir, "documents"))


def _first_states(d):
    return d.select("doc_id", S.first_state(F.col("doc_id") % 4 != 0, F.when(F.col("doc_id") % 30 == 0, "u")).cast("int").alias("state"))


@query("apply_plan_sequence", f"{RECONCILE_SQL.replace('SELECT filename, action, CAST', ', z AS (SELECT filename, action, CAST', 1)}) SELECT filename, action, new_state, 5000 + row_number() OVER (ORDER BY filename) AS change_seq FROM z WHERE action <> 'none'")
def apply_plan_sequence(spark, sf_dir):
    """What a plan writes: every touched row with the next change_seq; rows that do not change take none."""
    touched = diff.reconcile(*_reconcile_sides(spark, sf_dir)).where("action <> 'none'").select("filename", "action", "new_state")
    return diff.with_sequence(touched, ["filename"], 5000)


@query("project_gone", f"WITH {ARTIFACTS_SQL} SELECT id, CAST(CASE WHEN project = 'src3' THEN 6 ELSE state END AS INTEGER) AS state FROM artifacts")
def project_gone(spark, sf_dir):
    return _without_project(artifacts(spark, sf_dir))


def _without_project(a):
    return a.select("id", F.when(F.col("project") == "src3", 6).otherwise(F.col("state")).cast("int").alias("state"))


def _outcomes(spark, sf_dir):
    """events as outcomes of users' artifacts: the attempt count is the number of errors before the last event."""
    e = read(spark, sf_dir, "events")
    last = e.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type"), F.count_if(F.col("event_type") == "error").alias("errors"))
    kind = F.when(F.col("event_type") == "error", "retry").when(F.col("event_type") == "view", "skip").when(F.col("event_type") == "click", "rate_limited").otherwise("ok")
    a = last.select(F.col("user_id").alias("id"), (F.col("user_id") % 7).cast("int").alias("state"))
    w = last.where("errors > 0").select(F.col("user_id").alias("artifact_id"), F.lit("convert").alias("stage"), F.least("errors", F.lit(10)).cast("int").alias("attempts"))
    w = w.withColumn("attempts", (F.col("attempts") - F.col("artifact_id") % 8).cast("int"))
    o = last.select(F.col("user_id").alias("id"), F.lit("convert").alias("stage"), kind.alias("kind"), F.lit(3).alias("target_state"))
    return a, w, o


OUTCOMES_SQL = """WITH last AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1),
j AS (SELECT user_id AS id, CAST(user_id % 7 AS INTEGER) AS state, CASE event_type WHEN 'error' THEN 'retry' WHEN 'view' THEN 'skip' WHEN 'click' THEN 'rate_limited' ELSE 'ok' END AS kind, CASE WHEN errors > 0 THEN least(errors, 10) - user_id % 8 ELSE 0 END + 1 AS att FROM last),
k AS (SELECT *, CASE WHEN kind = 'rate_limited' THEN 'ignored' WHEN kind = 'retry' AND att > 8 THEN 'quarantine' WHEN kind = 'retry' THEN 'retry'
  WHEN (state, CASE kind WHEN 'skip' THEN 4 ELSE 3 END) IN ((0, 2), (0, 1), (0, 5), (1, 0), (2, 3), (2, 4), (2, 5), (3, 2), (3, 6), (4, 2), (5, 0)) THEN kind ELSE 'rejected' END AS result FROM j)"""


@query("outcomes_applied", f"{OUTCOMES_SQL} SELECT id, kind, result, state AS old_state, CAST(CASE WHEN result = 'ok' THEN 3 WHEN result = 'skip' THEN 4 WHEN result = 'quarantine' THEN 5 ELSE state END AS INTEGER) AS new_state, CAST(CASE WHEN result IN ('retry', 'quarantine') THEN att END AS INTEGER) AS attempts, CASE WHEN result = 'quarantine' THEN TIMESTAMP '2024-01-31 00:00:00' WHEN result = 'retry' THEN TIMESTAMP '2024-01-31 00:00:00' + to_seconds(least(30 * pow(2, att - 1), 21600)) END AS next_attempt_at, result IN ('ok', 'skip') AS drop_work, result IN ('skip', 'quarantine') AS write_error FROM k")
def outcomes_applied(spark, sf_dir):
    return queue.apply_outcomes(*_outcomes(spark, sf_dir), at(EVENTS_NOW)).drop("stage")


@query("outcome_counts", f"{OUTCOMES_SQL} SELECT 'convert' AS stage, result, count(*) AS n FROM k GROUP BY 2")
def outcome_counts(spark, sf_dir):
    return queue.outcome_counts(queue.apply_outcomes(*_outcomes(spark, sf_dir), at(EVENTS_NOW)))


@query("backoff_schedule", "SELECT CAST(n AS INTEGER) AS n, least(30.0 * pow(2.0, n - 1), 21600.0) AS seconds FROM range(1, 13) t(n)")
def backoff_schedule(spark, sf_dir):
    return spark.range(1, 13).select(F.col("id").cast("int").alias("n"), S.backoff_seconds(F.col("id")).alias("seconds"))


@query("transition_check", "SELECT CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b, (a, b) IN ((0, 2), (0, 1), (0, 5), (1, 0), (2, 3), (2, 4), (2, 5), (3, 2), (3, 6), (4, 2), (5, 0)) AS allowed FROM range(7) x(a), range(7) y(b)")
def transition_check(spark, sf_dir):
    grid = spark.range(49).select(F.expr("int(id div 7)").alias("a"), F.expr("int(id % 7)").alias("b"))
    return grid.withColumn("allowed", S.edge_allowed(F.col("a"), F.col("b")))


# --- campaigns ---

VERSION = "0.5.0"


def _campaign_tables(spark, sf_dir):
    a = artifacts(spark, sf_dir)
    p = a.where("state in (3, 6)").select(F.col("id").alias("artifact_id"), F.concat(F.lit("0."), (F.col("id") % 10).cast("string"), F.lit(".0")).alias("version"))
    s = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("artifact_id"), F.lit("convert").alias("stage"), (F.col("toxic") == 1).alias("permanent"), F.when(F.col("toxic") == 0, F.concat(F.lit("0."), (F.col("doc_id") % 12).cast("string"), F.lit(".0"))).alias("version"))
    w = a.where("id % 5 = 0").select(F.col("id").alias("artifact_id"), F.lit("convert").alias("stage"), (F.col("id") % 12).cast("int").alias("attempts"))
    return a, p, s, w


CAMPAIGN_SQL = f"""WITH {ARTIFACTS_SQL}, p AS (SELECT id AS artifact_id, '0.' || (id % 10) || '.0' AS version FROM artifacts WHERE state IN (3, 6)),
s AS (SELECT doc_id AS artifact_id, toxic = 1 AS permanent, CASE WHEN toxic = 0 THEN '0.' || (doc_id % 12) || '.0' END AS version FROM labels),
stale AS (SELECT s.artifact_id FROM s JOIN artifacts a ON a.id = s.artifact_id WHERE NOT permanent AND version < '0.5.0' AND state <> 6),
hit AS (SELECT artifact_id AS id FROM stale UNION SELECT p.artifact_id FROM p JOIN artifacts a ON a.id = p.artifact_id WHERE p.version < '0.5.0' AND state <> 6)"""


@query("preview_version_below", f"{CAMPAIGN_SQL} SELECT (SELECT count(*) FROM hit) AS artifact_count, (SELECT count(*) FROM stale) AS skips_to_clear_count")
def preview_version_below(spark, sf_dir):
    a, p, s, _ = _campaign_tables(spark, sf_dir)
    return campaign.preview(a, p, s, campaign.VersionBelow(VERSION))


@query("preview_selectors", f"WITH {ARTIFACTS_SQL} SELECT 'project' AS selector, count(*) AS artifact_count FROM artifacts WHERE project = 'src7' AND state <> 6 UNION ALL SELECT 'skipped_only', count(*) FROM artifacts WHERE state = 4 UNION ALL SELECT 'state', count(*) FROM artifacts WHERE state = 3")
def preview_selectors(spark, sf_dir):
    a, p, s, _ = _campaign_tables(spark, sf_dir)
    out = None
    for spec in ({"type": "project", "project": "src7"}, {"type": "skipped_only"}, {"type": "state", "state": 3}):
        row = campaign.preview(a, p, s, campaign.parse_selector(spec)).select(F.lit(spec["type"]).alias("selector"), "artifact_count")
        out = row if out is None else out.unionByName(row)
    return out


@query("campaign_apply", f"{CAMPAIGN_SQL} SELECT CAST(CASE WHEN h.id IS NOT NULL THEN 2 ELSE a.state END AS INTEGER) AS state, CAST(CASE WHEN h.id IS NOT NULL THEN 1 ELSE a.lane END AS INTEGER) AS lane, count(*) AS n FROM artifacts a LEFT JOIN hit h ON h.id = a.id GROUP BY 1, 2")
def campaign_apply(spark, sf_dir):
    a, p, s, w = _campaign_tables(spark, sf_dir)
    return campaign.reprocess(a, p, s, w, campaign.VersionBelow(VERSION))["artifacts"].groupBy("state", "lane").agg(F.count(F.lit(1)).alias("n"))


@query("campaign_leftovers", f"{CAMPAIGN_SQL} SELECT 'payloads' AS tbl, (SELECT count(*) FROM p WHERE artifact_id NOT IN (SELECT id FROM hit)) AS n UNION ALL SELECT 'skips', (SELECT count(*) FROM s WHERE artifact_id NOT IN (SELECT artifact_id FROM stale)) UNION ALL SELECT 'work', (SELECT count(*) FROM artifacts WHERE id % 5 = 0 AND id NOT IN (SELECT id FROM hit))")
def campaign_leftovers(spark, sf_dir):
    a, p, s, w = _campaign_tables(spark, sf_dir)
    after, out = campaign.reprocess(a, p, s, w, campaign.VersionBelow(VERSION)), None
    for name in ("payloads", "skips", "work"):
        row = after[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query("unquarantine_apply", f"WITH {ARTIFACTS_SQL} SELECT CAST(CASE WHEN state = 5 AND project = 'src2' THEN 0 ELSE state END AS INTEGER) AS state, count(*) AS n FROM artifacts GROUP BY 1")
def unquarantine_apply(spark, sf_dir):
    a, _, _, w = _campaign_tables(spark, sf_dir)
    return campaign.unquarantine(a, w, campaign.OfProject("src2"))["artifacts"].groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query("recover_segment", f"WITH {ARTIFACTS_SQL}, lost AS (SELECT DISTINCT blob_sha256 FROM artifacts WHERE id % 9 = 4) SELECT id, CAST(CASE WHEN l.blob_sha256 IS NOT NULL THEN 0 ELSE state END AS INTEGER) AS state, l.blob_sha256 IS NOT NULL AS lost FROM artifacts a LEFT JOIN lost l ON l.blob_sha256 = a.blob_sha256")
def recover_segment(spark, sf_dir):
    a, p, _, _ = _campaign_tables(spark, sf_dir)
    blobs = a.select(F.col("blob_sha256").alias("sha256"), F.expr("if(id % 9 = 4, 4, 0)").cast("long").alias("segment_id"))
    return campaign.recover_segment(a, blobs, p, 4)["artifacts"].select("id", "state", F.col("blob_sha256").isNull().alias("lost"))


@query("retention_gc", "SELECT event_type, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-11 00:00:00') AS kept, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-11 00:00:00') AS dropped FROM events GROUP BY 1")
def retention_gc(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("created_at", F.col("ts"))
    kept = campaign.retained(e, at(EVENTS_NOW), 20).groupBy("event_type").agg(F.count(F.lit(1)).alias("kept"))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).join(kept, "event_type", "left").select("event_type", F.coalesce("kept", F.lit(0)).alias("kept"), (F.col("n") - F.coalesce("kept", F.lit(0))).alias("dropped"))


@query("cdc_since", f"WITH {ARTIFACTS_SQL} SELECT id, state, change_seq FROM artifacts WHERE change_seq > 150")
def cdc_since(spark, sf_dir):
    return diff.cdc_since(artifacts(spark, sf_dir), 150).select("id", "state", "change_seq")


