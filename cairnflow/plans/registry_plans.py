"""Integrity, health, archive, scalar, conversion and publishing queries over the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnflow.catalog import ARTIFACTS_SQL, artifacts, at, read
from cairnflow.functions import codec
from cairnflow.functions import scalars as S
from cairnflow.operators import archive, checks, convert, health, imports, publish
from cairnflow.plans.registry import query
from cairnflow.sources import corpus, landed
from cairnflow.streaming import pipeline

EVENTS_NOW = "2024-01-31 00:00:00"

# --- integrity ---


def _checked(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A registry with broken rows of every kind, from documents, labels and lineitem."""
    a = artifacts(spark, sf_dir)
    a = a.select(
        "id", "project", F.expr("if(id % 101 = 100, 9, state)").cast("int").alias("state"), F.expr("if(id % 3 = 0, target_name, null)").alias("target_name"),
        F.expr("if(id % 4 = 0, null, blob_sha256)").alias("blob_sha256"), F.expr("if(id % 6 = 0, blob_sha256, null)").alias("metadata_sha256"),
        F.expr("if(id % 37 = 0, null, deleted_at)").alias("_d"), F.expr("(id div 2) + 1").alias("change_seq"), "updated_at",
    ).withColumn("deleted_at", F.expr("if(id % 41 = 0, timestamp'2024-02-01 00:00:00', _d)")).drop("_d")
    b = artifacts(spark, sf_dir).where("id % 5 <> 0").groupBy(F.col("blob_sha256").alias("sha256")).agg(F.min(F.expr("id % 12")).cast("long").alias("segment_id"))
    s = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("artifact_id"), (F.col("toxic") == 1).alias("permanent"), F.expr("if(doc_id % 8 = 0 or toxic = 1 and doc_id % 2 = 1, '0.1', null)").alias("version"))
    w = a.where("id % 5 = 0").select(F.col("id").alias("artifact_id"), (F.col("id") % 11).cast("int").alias("attempts"), F.expr("if(id % 10 = 0, timestamp'2024-01-05 00:00:00', null)").alias("quarantined_at"))
    p = a.where("id % 7 = 3 and id % 2 = 0 or id % 50 = 6").select(F.col("id").alias("artifact_id"))
    return {"artifacts": a, "payloads": p, "skips": s, "work": w, "blobs": b, "segments": spark.range(10).select("id")}


CHECK_SQL = f"""WITH {ARTIFACTS_SQL}, a AS (SELECT id, project, CAST(CASE WHEN id % 101 = 100 THEN 9 ELSE state END AS INTEGER) AS state, CASE WHEN id % 3 = 0 THEN target_name END AS target_name, CASE WHEN id % 4 <> 0 THEN blob_sha256 END AS blob_sha256,
  CASE WHEN id % 6 = 0 THEN blob_sha256 END AS metadata_sha256, CASE WHEN id % 41 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' WHEN id % 37 <> 0 THEN deleted_at END AS deleted_at, id // 2 + 1 AS change_seq, updated_at FROM artifacts),
b AS (SELECT blob_sha256 AS sha256, min(id % 12) AS segment_id FROM artifacts WHERE id % 5 <> 0 GROUP BY 1),
s AS (SELECT doc_id AS artifact_id, toxic = 1 AS permanent, CASE WHEN doc_id % 8 = 0 OR toxic = 1 AND doc_id % 2 = 1 THEN '0.1' END AS version FROM labels),
w AS (SELECT id AS artifact_id, id % 11 AS attempts, CASE WHEN id % 10 = 0 THEN TIMESTAMP '2024-01-05 00:00:00' END AS quarantined_at FROM a WHERE id % 5 = 0),
p AS (SELECT id AS artifact_id FROM a WHERE id % 7 = 3 AND id % 2 = 0 OR id % 50 = 6),
v AS (
  SELECT 'ready_without_payload' AS invariant, CAST(id AS VARCHAR) AS key FROM a WHERE state = 3 AND id NOT IN (SELECT artifact_id FROM p)
  UNION ALL SELECT 'payload_without_ready', CAST(id AS VARCHAR) FROM p JOIN a ON id = artifact_id WHERE state <> 3
  UNION ALL SELECT 'need_convert_without_blob', CAST(id AS VARCHAR) FROM a WHERE state = 2 AND NOT EXISTS (SELECT 1 FROM b WHERE sha256 = blob_sha256)
  UNION ALL SELECT 'need_metadata_with_blob', CAST(id AS VARCHAR) FROM a WHERE state = 0 AND blob_sha256 IS NOT NULL
  UNION ALL SELECT 'no_metadata_with_digest', CAST(id AS VARCHAR) FROM a WHERE state = 1 AND metadata_sha256 IS NOT NULL
  UNION ALL SELECT 'skipped_without_skip', CAST(id AS VARCHAR) FROM a WHERE state = 4 AND id NOT IN (SELECT artifact_id FROM s)
  UNION ALL SELECT 'quarantined_without_work', CAST(id AS VARCHAR) FROM a WHERE state = 5 AND id NOT IN (SELECT artifact_id FROM w WHERE quarantined_at IS NOT NULL)
  UNION ALL SELECT 'deleted_without_time', CAST(id AS VARCHAR) FROM a WHERE state = 6 AND deleted_at IS NULL
  UNION ALL SELECT 'time_without_deleted', CAST(id AS VARCHAR) FROM a WHERE state <> 6 AND deleted_at IS NOT NULL
  UNION ALL SELECT 'unknown_state', CAST(id AS VARCHAR) FROM a WHERE state NOT BETWEEN 0 AND 6
  UNION ALL SELECT 'permanent_skip_with_version', CAST(artifact_id AS VARCHAR) FROM s WHERE permanent AND version IS NOT NULL
  UNION ALL SELECT 'open_skip_without_version', CAST(artifact_id AS VARCHAR) FROM s WHERE NOT permanent AND version IS NULL
  UNION ALL SELECT 'skip_of_unskipped', CAST(artifact_id AS VARCHAR) FROM s JOIN a ON id = artifact_id WHERE state <> 4
  UNION ALL SELECT 'work_of_finished', CAST(artifact_id AS VARCHAR) FROM w JOIN a ON id = artifact_id WHERE state IN (1, 3, 4, 6)
  UNION ALL SELECT 'attempts_above_most', CAST(artifact_id AS VARCHAR) FROM w WHERE attempts > 8
  UNION ALL SELECT 'most_attempts_unquarantined', CAST(artifact_id AS VARCHAR) FROM w WHERE attempts = 8 AND quarantined_at IS NULL
  UNION ALL SELECT 'blob_unresolved', CAST(id AS VARCHAR) FROM a WHERE blob_sha256 IS NOT NULL AND NOT EXISTS (SELECT 1 FROM b WHERE sha256 = blob_sha256)
  UNION ALL SELECT 'segment_unresolved', sha256 FROM b WHERE segment_id >= 10
  UNION ALL SELECT 'orphaned_blob', sha256 FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE blob_sha256 = sha256)
  UNION ALL SELECT 'duplicate_change_seq', CAST(change_seq AS VARCHAR) FROM a GROUP BY change_seq HAVING count(*) > 1 AND count(DISTINCT updated_at) > 1
  UNION ALL SELECT 'name_outside_ready', CAST(id AS VARCHAR) FROM a WHERE state <> 3 AND target_name IS NOT NULL
  UNION ALL SELECT 'tombstoned_with_payload', CAST(id AS VARCHAR) FROM p JOIN a ON id = artifact_id WHERE deleted_at IS NOT NULL)"""


@query("fsck_report", f"{CHECK_SQL} SELECT invariant, invariant IN ('orphaned_blob', 'tombstoned_with_payload') AS informational, count(*) AS violations, array_to_string(list_slice(list_sort(list(key)), 1, 20), ',') AS examples FROM v GROUP BY 1")
def fsck_report(spark, sf_dir):
    return checks.report(checks.invariants(_checked(spark, sf_dir))).withColumn("examples", F.array_join("examples", ","))


@query("fsck_orphans", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def fsck_orphans(spark, sf_dir):
    return read(spark, sf_dir, "orders").join(read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").select("o_orderkey")


@query("fsck_duplicate_seq", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 AND count(DISTINCT l_shipdate) > 1")
def fsck_duplicate_seq(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_shipdate").alias("d")).where("n > 1 and d > 1").drop("d")


@query("fsck_sequence", f"WITH {ARTIFACTS_SQL} SELECT max(change_seq) AS largest FROM artifacts HAVING max(change_seq) <> 7")
def fsck_sequence(spark, sf_dir):
    return checks.sequence_matches(artifacts(spark, sf_dir), 7)


# --- health ---


def _segments(spark, sf_dir):
    a = artifacts(spark, sf_dir).withColumn("segment_id", F.expr("id div 64"))
    return a.groupBy("segment_id").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("records"), F.max("updated_at").alias("_t")).select(F.col("segment_id").alias("id"), F.when(F.col("segment_id") % 4 != 3, F.col("_t")).alias("sealed_at"), "bytes", "records")


SEGMENTS_SQL = f"""WITH {ARTIFACTS_SQL}, g AS (SELECT id // 64 AS id, CASE WHEN (id // 64) % 4 <> 3 THEN max(updated_at) END AS sealed_at, CAST(sum(size) AS BIGINT) AS bytes, count(*) AS records FROM artifacts GROUP BY 1, id // 64)"""


@query("segment_summary", f"{SEGMENTS_SQL} SELECT id, sealed_at IS NOT NULL AS sealed, bytes, records FROM g")
def segment_summary(spark, sf_dir):
    return _segments(spark, sf_dir).select("id", F.col("sealed_at").isNotNull().alias("sealed"), "bytes", "records")


@query("unsealed_records", f"{SEGMENTS_SQL} SELECT count(*) AS n FROM artifacts WHERE id // 64 IN (SELECT id FROM g WHERE sealed_at IS NULL)")
def unsealed_records(spark, sf_dir):
    open_ = _segments(spark, sf_dir).where("sealed_at is null").select(F.col("id").alias("segment_id"))
    return artifacts(spark, sf_dir).withColumn("segment_id", F.expr("id div 64")).join(open_, "segment_id", "left_semi").agg(F.count(F.lit(1)).alias("n"))


@query("health_snapshot", f"""{SEGMENTS_SQL}, e AS (SELECT count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-30 23:00:00') AS h, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-30 00:00:00') AS d FROM events WHERE event_type = 'error')
SELECT count(*) FILTER (WHERE state = 0) AS need_metadata_count, count(*) FILTER (WHERE state = 1) AS no_metadata_count, count(*) FILTER (WHERE state = 2) AS need_convert_count, count(*) FILTER (WHERE state = 3) AS ready_count, count(*) FILTER (WHERE state = 4) AS skipped_count,
 count(*) FILTER (WHERE state = 5) AS quarantined_count, count(*) FILTER (WHERE state = 6) AS deleted_count, max(serial) AS local_serial, max(change_seq) AS change_seq, count(*) FILTER (WHERE state IN (0, 2, 5)) AS backlog, count(DISTINCT project) FILTER (WHERE state IN (0, 2, 5)) AS projects_stale,
 count(DISTINCT project) AS projects_indexed, epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(min(updated_at) FILTER (WHERE state IN (0, 2, 5))) AS oldest_pending_s,
 (SELECT count(*) FROM g WHERE sealed_at IS NOT NULL) AS segments_sealed, (SELECT count(*) FROM g WHERE sealed_at IS NULL) AS segments_open, (SELECT CAST(sum(bytes) AS BIGINT) FROM g) AS archive_bytes, (SELECT h FROM e) AS errors_hour, (SELECT d FROM e) AS errors_day,
 greatest(0, 12345 - max(serial)) AS serial_lag FROM artifacts""")  # fmt: skip
def health_snapshot(spark, sf_dir):
    e = read(spark, sf_dir, "events").where("event_type = 'error'").select(F.col("ts").alias("created_at"))
    return health.snapshot(artifacts(spark, sf_dir), _segments(spark, sf_dir), e, at(EVENTS_NOW), 12345)


@query("alarms", f"WITH {ARTIFACTS_SQL}, q AS (SELECT count(*) AS n FROM artifacts WHERE state = 5) SELECT * FROM (VALUES ('wal_bytes', 'critical', ''), ('disk_free_bytes', 'critical', ''), ('read_txn_budget_violations', 'warning', ''), ('quarantined_count', 'warning', ''), ('index_lag_stale', 'warning', ''), ('writer_failed_ops', 'warning', ''), ('breaker_open', 'warning', 'pages'), ('stage_consecutive_failures', 'warning', 'fetch')) v(condition, severity, subject) WHERE condition <> 'quarantined_count' OR (SELECT n FROM q) > 0")
def alarms(spark, sf_dir):
    row = artifacts(spark, sf_dir).agg(F.count_if(F.col("state") == 5).alias("quarantined_count"), F.count_distinct("project").alias("projects_stale"))
    given = {"wal_bytes": (2 << 30) + 1, "checkpoint_failures": 4, "disk_free_bytes": (20 << 30) - 1, "read_violations": 3, "previous_read_violations": 2, "index_age_s": 3600.5, "open_segment_age_s": 43200.0, "writer_failed_ops": 1}
    row = row.withColumns({k: F.lit(v) for k, v in given.items()})
    maps = {"breakers": F.create_map(F.lit("pages"), F.lit("half_open"), F.lit("files"), F.lit("closed")), "stage_failures": F.create_map(F.lit("fetch"), F.lit(2), F.lit("convert"), F.lit(0))}
    return health.alarms(row.withColumns(maps))


@query("metric_lines", f"WITH {ARTIFACTS_SQL} SELECT 'state_count' AS family, 'gauge' AS type, 'registry_state_count{{state=\"' || state || '\"}} ' || count(*) AS line FROM artifacts GROUP BY state UNION ALL SELECT 'archive_bytes', 'counter', 'registry_archive_bytes ' || CAST(sum(size) AS BIGINT) FROM artifacts UNION ALL SELECT 'odd', 'gauge', 'registry_odd{{category=\"a\\\\b\\\"c\\nd\"}} 1'")
def metric_lines(spark, sf_dir):
    a = artifacts(spark, sf_dir)
    census = a.groupBy("state").agg(F.count(F.lit(1)).alias("value")).select(F.lit("state_count").alias("family"), F.lit("state").alias("label"), F.col("state").cast("string").alias("label_value"), "value")
    size = a.agg(F.sum("size").alias("value")).select(F.lit("archive_bytes").alias("family"), F.lit(None).cast("string").alias("label"), F.lit(None).cast("string").alias("label_value"), "value")
    odd = spark.createDataFrame([("odd", "category", 'a\\b"c\nd', 1), ("none", None, None, None)], "family string, label string, label_value string, value long")
    return health.metric_lines(census.unionByName(size).unionByName(odd))


@query("throughput_ema", """WITH RECURSIVE g AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, gap FROM (SELECT user_id, ts, event_id, epoch_us(ts) / 1e6 - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) / 1e6 AS gap FROM events) WHERE gap > 0),
f AS (SELECT user_id, n, 1 / gap AS ema FROM g WHERE n = 1 UNION ALL SELECT f.user_id, g.n, 0.2 / g.gap + 0.8 * f.ema FROM f JOIN g ON g.user_id = f.user_id AND g.n = f.n + 1)
SELECT user_id, round(arg_max(ema, n), 9) AS ema FROM f GROUP BY 1""")  # fmt: skip
def throughput_ema(spark, sf_dir):
    return health.throughput_ema(read(spark, sf_dir, "events"), "user_id", "ts", "event_id").select("user_id", F.round("ema", 9).alias("ema"))


# --- archive ---


@query("blob_dedup", "SELECT sha256(text) AS sha256, min(doc_id) AS doc_id FROM documents GROUP BY 1 HAVING sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 10 = 0)")
def blob_dedup(spark, sf_dir):
    from cairnflow.operators.queue import first_wins

    d = read(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("sha256"), "doc_id")
    return first_wins(d.where("doc_id % 10 = 0"), d, "sha256")


def _packing_sql(limit: int) -> str:
    return f"""WITH RECURSIVE r AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents),
f AS (SELECT source, doc_id, n_chars, n, CAST(0 AS BIGINT) AS block_no, CAST(0 AS BIGINT) AS "offset" FROM r WHERE n = 1
UNION ALL SELECT r.source, r.doc_id, r.n_chars, r.n, CASE WHEN f."offset" + f.n_chars + r.n_chars > {limit} THEN f.block_no + 1 ELSE f.block_no END, CASE WHEN f."offset" + f.n_chars + r.n_chars > {limit} THEN 0 ELSE f."offset" + f.n_chars END
FROM f JOIN r ON r.source = f.source AND r.n = f.n + 1) SELECT source, doc_id, n_chars, block_no, "offset" FROM f"""


@query("block_packing", _packing_sql(4096))
def block_packing(spark, sf_dir):
    return archive.packed(read(spark, sf_dir, "documents"), "source", "doc_id", "n_chars", 4096)


@query("block_packing_wide", _packing_sql(65536))
def block_packing_wide(spark, sf_dir):
    return archive.packed(read(spark, sf_dir, "documents"), "source", "doc_id", "n_chars", 65536)


def _index(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("sha256")).agg(F.min("doc_id").alias("id"), F.min("n_chars").alias("length")).select("id", "sha256", F.expr("id div 16").alias("block_no"), F.expr("id % 16").alias("offset"), "length")


@query("verify_index", "WITH x AS (SELECT sha256(text) AS sha256, min(doc_id) AS id FROM documents GROUP BY 1) SELECT sha256, CASE WHEN id % 20 = 1 THEN 'extra' WHEN id % 20 = 2 THEN 'missing' ELSE 'mismatched' END AS problem FROM x WHERE id % 20 IN (1, 2, 3)")
def verify_index(spark, sf_dir):
    x = _index(spark, sf_dir)
    return checks.footer_diff(x.where("id % 20 <> 1"), x.where("id % 20 <> 2").withColumn("offset", F.expr("if(id % 20 = 3, offset + 1, offset)")))


def _built(spark, sf_dir):
    return archive.build_segments(read(spark, sf_dir, "documents").select("source", "doc_id", "text"), "text", ["source", "doc_id"], 4, block_bytes=65536, seal_bytes=1 << 20)


@query("segment_round_trip", "SELECT DISTINCT sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS n_bytes FROM documents")
def segment_round_trip(spark, sf_dir):
    """Every distinct text out of the segments it was packed into."""
    return archive.read_records(_built(spark, sf_dir)).where(F.sha2("body", 256) == F.col("sha256")).select("sha256", F.length("body").cast("long").alias("n_bytes"))


@query("reindex_from_footer", "SELECT count(*) AS records, count(DISTINCT s) AS blobs, CAST(sum(n) AS BIGINT) AS bytes FROM (SELECT DISTINCT sha256(text) AS s, strlen(text) AS n FROM documents)")
def reindex_from_footer(spark, sf_dir):
    return archive.footer_records(_built(spark, sf_dir)).agg(F.count(F.lit(1)).alias("records"), F.count_distinct("sha256").alias("blobs"), F.sum("length").alias("bytes"))


@query("blob_read", "WITH w AS (SELECT sha256(text) AS sha256 FROM documents UNION SELECT sha256('absent')) SELECT w.sha256, CASE WHEN w.sha256 = sha256('absent') THEN 'archive_blob_missing' ELSE 'ok' END AS outcome FROM w")
def blob_read(spark, sf_dir):
    return _blob_outcomes(spark, sf_dir, read(spark, sf_dir, "documents"))


def _blob_outcomes(spark, sf_dir, documents):
    wanted = documents.select(F.sha2("text", 256).alias("sha256")).union(spark.range(1).select(F.sha2(F.lit("absent"), 256)))
    return archive.read_blobs(_built(spark, sf_dir), wanted).select("sha256", "outcome")


@query("archive_verify", "SELECT CASE substr(s, 1, 1) WHEN '2' THEN 'g' || s ELSE s END AS sha256, CASE substr(s, 1, 1) WHEN '0' THEN 'mismatched' WHEN '1' THEN 'extra' ELSE 'missing' END AS problem FROM (SELECT DISTINCT sha256(text) AS s FROM documents) WHERE substr(s, 1, 1) IN ('0', '1', '2')")
def archive_verify(spark, sf_dir):
    """Whole segments against an index with faults: wrong offsets, records left out, and records that no segment has."""
    segments = _built(spark, sf_dir)
    true = archive.footer_records(segments)
    first = F.substr("sha256", F.lit(1), F.lit(1))
    index = true.where(first != "1").withColumn("offset", F.when(first == "0", F.col("offset") + 1).otherwise(F.col("offset")))
    index = index.unionByName(true.where(first == "2").withColumn("sha256", F.concat(F.lit("g"), "sha256")))
    return archive.verify(segments, index).select("sha256", "problem")


@query("bulk_convert_by_block", "SELECT sha256(text) AS sha256, min(doc_id) AS first_id, count(*) AS claimed, CAST(strlen(any_value(text)) AS BIGINT) AS n_bytes FROM documents WHERE doc_id % 7 = 2 GROUP BY 1")
def bulk_convert_by_block(spark, sf_dir):
    """Bodies of all artifacts that wait for conversion, each block that holds one decompressed once."""
    segments = _built(spark, sf_dir)
    claimed = artifacts(spark, sf_dir).where("state = 2").select("id", F.col("blob_sha256").alias("sha256"))
    bodies = archive.claimed_bodies(archive.segment_blocks(segments), archive.footer_records(segments), claimed)
    return bodies.where("outcome = 'ok'").groupBy("sha256").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("claimed"), F.first(F.length("body")).cast("long").alias("n_bytes"))


@query("zstd_roundtrip", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def zstd_roundtrip(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", codec.zstd(F.col("text").cast("binary")).alias("z"))
    return d.select("doc_id", F.sha2(codec.unzstd(F.col("z")), 256).alias("sha256"))


@query("json_frame_roundtrip", "SELECT doc_id, lang, n_chars FROM documents")
def json_frame_roundtrip(spark, sf_dir):
    z = read(spark, sf_dir, "documents").select(codec.json_frame(F.struct("doc_id", "lang", "n_chars")).alias("z"))
    return z.select(codec.from_json_frame(F.col("z"), "doc_id long, lang string, n_chars long").alias("r")).select("r.*")


# --- scalar rules ---


@query("normalize_project", "SELECT p_partkey, lower(regexp_replace(p_name || '_' || p_brand || '--' || p_type, '[-_.]+', '-', 'g')) AS name FROM part")
def normalize_project(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", S.normalized_name(F.concat("p_name", F.lit("_"), "p_brand", F.lit("--"), "p_type")).alias("name"))


@query("percent_encode", "SELECT page_id, url_encode(url || ' *~ç') AS encoded FROM pages")
def percent_encode(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", S.percent_encoded(F.concat("url", F.lit(" *~ç"))).alias("encoded"))


@query("url_host", "SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) AS host, url || '.metadata' AS metadata_url FROM pages")
def url_host(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", S.url_host(F.col("url")).alias("host"), S.metadata_url(F.col("url")).alias("metadata_url"))


@query("yanked_parse", "SELECT event_id, event_id % 4 IN (0, 2, 3) AS yanked, CASE event_id % 4 WHEN 0 THEN 'broken' END AS reason FROM events")
def yanked_parse(spark, sf_dir):
    return _yanked(read(spark, sf_dir, "events"))


def _yanked(events):
    raw = F.element_at(F.array(F.lit('"broken"'), F.lit("false"), F.lit("true"), F.lit('""')), (F.col("event_id") % 4 + 1).cast("int"))
    return events.select("event_id", S.yanked_flag(raw).alias("yanked"), S.yanked_reason(raw).alias("reason"))


@query("metadata_hash_resolve", "SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'c' || event_id WHEN 1 THEN 'd' || event_id WHEN 2 THEN '' WHEN 3 THEN 'd' || event_id END AS digest FROM events")
def metadata_hash_resolve(spark, sf_dir):
    return _metadata_hashes(read(spark, sf_dir, "events"))


def _metadata_hashes(events):
    object_ = lambda p: F.concat(F.lit(f'{{"sha256": "{p}'), F.col("event_id").cast("string"), F.lit('"}'))
    k = F.col("event_id") % 5
    core = F.when(k == 0, object_("c")).when(k.isin(2, 3), "true").otherwise("false")
    dist = F.when(k.isin(0, 1, 3), object_("d")).otherwise("false")
    return events.select("event_id", S.metadata_digest(core, dist).alias("digest"))


@query("http_classify", "SELECT status, body, CASE WHEN status = 304 OR status BETWEEN 200 AND 299 THEN 'ok' WHEN status IN (404, 410) THEN 'not_found' WHEN status = 429 OR status = 403 AND body = 'Rate Limit hit' THEN 'rate_limited' WHEN status BETWEEN 500 AND 599 THEN 'transient' ELSE 'protocol' END AS class FROM (SELECT CAST(unnest([200, 204, 301, 304, 400, 403, 404, 410, 429, 500, 503]) AS INTEGER) AS status) CROSS JOIN (SELECT unnest(['', 'Rate Limit hit']) AS body)")
def http_classify(spark, sf_dir):
    rows = [(s, b) for s in (200, 204, 301, 304, 400, 403, 404, 410, 429, 500, 503) for b in ("", "Rate Limit hit")]
    return spark.createDataFrame(rows, "status int, body string").withColumn("class", S.http_class(F.col("status"), F.col("body")))


@query("retry_after_seconds", "SELECT * FROM (VALUES ('120', CAST(120 AS DOUBLE)), ('-5', 0), ('1.5', 1.5), ('Wed, 31 Jan 2024 00:01:30 GMT', 90), ('Tue, 30 Jan 2024 00:00:00 GMT', 0), ('soon', NULL), (NULL, NULL)) v(value, seconds)")
def retry_after_seconds(spark, sf_dir):
    rows = [("120",), ("-5",), ("1.5",), ("Wed, 31 Jan 2024 00:01:30 GMT",), ("Tue, 30 Jan 2024 00:00:00 GMT",), ("soon",), (None,)]
    return spark.createDataFrame(rows, "value string").withColumn("seconds", S.retry_after_seconds(F.col("value"), at(EVENTS_NOW)))


@query("humanize_bytes", "SELECT DISTINCT n_chars * 1000 AS n, CASE WHEN n_chars * 1000 < 1024 THEN (n_chars * 1000) || ' B' WHEN n_chars * 1000 < 1048576 THEN printf('%.1f KB', n_chars * 1000 / 1024) ELSE printf('%.1f MB', n_chars * 1000 / 1048576) END AS text FROM documents")
def humanize_bytes(spark, sf_dir):
    return read(spark, sf_dir, "documents").select((F.col("n_chars") * 1000).alias("n")).distinct().withColumn("text", S.human_bytes(F.col("n")))


@query("humanize_duration", "SELECT s, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' ELSE (s // 3600) || 'h' || lpad(CAST(s // 60 % 60 AS VARCHAR), 2, '0') || 'm' END AS text FROM (SELECT doc_id * 37 AS s FROM documents)")
def humanize_duration(spark, sf_dir):
    return read(spark, sf_dir, "documents").select((F.col("doc_id") * 37).alias("s")).withColumn("text", S.human_duration(F.col("s")))


@query("segment_names", "SELECT n, lpad(CAST(n AS VARCHAR), 6, '0') || '.zst' AS name, n AS back FROM range(0, 2000, 37) t(n)")
def segment_names(spark, sf_dir):
    return spark.range(0, 2000, 37).select(F.col("id").alias("n"), S.segment_name(F.col("id")).alias("name")).withColumn("back", S.segment_number(F.col("name")))


@query("digest_verify", "SELECT doc_id, doc_id % 9 <> 0 AS matches FROM documents")
def digest_verify(spark, sf_dir):
    d = read(spark, sf_dir, "documents").withColumn("expected", F.expr("if(doc_id % 9 = 0, 'x', upper(sha2(text, 256)))"))
    return d.select("doc_id", S.digest_matches(F.col("text"), F.col("expected")).alias("matches"))


@query("utf8_guard")
def utf8_guard(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat(F.unhex(F.lit("EFBBBF")), F.col("text").cast("binary"))).when(F.col("doc_id") % 3 == 1, F.unhex(F.lit("FF41"))).otherwise(F.col("text").cast("binary")).alias("b"))
    return d.select("doc_id", S.utf8_text(F.col("b")).isNull().alias("invalid"), F.char_length(S.utf8_text(F.col("b"))).alias("n"))


@query("crc32_digest")
def crc32_digest(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.crc32(F.col("text").cast("binary")).alias("crc"))


# --- sources ---


def _pages(spark, sf_dir):
    """pages as remote project pages in JSON."""
    p = read(spark, sf_dir, "pages").select("page_id", "url")
    file = lambda n, kind, more: f"""concat('{{"filename": "f', page_id, '-{n}.{kind}', '", "url": "', url, '", "hashes": {{"sha256": "h', page_id, '"}}, {more}, "size": ', page_id * 10 + {n}, '}}')"""
    kinds = [(0, "whl", '"core-metadata": {"sha256": "m0"}, "yanked": "bad"'), (1, "whl", '"core-metadata": true, "yanked": false'), (2, "tar.gz", '"yanked": true')]
    files = ", ', ', ".join(file(*k) for k in kinds)
    body = f"""concat('{{"meta": {{"_last-serial": ', page_id + 100, '}}, "files": [', {files}, ']}}')"""
    return p.select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("project"), F.expr(body).alias("body"))


@query("project_page_parse", "SELECT 'p' || page_id AS project, page_id + 100 AS serial, 'f' || page_id || '-' || n || '.whl' AS filename, 'h' || page_id AS sha256, CASE n WHEN 0 THEN 'm0' END AS metadata_sha256, TRUE AS has_metadata, page_id * 10 + n AS size, n = 0 AS yanked, CASE n WHEN 0 THEN 'bad' END AS yanked_reason FROM pages CROSS JOIN (SELECT unnest([0, 1]) AS n)")
def project_page_parse(spark, sf_dir):
    return landed.project_files(_pages(spark, sf_dir)).select("project", "serial", "filename", "sha256", "metadata_sha256", "has_metadata", "size", "yanked", "yanked_reason")


@query("index_page_parse", "SELECT 'part-' || p_partkey AS name, p_partkey * 3 AS serial, CAST(9999 AS BIGINT) AS last_serial FROM part")
def index_page_parse(spark, sf_dir):
    """All parts, a thousand keys a page, so that no page grows with the table."""
    p = read(spark, sf_dir, "part").select(F.expr("p_partkey div 1000").alias("page"), F.struct(F.concat(F.lit("Part_"), F.col("p_partkey").cast("string")).alias("name"), (F.col("p_partkey") * 3).alias("_last-serial")).alias("x"))
    pages = p.groupBy("page").agg(F.to_json(F.struct(F.struct(F.lit(9999).alias("_last-serial")).alias("meta"), F.collect_list("x").alias("projects"))).alias("body"))
    return landed.index_rows(pages.select("body")).drop("error")


@query("bridge_lookup", "SELECT doc_id, CASE WHEN sha256(text) IN (SELECT sha256(text) FROM documents WHERE doc_id % 6 NOT IN (0, 1)) THEN strlen(text) END AS n_bytes FROM documents")
def bridge_lookup(spark, sf_dir):
    return _bridged(read(spark, sf_dir, "documents"))


def _bridged(documents):
    import zlib

    from pyspark.sql.functions import arrow_udf
    from pyspark.sql.types import BinaryType

    @arrow_udf(BinaryType())
    def deflate(x):
        import pyarrow as pa

        return pa.array([zlib.compress(b) for b in x.to_pylist()], pa.binary())

    d = documents.select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.sha2("text", 256)).alias("k"), "text")
    body = F.when(F.col("doc_id") % 6 == 1, F.lit("other")).otherwise(F.col("text")).cast("binary")
    old = d.where("doc_id % 6 <> 0").select(F.sha2(F.col("text"), 256).alias("sha256"), (F.col("doc_id") % 6 != 1).alias("holds"), deflate(body).alias("z_body")).groupBy("sha256").agg(F.max_by("z_body", "holds").alias("z_body"))
    wanted = d.select(F.col("doc_id").alias("id"), F.sha2("text", 256).alias("sha256"))
    return corpus.bridge_lookup(wanted, old).select(F.col("id").alias("doc_id"), F.length("body").cast("long").alias("n_bytes"))


# --- conversion ---


def _converted(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").where("turn = 0")
    n = F.col("conv_id").cast("string")
    version = F.when(F.col("conv_id") % 4 == 0, F.lit("1.0b1")).otherwise(F.concat(F.lit("1."), n))
    body = F.concat(F.lit("Name: My_Pkg"), n, F.lit("\nVersion: "), version, F.lit("\nRequires-Dist: b; x\nRequires-Dist: a\n\nbody"))
    body = F.when(F.col("conv_id") % 7 == 1, F.lit("no header here")).when(F.col("conv_id") % 7 == 2, F.lit("Version: 1\n\n")).otherwise(body)
    raw = F.when(F.col("conv_id") % 11 == 3, F.unhex(F.lit("FFFE"))).otherwise(body.cast("binary"))
    return convert.convert(c.select(F.col("conv_id").alias("id"), F.concat(F.lit("f"), n).alias("filename"), raw.alias("body")), "0.9")


@query("convert_outcomes", "SELECT conv_id AS id, CASE WHEN conv_id % 11 = 3 THEN 'skip' WHEN conv_id % 7 IN (1, 2) THEN 'skip' ELSE 'ok' END AS kind, CASE WHEN conv_id % 11 = 3 THEN 'invalid_metadata_encoding' WHEN conv_id % 7 IN (1, 2) THEN 'invalid_metadata' ELSE '' END AS reason, conv_id % 11 = 3 AS permanent, CASE WHEN conv_id % 11 <> 3 THEN '0.9' END AS version, conv_id % 11 <> 3 AND conv_id % 7 NOT IN (1, 2) AND conv_id % 4 = 0 AS requires_prerelease FROM conversations WHERE turn = 0")
def convert_outcomes(spark, sf_dir):
    return _converted(spark, sf_dir).select("id", "kind", "reason", "permanent", "version", "requires_prerelease")


@query("record_fanout", "SELECT conv_id AS id, 'my-pkg' || conv_id AS name, CASE WHEN conv_id % 4 = 0 THEN '1.0b1' ELSE '1.' || conv_id END AS version, 'a,b' AS depends FROM conversations WHERE turn = 0 AND conv_id % 11 <> 3 AND conv_id % 7 NOT IN (1, 2)")
def record_fanout(spark, sf_dir):
    return convert.fan_out(_converted(spark, sf_dir)).select("id", "name", "version", F.array_join("depends", ",").alias("depends"))


@query("resolution_dedup", "SELECT user_id, string_agg(event_type || '=' || first_id, ',' ORDER BY event_type) AS resolutions FROM (SELECT user_id, event_type, min(event_id) AS first_id FROM events GROUP BY 1, 2) GROUP BY 1")
def resolution_dedup(spark, sf_dir):
    return _resolutions(read(spark, sf_dir, "events"))


def _resolutions(e):
    lists = e.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", F.col("event_type").alias("source_name"), F.col("event_id").alias("target")))).alias("r"))
    first = convert.first_resolutions(F.col("r"))
    return lists.select("user_id", F.array_join(F.transform(first, lambda x: F.concat(x["source_name"], F.lit("="), x["target"].cast("string"))), ",").alias("resolutions"))


# --- streaming folds over finished tables ---


@query("breaker_states")
def breaker_states(spark, sf_dir):
    return pipeline.breaker_batch(read(spark, sf_dir, "events").withColumn("failed", F.col("event_type") != "purchase"), "user_id", "ts", "event_id", "failed")


@query("disk_guard", """WITH RECURSIVE e AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events), f AS (SELECT user_id, n, value < 20 AS paused FROM e WHERE n = 1 UNION ALL SELECT e.user_id, e.n, CASE WHEN f.paused THEN e.value < 24 ELSE e.value < 20 END FROM f JOIN e ON e.user_id = f.user_id AND e.n = f.n + 1)
SELECT user_id, count(*) FILTER (WHERE paused) AS paused FROM f GROUP BY 1""")  # fmt: skip
def disk_guard(spark, sf_dir):
    """Free space per user from events' values, with a floor of 20: how often the guard pauses."""
    from cairnflow.streaming.control import DiskGuard

    def fold(part):
        import pandas as pd

        g = DiskGuard(floor=20)
        part = part.sort_values(["ts", "event_id"])
        return pd.DataFrame({"user_id": [part.user_id.iloc[0]], "paused": [sum(g.check(v) for v in part.value)]})

    return read(spark, sf_dir, "events").groupBy("user_id").applyInPandas(fold, "user_id long, paused long")


@query("token_bucket_replay")
def token_bucket_replay(spark, sf_dir):
    """Grants and denials of a bucket of one token an hour, replayed over each user's events."""
    from cairnflow.streaming.control import TokenBucket

    def fold(part):
        import pandas as pd

        part = part.sort_values(["ts", "event_id"])
        b = TokenBucket(1 / 3600, 2.0, at=part.ts.iloc[0].timestamp())
        got = [b.take(t.timestamp()) for t in part.ts]
        return pd.DataFrame({"user_id": [part.user_id.iloc[0]], "granted": [sum(got)], "denied": [len(got) - sum(got)]})

    return read(spark, sf_dir, "events").groupBy("user_id").applyInPandas(fold, "user_id long, granted long, denied long")


# --- imports and publishing ---


@query("import_preconditions", "WITH f AS (SELECT 'f' || (doc_id % 400) AS filename, source AS project, doc_id % 3 = 0 AS side, CASE WHEN doc_id % 5 <> 0 THEN sha256(text) END AS sha FROM documents), b AS (SELECT sha256(text) AS sha, max(strlen(text)) AS n FROM documents WHERE doc_id % 4 <> 0 GROUP BY 1) SELECT 'bodies' AS check, count(*) AS n FROM b UNION ALL SELECT 'bytes', CAST(sum(n) AS BIGINT) FROM b UNION ALL SELECT 'sidecar_without_key', count(*) FROM f WHERE side AND sha IS NULL UNION ALL SELECT 'key_without_body', count(*) FROM f WHERE sha IS NOT NULL AND sha NOT IN (SELECT sha FROM b) UNION ALL SELECT 'filename_of_projects', count(*) FROM (SELECT filename FROM f GROUP BY 1 HAVING count(DISTINCT project) > 1)")
def import_preconditions(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    files = d.select(F.concat(F.lit("f"), F.expr("doc_id % 400").cast("string")).alias("filename"), F.col("source").alias("project"), (F.col("doc_id") % 3 == 0).alias("has_sidecar"), F.when(F.col("doc_id") % 5 != 0, F.sha2("text", 256)).alias("sha256"))
    bodies = d.where("doc_id % 4 <> 0").groupBy(F.sha2("text", 256).alias("sha256")).agg(F.max(F.octet_length("text")).cast("long").alias("n_bytes"))
    return imports.preconditions(files, bodies)


@query("link_outcomes", "WITH f AS (SELECT 'f' || doc_id AS filename, sha256(text) AS sha, doc_id FROM documents), a AS (SELECT 'f' || doc_id AS filename, doc_id % 7 AS state, CASE WHEN doc_id % 6 = 0 THEN sha256(text) WHEN doc_id % 6 = 1 THEN 'x' END AS blob FROM documents WHERE doc_id % 8 <> 0), b AS (SELECT DISTINCT sha FROM f WHERE doc_id % 5 <> 0) SELECT CASE WHEN b.sha IS NULL THEN 'no_blob' WHEN a.state IS NULL THEN 'unlinked' WHEN a.state = 6 THEN 'deleted' WHEN a.blob = f.sha THEN 'already' WHEN a.blob IS NOT NULL THEN 'conflict' ELSE 'linked' END AS outcome, count(*) AS n FROM f LEFT JOIN a USING (filename) LEFT JOIN b ON b.sha = f.sha GROUP BY 1")
def link_outcomes(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    name = F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("filename")
    files = d.select(name, F.sha2("text", 256).alias("sha256"))
    known = d.where("doc_id % 8 <> 0").select(name, (F.col("doc_id") % 7).alias("state"), F.when(F.col("doc_id") % 6 == 0, F.sha2("text", 256)).when(F.col("doc_id") % 6 == 1, F.lit("x")).alias("blob_sha256"))
    return imports.link_outcomes(files, known, d.where("doc_id % 5 <> 0").select(F.sha2("text", 256).alias("sha256")))


@query("dirty_packages", f"WITH {ARTIFACTS_SQL}, c AS (SELECT target_name AS o, CASE WHEN id % 6 = 0 THEN target_name || '-new' WHEN id % 6 = 1 THEN NULL ELSE target_name END AS n, change_seq FROM artifacts WHERE change_seq > 100) SELECT name, max(change_seq) AS last_seq FROM (SELECT o AS name, change_seq FROM c UNION ALL SELECT n, change_seq FROM c) WHERE name IS NOT NULL GROUP BY 1")
def dirty_packages(spark, sf_dir):
    c = artifacts(spark, sf_dir).where("change_seq > 100").select(F.col("target_name").alias("old_name"), F.expr("case when id % 6 = 0 then target_name || '-new' when id % 6 = 1 then null else target_name end").alias("new_name"), "change_seq")
    return publish.dirty_packages(c)


SHARDS_SQL = f"WITH {ARTIFACTS_SQL}, s AS (SELECT subdir, target_name AS name, count(*) AS n_records, sha256(string_agg(item, chr(10) ORDER BY item)) AS hash FROM (SELECT subdir, target_name, blob_sha256 || ':' || size AS item FROM artifacts WHERE NOT yanked AND deleted_at IS NULL) GROUP BY 1, 2)"


def _shards(spark, sf_dir):
    a = artifacts(spark, sf_dir).where("not yanked and deleted_at is null")
    return publish.shards(a.select("subdir", F.col("target_name").alias("name"), F.concat("blob_sha256", F.lit(":"), F.col("size").cast("string")).alias("item")))


@query("shard_build", f"{SHARDS_SQL} SELECT * FROM s")
def shard_build(spark, sf_dir):
    return _shards(spark, sf_dir)


@query("shard_elision", f"{SHARDS_SQL} SELECT * FROM s WHERE n_records % 2 = 1")
def shard_elision(spark, sf_dir):
    built = _shards(spark, sf_dir)
    return publish.changed_shards(built, built.where("n_records % 4 <> 3").withColumn("hash", F.expr("if(n_records % 2 = 1, 'old', hash)")))


@query("shard_index", f"{SHARDS_SQL} SELECT subdir, count(*) AS shards, sha256(string_agg(name || '=' || hash, ',' ORDER BY name)) AS digest FROM s GROUP BY 1")
def shard_index(spark, sf_dir):
    entries = F.transform(F.map_entries("shards"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return publish.subdir_index(_shards(spark, sf_dir)).select("subdir", F.size("shards").cast("long").alias("shards"), F.sha2(F.array_join(entries, ","), 256).alias("digest"))


@query("dirty_cleared", f"WITH {ARTIFACTS_SQL} SELECT target_name AS name, max(change_seq) AS last_seq FROM artifacts GROUP BY 1 HAVING max(change_seq) > 180")
def dirty_cleared(spark, sf_dir):
    return publish.cleared(publish.dirty_packages(artifacts(spark, sf_dir).select(F.col("target_name").alias("old_name"), F.col("target_name").alias("new_name"), "change_seq")), 180)


def _dirty(spark, sf_dir):
    return artifacts(spark, sf_dir).groupBy("target_name", "project").agg(F.max("updated_at").alias("dirty_since"))


@query("publish_gate", f"WITH {ARTIFACTS_SQL}, d AS (SELECT target_name, project, max(updated_at) AS dirty_since FROM artifacts GROUP BY 1, 2) SELECT target_name, project FROM d WHERE project NOT IN (SELECT project FROM artifacts WHERE state = 0 AND project < 'src13') OR epoch(TIMESTAMP '2024-01-01 04:00:00') - epoch(dirty_since) >= 3600")
def publish_gate(spark, sf_dir):
    held = artifacts(spark, sf_dir).where("state = 0 and project < 'src13'")
    return publish.publishable(_dirty(spark, sf_dir), held, at("2024-01-01 04:00:00")).select("target_name", "project")


@query("publish_trigger", f"WITH {ARTIFACTS_SQL}, d AS (SELECT target_name, project, max(updated_at) AS dirty_since FROM artifacts GROUP BY 1, 2) SELECT count(*) AS dirty_count, epoch(TIMESTAMP '2024-01-01 04:00:00') - epoch(min(dirty_since)) AS oldest_s, count(*) >= 2000 OR epoch(TIMESTAMP '2024-01-01 04:00:00') - epoch(min(dirty_since)) >= 300 AS publish FROM d")
def publish_trigger(spark, sf_dir):
    return publish.should_publish(_dirty(spark, sf_dir), at("2024-01-01 04:00:00"))


@query("object_gc", f"WITH {ARTIFACTS_SQL} SELECT id FROM artifacts WHERE change_seq < 500 AND epoch(TIMESTAMP '2024-01-01 10:00:00') - epoch(updated_at) > 3600 AND blob_sha256 NOT IN (SELECT blob_sha256 FROM artifacts WHERE id % 3 = 0)")
def object_gc(spark, sf_dir):
    a = artifacts(spark, sf_dir)
    objects = a.select("id", F.col("blob_sha256").alias("hash"), F.col("change_seq").alias("last_referenced_seq"), F.col("updated_at").alias("created_at"))
    return publish.collectable_objects(objects, a.where("id % 3 = 0").select(F.col("blob_sha256").alias("hash")), 500, at("2024-01-01 10:00:00"), 3600.0).select("id")
