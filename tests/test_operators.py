"""Rules that hand-built rows show best."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from cairnflow import catalog, model
from cairnflow.functions import codec
from cairnflow.functions import scalars as S
from cairnflow.operators import archive, campaign, checks, convert, diff, health, imports, publish, queue
from cairnflow.sources import landed
from cairnflow.sources.config import Config, config_from_env
from cairnflow.streaming import control, pipeline

NOW = dt.datetime(2024, 1, 1)


def at(text="2024-01-01 00:00:00"):
    return F.lit(text).cast("timestamp")


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- queue ---


def test_claim_order_cursor_and_deferral(spark):
    q = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (0, "a", 3), (0, "b", 4)], "lane int, project string, id long")
    assert [r.id for r in queue.claim(q).collect()] == [3, 4, 1, 2]
    assert [r.id for r in queue.claim(q, cursor=(0, "a", 3), limit=2).collect()] == [4, 1]
    assert [r.id for r in queue.claim(q, in_flight=[3]).collect()] == [4, 1, 2]
    work = spark.createDataFrame([(3, "fetch", NOW + dt.timedelta(seconds=10), None), (4, "convert", NOW + dt.timedelta(seconds=10), None), (1, "fetch", NOW, NOW)], "artifact_id long, stage string, next_attempt_at timestamp, quarantined_at timestamp")
    assert [r.id for r in queue.claim(q, queue.deferrals(work, "fetch", at())).collect()] == [4, 2]
    assert [r.id for r in queue.claim(q, queue.deferrals(work, "fetch", at("2024-01-01 00:00:10"))).collect()] == [3, 4, 2]


def test_outcomes(spark):
    a = spark.createDataFrame([(1, 2), (2, 2), (3, 2), (4, 2), (5, 2), (6, 6)], "id long, state int")
    w = spark.createDataFrame([(3, "c", 8), (4, "c", 7)], "artifact_id long, stage string, attempts int")
    o = spark.createDataFrame([(1, "c", "ok", 3), (2, "c", "skip", 0), (3, "c", "retry", 0), (4, "c", "retry", 0), (5, "c", "rate_limited", 0), (6, "c", "ok", 3)], "id long, stage string, kind string, target_state int")
    got = {r.id: r for r in queue.apply_outcomes(a, w, o, at()).collect()}
    assert [got[k].result for k in range(1, 7)] == ["ok", "skip", "quarantine", "retry", "ignored", "rejected"]
    assert (got[3].attempts, got[3].new_state, got[3].next_attempt_at, got[3].write_error) == (9, 5, NOW, True)
    assert (got[4].attempts, got[4].new_state, got[4].write_error) == (8, 2, False)
    assert got[4].next_attempt_at == NOW + dt.timedelta(seconds=30 * 2**7)
    assert got[5].new_state == 2 and not got[5].drop_work and got[1].drop_work


def test_first_wins_and_merge(spark):
    known = spark.createDataFrame([("a", 0)], "k string, v int")
    found = spark.createDataFrame([("a", 1), ("b", 3), ("b", 2)], "k string, v int")
    assert rows(queue.first_wins(known, found, "k")) == [("b", 2)]
    assert rows(queue.merged(known, found.where("v = 1"), ["k"])) == [("a", 1)]


# --- diff ---


def test_reconcile_rules(spark):
    local = "filename string, state int, deleted_at timestamp, blob_sha256 string, metadata_sha256 string, size long, yanked boolean"
    l = spark.createDataFrame([("gone", 3, None, "x", "x", 1, False), ("back", 6, NOW, "x", "x", 1, False), ("moved", 3, None, "x", "x", 1, False), ("bare", 1, None, None, None, 1, False), ("yank", 3, None, "x", "x", 1, False), ("same", 3, None, "x", "x", 1, False), ("dead", 6, NOW, None, None, 1, False)], local)  # noqa: E741
    r = spark.createDataFrame([("back", "x", False, 1, False), ("moved", "y", True, 1, False), ("bare", None, True, 1, False), ("yank", "x", True, 1, True), ("same", "x", True, 1, False), ("new", "n", True, 1, False), ("linked", "n", True, 1, False), ("plain", None, False, 1, False)], "filename string, metadata_sha256 string, has_metadata boolean, size long, yanked boolean")
    u = spark.createDataFrame([("linked", "u")], "filename string, sha256 string")
    got = {x.filename: (x.action, x.new_state, x.blob_sha256) for x in diff.reconcile(l, r, u).collect()}
    assert got == {
        "gone": ("tombstone", 6, "x"), "back": ("resurrect", 1, None), "moved": ("update", 0, None), "bare": ("update", 0, None), "yank": ("update", 3, "x"),
        "same": ("none", 3, "x"), "dead": ("none", 6, None), "new": ("insert", 0, None), "linked": ("insert", 2, "u"), "plain": ("insert", 1, None),
    }


def test_sequence_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    got = rows(diff.with_sequence(df, ["k"], 10, partitions=5), "k")
    assert [x[-1] for x in got] == list(range(11, 1011))


def test_sequence_is_that_of_the_order_with_any_columns_and_keys(spark):
    df = spark.range(60000).select((F.col("id") * 7919 % 60000).alias("k"), F.col("id").cast("string").alias("v"), (F.col("id") % 3).alias("w")).where("w <> 1")
    got = rows(diff.with_sequence(df, ["k"], 10, partitions=5).select("k", "v", "change_seq"), "k")
    assert len(got) == 40000 and [x[-1] for x in got] == list(range(11, 40011))
    two = df.select(F.when(F.col("k") % 5 != 0, F.col("k") % 7).alias("a"), F.col("k").cast("string").alias("b"), "v")
    got = rows(diff.with_sequence(two, ["a", "b"], 0, "n"), "a", "b")
    assert [x[-1] for x in got] == list(range(1, 40001))
    same = rows(diff.with_sequence(df.select("w", "v"), ["w"], 0), "change_seq")
    assert [x[-1] for x in same] == list(range(1, 40001)) and [x[0] for x in same] == [0] * 20000 + [2] * 20000
    assert rows(diff.with_sequence(df.where("k < 0"), ["k"], 0)) == []


def test_diff_treats_nulls_as_values(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "id long, v string")
    b = spark.createDataFrame([(1, None), (2, None)], "id long, v string")
    assert [(r.id, r.change) for r in diff.snapshot_diff(a, b, "id", ["v"]).orderBy("id").collect()] == [(1, "unchanged"), (2, "changed")]


# --- campaigns ---


def test_campaign_and_preview_agree(spark):
    a = spark.createDataFrame([(1, "p", 3, 0, "b1", "n"), (2, "p", 4, 0, None, None), (3, "q", 6, 0, None, None), (4, "q", 4, 0, None, None), (5, "q", 5, 0, None, None)], "id long, project string, state int, lane int, blob_sha256 string, target_name string")
    p = spark.createDataFrame([(1, "0.1")], "artifact_id long, version string")
    s = spark.createDataFrame([(2, "c", True, None), (4, "c", False, "0.1"), (1, "c", False, "0.1"), (3, "c", False, "0.1")], "artifact_id long, stage string, permanent boolean, version string")
    w = spark.createDataFrame([(1,), (5,)], "artifact_id long")
    sel = campaign.VersionBelow("0.2")
    assert rows(campaign.preview(a, p, s, sel)) == [(2, 2)]
    after = campaign.reprocess(a, p, s, w, sel)
    assert [(r.id, r.state, r.lane) for r in after["artifacts"].orderBy("id").collect()] == [(1, 2, 1), (2, 4, 0), (3, 6, 0), (4, 2, 1), (5, 5, 0)]
    assert after["payloads"].count() == 0 and sorted(r.artifact_id for r in after["skips"].collect()) == [2, 3] and [r.artifact_id for r in after["work"].collect()] == [5]
    assert after["artifacts"].where("id = 1").first().target_name == "n"
    assert campaign.reprocess(a, p, s, w, campaign.SkippedOnly())["skips"].count() == 4
    free = campaign.unquarantine(a, w)
    assert free["artifacts"].where("id = 5").first().state == 0 and [r.artifact_id for r in free["work"].collect()] == [1]
    for bad in (sel, campaign.SkippedOnly()):
        with pytest.raises(ValueError):
            campaign.unquarantine(a, w, bad)
    with pytest.raises(ValueError):
        campaign.parse_selector({"type": "other"})
    with pytest.raises(ValueError):
        campaign.parse_selector({"type": "project"})


# --- checks ---


def test_clean_registry_has_no_violation(spark):
    a = spark.createDataFrame([(1, 3, "b", None, "n", None, 1, NOW)], "id long, state int, blob_sha256 string, metadata_sha256 string, target_name string, deleted_at timestamp, change_seq long, updated_at timestamp")
    t = {
        "artifacts": a, "payloads": spark.createDataFrame([(1,)], "artifact_id long"), "skips": spark.createDataFrame([], "artifact_id long, permanent boolean, version string"),
        "work": spark.createDataFrame([], "artifact_id long, attempts int, quarantined_at timestamp"), "blobs": spark.createDataFrame([("b", 1)], "sha256 string, segment_id long"), "segments": spark.createDataFrame([(1,)], "id long"),
    }
    report = checks.report(checks.invariants(t))
    assert report.count() == 0 and checks.passed(report)
    t["work"] = spark.createDataFrame([(1, 9, None), (1, 8, None)], "artifact_id long, attempts int, quarantined_at timestamp")
    got = {r.invariant: r.violations for r in checks.report(checks.invariants(t)).collect()}
    assert got == {"attempts_above_most": 1, "most_attempts_unquarantined": 1, "work_of_finished": 2}
    t["blobs"] = spark.createDataFrame([("b", 1), ("z", 1)], "sha256 string, segment_id long")
    t["work"] = t["work"].limit(0)
    assert checks.passed(checks.report(checks.invariants(t)))


def test_report_caps_examples(spark):
    found = [spark.range(100).select(F.lit("x").alias("invariant"), F.format_string("%03d", "id").alias("key"))]
    row = checks.report(found).first()
    assert row.violations == 100 and row.examples == [f"{k:03d}" for k in range(20)]


# --- health ---


@pytest.mark.parametrize(
    ("gauge", "values", "condition"),
    [
        ("wal_bytes", (2 << 30, (2 << 30) + 1), "wal_bytes"), ("checkpoint_failures", (4, 5), "consecutive_checkpoint_failures"), ("disk_free_bytes", (20 << 30, (20 << 30) - 1), "disk_free_bytes"),
        ("read_violations", (0, 1), "read_txn_budget_violations"), ("quarantined_count", (0, 1), "quarantined_count"), ("open_segment_age_s", (43200.0, 43200.5), "open_segment_age"), ("writer_failed_ops", (0, 1), "writer_failed_ops"),
    ],
)
def test_alarm_edges(spark, gauge, values, condition):
    for value, fires in zip(values, (False, True), strict=True):
        row = spark.range(1).select(*[F.lit(value if n == gauge else None).cast(k).alias(n) for n, k in health.GAUGES], F.lit(None).cast("map<string,string>").alias("breakers"), F.lit(None).cast("map<string,int>").alias("stage_failures"))
        assert [r.condition for r in health.alarms(row).collect()] == [condition] * fires


def test_metrics_text(spark):
    m = spark.createDataFrame([("segments_sealed", None, None, 3), ("state_count", "state", "READY", 1), ("gone", None, None, None)], "family string, label string, label_value string, value long")
    assert health.metrics_text(health.metric_lines(m, "r_"), "r_") == '# TYPE r_segments_sealed counter\nr_segments_sealed 3\n# TYPE r_state_count gauge\nr_state_count{state="READY"} 1\n'


# --- scalars ---


def test_scalars(spark):
    one = spark.range(1)
    got = one.select(
        S.human_bytes(F.lit(512)), S.human_bytes(F.lit(1536)), S.human_duration(F.lit(45)), S.human_duration(F.lit(192)), S.human_duration(F.lit(4440)), S.normalized_name(F.lit("A__b.-C")),
        S.percent_encoded(F.lit("a+b/ç~*")), S.url_host(F.lit("https://Ex.ORG:80/x")), S.lag(F.lit(5), F.lit(9)), S.breaker_code(F.lit("open")), S.squeezed(F.lit(" a \n b ")), S.raw_to_hex(S.hex_to_raw(F.lit("0aff"))),
    ).first()
    assert list(got) == ["512 B", "1.5 KB", "45s", "3m12s", "1h14m", "a-b-c", "a%2Bb%2F%C3%A7~%2A", "ex.org", 0, 2, "a b", "0aff"]


def test_utf8_and_jitter(spark):
    assert spark.range(1).select(S.utf8_text(F.unhex(F.lit("EFBBBF41")))).first()[0] == "A"
    assert spark.range(1).select(S.utf8_text(F.unhex(F.lit("FF")))).first()[0] is None
    low, high = spark.range(500).select(S.jittered(F.lit(30.0), 1).alias("x")).agg(F.min("x"), F.max("x")).first()
    assert 15 <= low < 20 and 40 < high < 45


def test_broken_zlib_is_null(spark):
    assert spark.range(1).select(codec.inflated(F.lit(b"xx"))).first()[0] is None


# --- archive ---


def test_layout():
    assert archive.block_layout([3, 3, 3, 20, 1], 6) == [(0, 0), (0, 3), (1, 0), (2, 0), (3, 0)]
    assert archive.block_layout([], 6) == []


def test_segments_round_trip_and_corruption(spark):
    texts = [f"Name: p{k // 20}\nVersion: {k}\nSummary: the same words again and again\n" * 3 for k in range(300)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(999, texts[0])], "id long, text string")
    built = archive.build_segments(df, "text", ["id"], 2, block_bytes=4096)
    kept = spark.createDataFrame(built.collect(), built.schema)
    assert sorted(r.body.decode() for r in archive.read_records(kept).collect()) == sorted(texts)
    index = archive.footer_records(kept)
    assert archive.verify(kept, index).count() == 0
    raw = kept.first()
    hurt = bytearray(raw.data)
    hurt[len(hurt) // 4] ^= 255
    broken = spark.createDataFrame([(raw.segment_id, bytes(hurt)), (77, None)], "segment_id long, data binary")
    assert {r.problem for r in archive.verify(broken, index.where(F.col("segment_id") == raw.segment_id)).collect()} >= {"unreadable"}
    assert {r.problem for r in archive.verify(kept, index.where("block_no <> 0")).collect()} == {"extra"}


def test_block_compression_beats_single_records():
    import zstandard

    docs = [(f"Name: p{k // 20}\nVersion: 1.{k}\n" + f"Description of p{k // 20}: words words words\n" * 8).encode() for k in range(400)]
    b = archive.SegmentBuilder()
    for d in docs:
        b.add(d)
    one = sum(len(zstandard.ZstdCompressor(level=10).compress(d)) for d in docs)
    assert len(b.seal()) * 4 < sum(map(len, docs)) and len(b.body) < one
    with pytest.raises(archive.CorruptSegment):
        archive.read_footer(b"short")


# --- conversion ---


def boom(*_):
    raise RuntimeError("x")


def pre(parsed, filename, allow):
    if not allow:
        raise convert.PrereleaseNeeded("pre")
    return [{"name": "a"}]


@pytest.mark.parametrize(
    ("body", "parse", "records", "kind", "reason"),
    [
        (b"\xff", dict, dict, "skip", "invalid_metadata_encoding"),
        (b"x", boom, dict, "retry", "parse_runtime_error"),
        (b"x", convert.parse_headers, dict, "skip", "invalid_metadata"),
        (b"Name: a", convert.parse_headers, boom, "retry", "conversion_runtime_error"),
        (b"Name: a", convert.parse_headers, lambda *_: [], "retry", "no_records_returned"),
        (b"Name: a", convert.parse_headers, lambda *_: [{"name": "a"}, {"name": "b"}], "retry", "name_disagreement"),
        (b"Name: a", convert.parse_headers, pre, "ok", ""),
    ],
)
def test_convert_matrix(body, parse, records, kind, reason):
    got = convert.convert_one(body, "f", "1", parse, records)
    assert (got["kind"], got["reason"]) == (kind, reason)
    assert got["permanent"] == (got["version"] is None)


def test_second_attempt_tells_the_first_error():
    def always(parsed, filename, allow):
        raise convert.PrereleaseNeeded("first") if not allow else convert.ConversionError("second")

    got = convert.convert_one(b"Name: a", "f", "1", convert.parse_headers, always)
    assert got["kind"] == "skip" and "first" in got["details"]


# --- sources ---


def test_index_without_serial_is_a_protocol_error(spark):
    pages = spark.createDataFrame([('{"projects": []}',), ('{"meta": {"_last-serial": 3}, "projects": [{"name": "A.b", "_last-serial": 2}]}',)], "body string")
    assert rows(landed.index_rows(pages), "error") == [("a-b", 2, 3, None), (None, None, None, "protocol")]


def test_responses(spark):
    r = spark.createDataFrame([(200, "application/json", "{}"), (200, "text/html", "{}"), (200, "application/json", "{"), (304, None, None)], "status int, content_type string, body string")
    assert [x["class"] for x in landed.responses(r).collect()] == ["ok", "protocol", "protocol", "ok"]


def test_config():
    assert config_from_env({"CAIRNFLOW_FETCH_BATCH": "7"}).fetch_batch == 7
    assert Config().workers(1) == 1 and Config().workers(8) == 6
    for bad in ({"CAIRNFLOW_FETCH_BATCH": "x"}, {"CAIRNFLOW_FETCH_BATCH": "0"}, {"CAIRNFLOW_FILES_PER_MINUTE": "1900"}, {"CAIRNFLOW_BACKOFF_CAP_S": "1"}):
        with pytest.raises(ValueError):
            config_from_env(bad)


def test_catalog(spark, tmp_path):
    catalog.init(spark, str(tmp_path))
    catalog.init(spark, str(tmp_path))
    wrong = spark.createDataFrame([("a", 1, "x")], "name string, serial int, other string")
    assert len(catalog.schema_problems(wrong, model.TABLES["remote_index"])) == 3
    twice = spark.createDataFrame([("a", 1, NOW), ("a", 2, NOW), (None, 1, NOW)], "name string, serial long, updated_at timestamp")
    assert {r.constraint: r.violations for r in catalog.data_problems(twice, model.TABLES["remote_index"]).collect()} == {"not null name": 1, "key name": 1}
    assert "name string NOT NULL" in model.TABLES["remote_index"].ddl()
    wrong.write.mode("overwrite").parquet(f"{tmp_path}/remote_index")
    with pytest.raises(catalog.SchemaMismatch):
        catalog.init(spark, str(tmp_path))


# --- imports and publishing ---


def test_validated_bodies(spark):
    import hashlib
    import zlib

    good = hashlib.sha256(b"abc").hexdigest()
    b = spark.createDataFrame([(good, zlib.compress(b"abc"), 3), (good, zlib.compress(b"abd"), 3), (good, b"?", 3), (good, zlib.compress(b"abc"), 4)], "sha256 string, z_body binary, n_bytes int")
    assert [r.valid for r in imports.validated(b).collect()] == [True, False, False, False]


def test_publish_trigger_edges(spark):
    dirty = spark.createDataFrame([(NOW - dt.timedelta(seconds=299),)], "dirty_since timestamp")
    assert not publish.should_publish(dirty, at()).first().publish
    assert publish.should_publish(dirty, at("2024-01-01 00:00:01")).first().publish
    assert publish.should_publish(dirty, at(), count=1).first().publish
    assert not publish.should_publish(dirty.limit(0), at()).first().publish


# --- control ---


def test_breaker():
    b = control.Breaker()
    for _ in range(5):
        b = control.settled(control.admitted(b, 0), 0, failed=True)
    assert b.name == "open" and control.admitted(b, 59.9) is None
    trial = control.admitted(b, 60)
    assert trial.name == "half_open" and control.admitted(trial, 60) is None
    again = control.settled(trial, 61, failed=True)
    assert again.name == "open" and control.admitted(again, 120) is None
    closed = control.settled(control.admitted(again, 121), 121, failed=False)
    assert closed == control.Breaker()
    assert control.folded(control.Breaker(), [(t, True) for t in range(30)]) == control.Breaker(5, 4)


def test_limiter_reserves_and_total():
    lim = control.HierarchicalLimiter(2000, {"pages": 200, "files": 1800})
    got = {"pages": 0, "files": 0}
    for ms in range(0, 60_000, 5):
        for c in got:
            got[c] += lim.acquire(c, ms / 1000)
    assert sum(got.values()) <= 2000 + 34 and got["pages"] >= 195 and got["files"] >= 1750
    alone = control.HierarchicalLimiter(2000, {"pages": 200, "files": 1800})
    assert sum(alone.acquire("pages", ms / 1000) for ms in range(0, 60_000, 5)) > 1900
    lim.penalise("files", 60, 10)
    assert not lim.acquire("files", 69) and lim.own["files"].wait(65) == pytest.approx(5)


def test_guard_backoff_queue():
    g = control.DiskGuard(floor=100)
    assert [g.check(x) for x in (100, 99, 119, 120)] == [False, True, True, False]
    assert [control.backoff(n) for n in (1, 2, 20)] == [30, 60, 21_600]
    k = control.KeyedBackoff()
    assert [k.retry("a", 0) for _ in range(9)] == [False] * 8 + [True] and not k.ready("a", 1e9)
    p = control.PendingSet()
    p.add("b", "a", "b")
    assert p.drain(1) == ["b"] and p.drain(5) == ["a"]
    q = control.ByteBudget(10)
    assert q.offer(50) and not q.offer(1)
    q.release(50)
    assert q.offer(9) and not q.offer(2)


# --- streams ---


def test_stream_equals_batch(spark, sf, tmp_path):
    e = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("failed", F.col("event_type") != "purchase")
    path = str(tmp_path / "in")
    e.repartition(3).write.parquet(path)
    snaps = pipeline.Snapshots(spark, str(tmp_path / "snap"), ["user_id"])
    stream = pipeline.changes_since(spark, path, e.schema)
    pipeline.micro_batches(stream.select("user_id", "event_id", "event_type"), lambda b, n: snaps.apply(b, n, "event_id"), str(tmp_path / "cp")).awaitTermination()
    want = e.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("t"))
    assert sorted((r.user_id, r.event_type) for r in snaps.latest().collect()) == sorted((r.user_id, r.t) for r in want.collect())
    before = snaps._paths()
    snaps.apply(e.select("user_id", "event_id", "event_type"), before[-1], "event_id")
    assert snaps._paths() == before
    got: dict = {}
    states = pipeline.breaker_states(stream, "user_id", "ts", "event_id", "failed")
    q = states.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp2")).foreachBatch(lambda b, n: got.update({r.key: (r.state, r.streak) for r in b.collect()})).trigger(availableNow=True).start()
    q.awaitTermination()
    assert got == {r.key: (r.state, r.streak) for r in pipeline.breaker_batch(e, "user_id", "ts", "event_id", "failed").collect()}


def test_retry_after_is_null_where_it_is_neither(spark):
    rows = spark.createDataFrame([("soon",), (None,), ("-3",), ("7",)], "v string")
    assert [r[0] for r in rows.select(S.retry_after_seconds(F.col("v"), F.lit("2024-01-31").cast("timestamp"))).collect()] == [None, None, 0.0, 7.0]


def test_crc32_and_token_bucket_against_plain_python(spark):
    import zlib

    from cairnflow.plans import registry, registry_plans  # noqa: F401

    folder = "/root/testdata/sf0.001"
    got = registry.QUERIES["crc32_digest"](spark, folder)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = got.collect()
    number = next(c for c, t in got.dtypes if t in ("bigint", "int") and c != "doc_id")
    assert len(rows) == len(texts) and all(r[number] == zlib.crc32((texts[r.doc_id] or "").encode()) for r in rows)
    bucket, tokens, last, given = control.TokenBucket(2.0, 3.0), 3.0, 0.0, 0
    for step in range(200):
        now = step * 0.17
        tokens, last = min(3.0, tokens + (now - last) * 2.0), now
        can = bucket.can(now)
        assert can == (tokens >= 1 - 1e-9)
        if can:
            bucket.take(now)
            tokens -= 1
            given += 1
    assert given > 60


def test_segment_rules(spark):
    at = lambda h: F.timestamp_add("HOUR", F.lit(h), F.lit("2024-01-01").cast("timestamp"))
    segments = spark.createDataFrame([(3, None, None, None), (7, "2024-01-01", 10, 1)], "id long, sealed_at string, bytes long, records long").withColumn("sealed_at", F.col("sealed_at").cast("timestamp"))
    names = spark.createDataFrame([("000009.zst",), ("junk",)], "name string")
    assert archive.next_segment_id(segments, names) == 10 and archive.next_segment_id(segments.limit(0), names.limit(0)) == 1
    files = spark.createDataFrame([(3, 64 << 20), (7, 5), (8, 0), (9, 5)], "id long, bytes long").withColumn("opened_at", F.when(F.col("id") == 9, at(-7)).otherwise(at(-1)))
    assert sorted(r.id for r in archive.due_for_seal(files, at(0)).collect()) == [3, 9]
    done = spark.createDataFrame([(3, 99, 4), (12, 5, 1)], "id long, bytes long, records long")
    assert {(r.id, r.bytes, r.records, r.sealed_at is not None) for r in archive.sealed(segments, done, at(0)).collect()} == {(3, 99, 4, True), (7, 10, 1, True), (12, 5, 1, True)}
    assert sorted(r.id for r in archive.stale_open(files, segments).collect()) == [3, 8, 9]


def test_blocks_are_read_once_and_faults_are_told(spark):
    bodies = [(n, f"body {n} " * 40) for n in range(200)]
    built = archive.build_segments(spark.createDataFrame(bodies, "id long, text string"), "text", ["id"], 2, block_bytes=4096, seal_bytes=300)
    rows = built.collect()
    assert len({r.segment_id for r in rows}) == len(rows) > 2
    segments = spark.createDataFrame(rows, built.schema)
    index, blocks = archive.footer_records(segments), archive.segment_blocks(segments)
    claimed = spark.createDataFrame([(n, hashlib.sha256(t.encode()).hexdigest()) for n, t in bodies[::9]] + [(500, "no such")], "id long, sha256 string")
    got = {r.id: (r.outcome, r.body) for r in archive.claimed_bodies(blocks, index, claimed).collect()}
    assert got[500] == ("archive_blob_missing", None) and all(got[n] == ("ok", bytearray(t.encode())) for n, t in bodies[::9])
    broken = blocks.withColumn("frame", F.when(F.col("block_no") == 0, F.lit(b"broken")).otherwise(F.col("frame")))
    told = {r.outcome for r in archive.claimed_bodies(broken, index, claimed).collect()}
    assert told == {"ok", "corrupt_blob", "archive_blob_missing"}
