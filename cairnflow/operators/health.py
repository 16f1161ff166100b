"""Health: census, queues, error roll-ups, one-row snapshot, alarms and the metrics text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnflow.functions.scalars import label_escaped, lag
from cairnflow.model import BREAKER_FAILURES, DISK_FLOOR_BYTES, EMA_ALPHA, PENDING, SEAL_AGE_S, State


def state_census(artifacts: DataFrame) -> DataFrame:
    """state, name, n of every state, those without rows too."""
    spark = artifacts.sparkSession
    states = spark.createDataFrame([(int(s), s.name) for s in State], "state int, name string")
    counts = artifacts.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
    return states.join(counts, "state", "left").select("state", "name", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def depth_by_lane(rows: DataFrame, lane: str = "lane") -> DataFrame:
    return rows.groupBy(lane).agg(F.count(F.lit(1)).alias("depth"))


def oldest_pending(rows: DataFrame, since: str, now: Column) -> DataFrame:
    oldest = F.min(F.col(since).cast("timestamp"))
    return rows.agg(oldest.alias("oldest"), ((F.unix_micros(now) - F.unix_micros(oldest)) / 1e6).alias("age_s"))


def pending_backlog(artifacts: DataFrame) -> DataFrame:
    """backlog and distinct projects of pending artifacts, in one pass."""
    waits = F.col("state").isin([int(s) for s in PENDING])
    return artifacts.where(waits).agg(F.count(F.lit(1)).alias("backlog"), F.count_distinct("project").alias("projects_stale"))


def errors_by_category(errors: DataFrame, category: str, created: str, now: Column) -> DataFrame:
    """category, last_hour, last_day: both windows half open, in one aggregation."""
    within = lambda h: F.count_if(F.col(created) >= F.timestamp_add("HOUR", F.lit(-h), now))
    return errors.where(F.col(created) >= F.timestamp_add("HOUR", F.lit(-24), now)).groupBy(F.col(category).alias("category")).agg(within(1).alias("last_hour"), within(24).alias("last_day"))


def recent_errors(errors: DataFrame, created: str, order: str, category: tuple[str, str] | None = None, since: Column | None = None, limit: int = 100) -> DataFrame:
    rows = errors
    if category is not None:
        rows = rows.where(F.col(category[0]) == category[1])
    if since is not None:
        rows = rows.where(F.col(created) >= since)
    return rows.orderBy(F.col(created).desc(), F.col(order).desc()).limit(limit)


def snapshot(artifacts: DataFrame, segments: DataFrame, errors: DataFrame, now: Column, remote_serial: int | None) -> DataFrame:
    """One row: freshness, census, queues, errors and archive, each table read once."""
    states = [F.count_if(F.col("state") == int(s)).alias(f"{s.name.lower()}_count") for s in State]
    waits = F.col("state").isin([int(s) for s in PENDING])
    a = artifacts.agg(
        *states,
        F.coalesce(F.max("serial"), F.lit(0)).alias("local_serial"),
        F.coalesce(F.max("change_seq"), F.lit(0)).alias("change_seq"),
        F.count_if(waits).alias("backlog"),
        F.count_distinct(F.when(waits, F.col("project"))).alias("projects_stale"),
        F.count_distinct("project").alias("projects_indexed"),
        ((F.unix_micros(now) - F.unix_micros(F.min(F.when(waits, F.col("updated_at"))))) / 1e6).alias("oldest_pending_s"),
    )
    g = segments.agg(F.count_if(F.col("sealed_at").isNotNull()).alias("segments_sealed"), F.count_if(F.col("sealed_at").isNull()).alias("segments_open"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("archive_bytes"))
    e = errors.agg(F.count_if(F.col("created_at") >= F.timestamp_add("HOUR", F.lit(-1), now)).alias("errors_hour"), F.count_if(F.col("created_at") >= F.timestamp_add("DAY", F.lit(-1), now)).alias("errors_day"))
    # three frames of one row each
    return a.crossJoin(g).crossJoin(e).withColumn("serial_lag", lag(F.lit(remote_serial).cast("long"), F.col("local_serial")))


#: What the alarms read beside the snapshot: (column, type).
GAUGES = [("wal_bytes", "long"), ("checkpoint_failures", "long"), ("disk_free_bytes", "long"), ("read_violations", "long"), ("previous_read_violations", "long"), ("quarantined_count", "long"), ("projects_stale", "long"), ("index_age_s", "double"), ("open_segment_age_s", "double"), ("writer_failed_ops", "long")]


def alarms(health: DataFrame, wal_bytes: int = 2 << 30, checkpoint_failures: int = BREAKER_FAILURES, disk_floor: int = DISK_FLOOR_BYTES, seal_s: float = SEAL_AGE_S, stale_s: float = 3600.0) -> DataFrame:
    """condition, severity, subject of every rule that fires, critical ones first, then by name.

    health: one row with GAUGES, breakers (map name -> state) and stage_failures (map name -> count). Null gauges are
    unknown and never fire."""
    c = F.col
    rules = [
        ("wal_bytes", "critical", c("wal_bytes") > wal_bytes),
        ("consecutive_checkpoint_failures", "critical", c("checkpoint_failures") >= checkpoint_failures),
        ("disk_free_bytes", "critical", c("disk_free_bytes") < disk_floor),
        ("read_txn_budget_violations", "warning", c("read_violations") > F.coalesce("previous_read_violations", F.lit(0))),
        ("quarantined_count", "warning", c("quarantined_count") > 0),
        ("index_lag_stale", "warning", (c("projects_stale") > 0) & (c("index_age_s") > stale_s)),
        ("open_segment_age", "warning", c("open_segment_age_s") > 2 * seal_s),
        ("writer_failed_ops", "warning", c("writer_failed_ops") > 0),
    ]
    row = lambda name, level, subject: F.struct(F.lit(name).alias("condition"), F.lit(level).alias("severity"), subject.alias("subject"))
    single = F.filter(F.array(*[F.when(fires, row(name, level, F.lit(""))) for name, level, fires in rules]), lambda x: x.isNotNull())
    breakers = F.transform(F.filter(F.map_entries("breakers"), lambda e: e["value"] != "closed"), lambda e: row("breaker_open", "warning", e["key"]))
    stages = F.transform(F.filter(F.map_entries("stage_failures"), lambda e: e["value"] > 0), lambda e: row("stage_consecutive_failures", "warning", e["key"]))
    none = F.array().cast("array<struct<condition:string,severity:string,subject:string>>")
    fired = health.select(F.explode(F.concat(single, F.coalesce(breakers, none), F.coalesce(stages, none))).alias("a")).select("a.*")
    return fired.orderBy(F.when(F.col("severity") == "critical", 0).otherwise(1), "condition", "subject")


def metric_lines(metrics: DataFrame, prefix: str = "registry_") -> DataFrame:
    """family, line: exposition lines of metrics(family, label, label_value, value); null values are dropped."""
    labels = F.when(F.col("label").isNotNull(), F.concat(F.lit("{"), F.col("label"), F.lit('="'), label_escaped(F.col("label_value")), F.lit('"}'))).otherwise("")
    # a family that counts what happened says so by its name, and only grows
    kind = F.when(F.col("family").rlike("_(ops|violations|sealed|acquired|denied)$|^queues_.*_count$|^archive_bytes$"), "counter").otherwise("gauge")
    return metrics.where("value is not null").select("family", kind.alias("type"), F.concat(F.lit(prefix), F.col("family"), labels, F.lit(" "), F.col("value").cast("string")).alias("line"))


def metrics_text(lines: DataFrame, prefix: str = "registry_") -> str:
    """The whole exposition; as many lines as there are metrics, so it is small."""
    out: list[str] = []
    last = None
    for r in sorted(lines.collect(), key=lambda r: (r.family, r.line)):
        if r.family != last:
            out.append(f"# TYPE {prefix}{r.family} {r.type}")
            last = r.family
        out.append(r.line)
    return "\n".join([*out, ""])


def throughput_ema(events: DataFrame, key: str, ts: str, tie: str, alpha: float = EMA_ALPHA) -> DataFrame:
    """key, ema of 1 / seconds between a key's events, in the order of (ts, tie); the first event and gaps of no time
    say nothing. The fold runs over one sorted array of a key's gaps."""

    w = Window.partitionBy(key).orderBy(ts, tie)
    gaps = events.select(key, ts, tie, ((F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.lag(F.col(ts).cast("timestamp")).over(w))) / 1e6).alias("gap")).where("gap > 0")
    folded = gaps.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(ts, tie, "gap"))).alias("g"))
    step = lambda acc, x: F.when(acc.isNull(), 1 / x["gap"]).otherwise(F.lit(alpha) / x["gap"] + F.lit(1 - alpha) * acc)
    return folded.select(key, F.aggregate("g", F.lit(None).cast("double"), step).alias("ema"))


def exit_code(found: DataFrame, reachable: bool = True, usable: bool = True) -> int:
    """2 where the request makes no sense, 1 where the registry cannot be read, 3 if a critical alarm fires, else 0."""
    if not usable:
        return 2
    if not reachable:
        return 1
    return 0 if found.where("severity = 'critical'").isEmpty() else 3


def read_durations(reads: DataFrame, duration_ms: str, budget_ms: float = 250.0) -> DataFrame:
    """longest_ms, over_budget of the reads in one pass."""
    return reads.agg(F.max(duration_ms).alias("longest_ms"), F.count_if(F.col(duration_ms) > budget_ms).alias("over_budget"))


def log_lines(events: DataFrame, ts: str, level: str, message: str, keys: list[str]) -> DataFrame:
    """line: a JSON object for each event with its time, level and message, and those of its correlation keys it has."""
    fields = [F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("ts"), F.col(level).alias("level"), F.col(message).alias("message"), *(F.col(k) for k in keys)]
    return events.select(F.to_json(F.struct(*fields)).alias("line"))


