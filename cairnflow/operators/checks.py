"""Integrity checks: every invariant as a set of violating rows, and one report over all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnflow.model import EXAMPLES, MAX_ATTEMPTS, PENDING, TERMINAL, State

#: Lots that rows of one invariant are ranked in.
LOTS = 64
INFORMATIONAL = ["orphaned_blob", "tombstoned_with_payload"]


def _each(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """invariant, key of the rows that break each rule, in one pass over the table."""
    broken = F.filter(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]), lambda x: x.isNotNull())
    return df.select(F.explode(broken).alias("invariant"), F.col(key).cast("string").alias("key"))


def invariants(t: dict[str, DataFrame], max_attempts: int = MAX_ATTEMPTS) -> list[DataFrame]:
    """invariant, key (text) of the rows that break it; t has artifacts, payloads, skips, work, blobs, segments.

    Rules over the same rows or the same join share it: the artifacts are read once for all rules on their own columns,
    once for those on their blobs, and once for each of the other tables."""
    a, p, s, w, b, g = (t[k] for k in ("artifacts", "payloads", "skips", "work", "blobs", "segments"))
    state = lambda *xs: F.col("state").isin([int(x) for x in xs])
    a_of = lambda df: df.join(a.select(F.col("id").alias("artifact_id"), "state", "deleted_at"), "artifact_id")
    without = lambda rows, other: rows.join(other.select(F.col("artifact_id").alias("id")), "id", "left_anti")
    twice = a.groupBy("change_seq").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("updated_at").alias("d"))
    own = {
        "need_metadata_with_blob": state(State.NEED_METADATA) & F.col("blob_sha256").isNotNull(),
        "no_metadata_with_digest": state(State.NO_METADATA) & F.col("metadata_sha256").isNotNull(),
        "deleted_without_time": state(State.DELETED) & F.col("deleted_at").isNull(),
        "time_without_deleted": ~state(State.DELETED) & F.col("deleted_at").isNotNull(),
        "unknown_state": ~state(*State),
        "name_outside_ready": ~state(State.READY) & F.col("target_name").isNotNull(),
    }
    unresolved = {"need_convert_without_blob": state(State.NEED_CONVERT), "blob_unresolved": F.col("blob_sha256").isNotNull()}
    skips = {"permanent_skip_with_version": F.col("permanent") & F.col("version").isNotNull(), "open_skip_without_version": ~F.col("permanent") & F.col("version").isNull()}
    attempts = {"attempts_above_most": F.col("attempts") > max_attempts, "most_attempts_unquarantined": (F.col("attempts") == max_attempts) & F.col("quarantined_at").isNull()}
    return [
        _each(a, "id", own),
        _each(a.join(b.select(F.col("sha256").alias("blob_sha256")), "blob_sha256", "left_anti"), "id", unresolved),
        _each(without(a.where(state(State.READY)), p), "id", {"ready_without_payload": F.lit(True)}),
        _each(without(a.where(state(State.SKIPPED)), s), "id", {"skipped_without_skip": F.lit(True)}),
        _each(without(a.where(state(State.QUARANTINED)), w.where("quarantined_at is not null")), "id", {"quarantined_without_work": F.lit(True)}),
        _each(a_of(p), "artifact_id", {"payload_without_ready": ~state(State.READY), "tombstoned_with_payload": F.col("deleted_at").isNotNull()}),
        _each(s, "artifact_id", skips),
        _each(a_of(s), "artifact_id", {"skip_of_unskipped": ~state(State.SKIPPED)}),
        _each(w, "artifact_id", attempts),
        _each(a_of(w), "artifact_id", {"work_of_finished": state(*TERMINAL)}),
        _each(b.join(g.select(F.col("id").alias("segment_id")), "segment_id", "left_anti"), "sha256", {"segment_unresolved": F.lit(True)}),
        _each(b.join(a.select(F.col("blob_sha256").alias("sha256")), "sha256", "left_anti"), "sha256", {"orphaned_blob": F.lit(True)}),
        _each(twice, "change_seq", {"duplicate_change_seq": (F.col("n") > 1) & (F.col("d") > 1)}),
    ]


def report(found: list[DataFrame], examples: int = EXAMPLES) -> DataFrame:
    """invariant, informational, violations, examples (the first few keys): one job over the union of all checks.

    Rows are ranked inside lots first, so that an invariant which many rows break is no single group."""
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    lots = rows.withColumn("lot", F.pmod(F.xxhash64("key"), F.lit(LOTS)))
    counts = lots.groupBy("invariant").agg(F.count(F.lit(1)).alias("violations"))
    nth = F.row_number().over(Window.partitionBy("invariant", "lot").orderBy("key"))
    some = lots.withColumn("nth", nth).where(F.col("nth") <= examples).groupBy("invariant").agg(F.slice(F.array_sort(F.collect_list("key")), 1, examples).alias("examples"))
    return counts.join(some, "invariant").select("invariant", F.col("invariant").isin(INFORMATIONAL).alias("informational"), "violations", "examples")


def passed(rows: DataFrame) -> bool:
    """Whether no invariant but the informational ones is broken."""
    return rows.where(~F.col("informational")).isEmpty()


def sequence_matches(artifacts: DataFrame, counter: int) -> DataFrame:
    """The largest change_seq where it is not the writer's counter."""
    return artifacts.agg(F.coalesce(F.max("change_seq"), F.lit(0)).alias("largest")).where(F.col("largest") != counter)


def footer_diff(footer: DataFrame, blobs: DataFrame) -> DataFrame:
    """sha256, problem of a segment's footer (sha256, block_no, offset, length) against the index: missing, extra, mismatched."""
    place = ["block_no", "offset", "length"]
    a = footer.select("sha256", F.struct(*place).alias("f"))
    b = blobs.select("sha256", F.struct(*place).alias("x"))
    problem = F.when(F.col("x").isNull(), "missing").when(F.col("f").isNull(), "extra").when(~F.col("f").eqNullSafe(F.col("x")), "mismatched")
    return a.join(b, "sha256", "full_outer").select("sha256", problem.alias("problem")).where("problem is not null")


def pending(a: DataFrame) -> DataFrame:
    return a.where(F.col("state").isin([int(x) for x in PENDING]))
