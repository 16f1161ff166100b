"""The work queue: what can be claimed, and what outcomes do to the registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnflow.functions.scalars import backoff_seconds, edge_allowed
from cairnflow.model import CLAIM_BATCH, MAX_ATTEMPTS, State


def claim(candidates: DataFrame, deferred: DataFrame | None = None, in_flight: list[int] | None = None, cursor: tuple | None = None, limit: int = CLAIM_BATCH) -> DataFrame:
    """The first ``limit`` candidates by (lane, project, id) that are neither deferred nor in flight, after a cursor.

    deferred: ids only (see ``deferrals``); an anti join, then a top-k that sorts no more than k rows of a task."""
    rows = candidates
    if cursor is not None:
        key = F.struct("lane", "project", "id")
        rows = rows.where(key > F.struct(*[F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in zip(("lane", "project", "id"), cursor, strict=True)]))
    if in_flight:
        rows = rows.where(~F.col("id").isin(in_flight))
    if deferred is not None:
        rows = rows.join(deferred.select("id"), "id", "left_anti")
    return rows.orderBy("lane", "project", "id").limit(limit)


def deferrals(work: DataFrame, stage: str, now: Column) -> DataFrame:
    """id of the artifacts whose work in a stage is quarantined or not due yet."""
    return work.where((F.col("stage") == stage) & (F.col("quarantined_at").isNotNull() | (F.col("next_attempt_at") > now))).select(F.col("artifact_id").alias("id"))


def apply_outcomes(artifacts: DataFrame, work: DataFrame, outcomes: DataFrame, now: Column, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """One row per outcome (id, stage, kind, target_state, reason): what becomes of it.

    result: ok, skip, retry, quarantine, ignored (rate limited: nothing is written) or rejected (an edge that the
    state machine lacks). new_state, attempts, next_attempt_at (without jitter), drop_work, write_error follow.
    Quarantine comes with the attempt after the last allowed one. Retries but that one leave no error row.
    """
    j = outcomes.join(artifacts.select("id", "state"), "id").join(work.select(F.col("artifact_id").alias("id"), "stage", F.col("attempts").alias("had")), ["id", "stage"], "left")
    attempts = F.coalesce("had", F.lit(0)) + 1
    target = F.when(F.col("kind") == "skip", int(State.SKIPPED)).when(F.col("kind") == "ok", F.col("target_state"))
    result = (
        F.when(F.col("kind") == "rate_limited", "ignored")
        .when((F.col("kind") == "retry") & (attempts > max_attempts), "quarantine")
        .when(F.col("kind") == "retry", "retry")
        .when(edge_allowed(F.col("state"), target), F.col("kind"))
        .otherwise("rejected")
    )
    after = F.when(F.col("result").isin("ok", "skip"), target).when(F.col("result") == "quarantine", int(State.QUARANTINED)).otherwise(F.col("state"))
    retried = F.col("result").isin("retry", "quarantine")
    due = F.when(F.col("result") == "quarantine", now).when(F.col("result") == "retry", F.timestamp_seconds(F.unix_timestamp(now) + backoff_seconds(attempts)))
    return j.withColumn("result", result).select(
        "id", "stage", "kind", "result", F.col("state").alias("old_state"), after.cast("int").alias("new_state"), F.when(retried, attempts).cast("int").alias("attempts"), due.alias("next_attempt_at"),
        F.col("result").isin("ok", "skip").alias("drop_work"), F.col("result").isin("skip", "quarantine").alias("write_error"),
    )


def outcome_counts(applied: DataFrame) -> DataFrame:
    return applied.groupBy("stage", "result").count().withColumnRenamed("count", "n")


def merged(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``old`` whose key ``new`` has not, and all rows of ``new``: MERGE for plain files."""
    return old.join(new.select(*key), key, "left_anti").unionByName(new)


def first_wins(known: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Insert or ignore: what is new in ``found``, one row for each key (the smallest row)."""
    columns = [c for c in found.columns if c != key]
    once = found.groupBy(key).agg(F.min(F.struct(*columns)).alias("_s")).select(key, *[F.col(f"_s.{c}").alias(c) for c in columns])
    return once.join(known.select(key), key, "left_anti")


def keyset_chunks(df: DataFrame, partition: str, order: str, size: int) -> DataFrame:
    """The rows with the number of their page inside ``partition``."""
    from pyspark.sql import Window

    return df.withColumn("chunk", F.floor((F.row_number().over(Window.partitionBy(partition).orderBy(order)) - 1) / size).cast("long"))
