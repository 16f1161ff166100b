"""Selector-driven campaigns: reprocessing with a dry run, unquarantine, recovery, retention."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnflow.model import State


@dataclass(frozen=True)
class VersionBelow:
    version: str


@dataclass(frozen=True)
class InState:
    state: int


@dataclass(frozen=True)
class OfProject:
    project: str


@dataclass(frozen=True)
class SkippedOnly:
    pass


Selector = VersionBelow | InState | OfProject | SkippedOnly


def parse_selector(spec: dict) -> Selector:
    """From its JSON form: type version_below, state, project or skipped_only."""
    kinds = {"version_below": (VersionBelow, "version"), "state": (InState, "state"), "project": (OfProject, "project"), "skipped_only": (SkippedOnly, None)}
    if spec.get("type") not in kinds:
        raise ValueError(f"unknown selector type: {spec.get('type')!r}")
    make, name = kinds[spec["type"]]
    if name and name not in spec:
        raise ValueError(f"a {spec['type']} selector needs {name}")
    return make(spec[name]) if name else make()


def _live(artifacts: DataFrame) -> DataFrame:
    return artifacts.where(F.col("state") != int(State.DELETED))


def stale_skips(artifacts: DataFrame, skips: DataFrame, version: str) -> DataFrame:
    """Skips that a newer version may overturn. Versions compare as text, as the stored ones always did."""
    return skips.where(~F.col("permanent") & (F.col("version") < version)).join(_live(artifacts).select(F.col("id").alias("artifact_id")), "artifact_id", "left_semi")


def selected(artifacts: DataFrame, payloads: DataFrame, skips: DataFrame, selector: Selector) -> DataFrame:
    """id of the artifacts that a campaign takes; each once, never a deleted one."""
    live = _live(artifacts)
    match selector:
        case OfProject(project):
            return live.where(F.col("project") == project).select("id")
        case InState(state):
            return live.where(F.col("state") == int(state)).select("id")
        case SkippedOnly():
            return live.where(F.col("state") == int(State.SKIPPED)).select("id")
        case VersionBelow(version):
            old = payloads.where(F.col("version") < version).select(F.col("artifact_id").alias("id"))
            return old.union(stale_skips(artifacts, skips, version).select("artifact_id")).distinct().join(live.select("id"), "id", "left_semi")
    raise TypeError(selector)


def preview(artifacts: DataFrame, payloads: DataFrame, skips: DataFrame, selector: Selector) -> DataFrame:
    """artifact_count, skips_to_clear_count, by the campaign's own predicates."""
    n = selected(artifacts, payloads, skips, selector).agg(F.count(F.lit(1)).alias("artifact_count"))
    if isinstance(selector, VersionBelow):
        m = stale_skips(artifacts, skips, selector.version).agg(F.count(F.lit(1)).alias("skips_to_clear_count"))
        return n.crossJoin(m)  # one row each
    return n.withColumn("skips_to_clear_count", F.lit(0).cast("long"))


def reprocess(artifacts: DataFrame, payloads: DataFrame, skips: DataFrame, work: DataFrame, selector: Selector) -> dict[str, DataFrame]:
    """The tables after the campaign: state NEED_CONVERT in lane 1, no payload, no work, and for a version campaign
    no stale skips. Names that a payload had given stay until the next conversion."""
    ids = selected(artifacts, payloads, skips, selector).withColumn("_hit", F.lit(True))
    hit = F.coalesce("_hit", F.lit(False))
    after = artifacts.join(ids, "id", "left").withColumn("state", F.when(hit, int(State.NEED_CONVERT)).otherwise(F.col("state")).cast("int")).withColumn("lane", F.when(hit, 1).otherwise(F.col("lane")).cast("int")).drop("_hit")
    gone = ids.select(F.col("id").alias("artifact_id"))
    left = skips.join(stale_skips(artifacts, skips, selector.version), skips.columns, "left_anti") if isinstance(selector, VersionBelow) else skips
    return {"artifacts": after, "payloads": payloads.join(gone, "artifact_id", "left_anti"), "skips": left, "work": work.join(gone, "artifact_id", "left_anti")}


def unquarantine(artifacts: DataFrame, work: DataFrame, selector: Selector | None = None) -> dict[str, DataFrame]:
    """Quarantined artifacts start over, and all their work goes; by project or all of them."""
    if isinstance(selector, (VersionBelow, SkippedOnly)):
        raise ValueError("only a project or the quarantined state can be released")
    hit: Column = F.col("state") == int(State.QUARANTINED)
    if isinstance(selector, OfProject):
        hit = hit & (F.col("project") == selector.project)
    ids = artifacts.where(hit).select(F.col("id").alias("artifact_id"))
    return {"artifacts": artifacts.withColumn("state", F.when(hit, int(State.NEED_METADATA)).otherwise(F.col("state")).cast("int")), "work": work.join(ids, "artifact_id", "left_anti")}


def recover_segment(artifacts: DataFrame, blobs: DataFrame, payloads: DataFrame, segment_id: int) -> dict[str, DataFrame]:
    """After a segment was lost: its blobs go, their artifacts need metadata again and lose blob, name and payload."""
    lost = blobs.where(F.col("segment_id") == segment_id).select(F.col("sha256").alias("blob_sha256")).distinct().withColumn("_lost", F.lit(True))
    j = artifacts.join(lost, "blob_sha256", "left")
    hit = F.coalesce("_lost", F.lit(False))
    after = j.withColumn("state", F.when(hit, int(State.NEED_METADATA)).otherwise(F.col("state")).cast("int"))
    for c in ("target_name", "blob_sha256"):
        after = after.withColumn(c, F.when(~hit, F.col(c)))
    hurt = j.where(hit).select(F.col("id").alias("artifact_id"))
    return {"artifacts": after.drop("_lost").select(*artifacts.columns), "blobs": blobs.where(F.col("segment_id") != segment_id), "payloads": payloads.join(hurt, "artifact_id", "left_anti")}


def retained(errors: DataFrame, now: Column, days: int) -> DataFrame:
    """The error rows that are not older than the retention."""
    return errors.where(F.col("created_at") >= F.timestamp_add("DAY", F.lit(-days), now))
