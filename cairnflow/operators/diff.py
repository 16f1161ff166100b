"""Snapshot diffing and reconciliation: remote against local, as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnflow.functions.scalars import first_state
from cairnflow.model import State

#: What a refresh takes over from the remote side.
REFRESHED = ["url", "sha256", "size", "upload_time", "requires"]


def stale_projects(remote: DataFrame, local: DataFrame) -> DataFrame:
    """name, remote_serial, local_serial, status of remote(name, serial) that local lacks or has older (``stale``), and
    of those that went backwards (``regression``, to be warned about and ignored)."""
    both = remote.select("name", F.col("serial").alias("remote_serial")).join(local.select("name", F.col("serial").alias("local_serial")), "name", "left")
    status = F.when(F.col("local_serial").isNull() | (F.col("remote_serial") > F.col("local_serial")), "stale").when(F.col("remote_serial") < F.col("local_serial"), "regression")
    return both.withColumn("status", status).where(F.col("status").isNotNull())


def changed_columns(columns: list[str], old: str = "old", new: str = "new") -> Column:
    """Names of the columns whose values differ, nulls being values."""
    return F.filter(F.array(*[F.when(~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")), F.lit(c)) for c in columns]), lambda x: x.isNotNull())


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, change (new, vanished, changed, unchanged), changed column names, old and new structs: one full outer join."""
    a = old.select(F.col(key).alias("_key"), F.struct(*columns).alias("old"))
    b = new.select(F.col(key).alias("_key"), F.struct(*columns).alias("new"))
    both = a.join(b, "_key", "full_outer")
    names = F.when(F.col("old").isNotNull() & F.col("new").isNotNull(), changed_columns(columns)).otherwise(F.array().cast("array<string>"))
    change = F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), "vanished").when(F.size("changed") > 0, "changed").otherwise("unchanged")
    return both.withColumn("changed", names).select(F.col("_key").alias(key), change.alias("change"), "changed", "old", "new")


def reconcile(local: DataFrame, remote: DataFrame, unlinked: DataFrame) -> DataFrame:
    """filename, action, new_state, drop_payload, drop_skip, blob_sha256: what a project page does to each file.

    In this order: a live local file that is gone is tombstoned; a tombstone that is back is resurrected and starts
    over; a new file gets its first state, which uses up an unlinked blob; of a changed one, a digest that no longer
    fits the archived blob asks for metadata again and drops the payload, and metadata that appears does too.
    """
    l = local.select("filename", F.struct(*[c for c in local.columns if c != "filename"]).alias("l"))  # noqa: E741
    r = remote.select("filename", F.struct(*[c for c in remote.columns if c != "filename"]).alias("r"))
    u = unlinked.select("filename", F.col("sha256").alias("unlinked_sha"))
    j = l.join(r, "filename", "full_outer").join(u, "filename", "left")
    is_local, is_remote, dead = F.col("l").isNotNull(), F.col("r").isNotNull(), F.col("l.deleted_at").isNotNull()
    moved = is_local & is_remote & ~dead & F.col("l.blob_sha256").isNotNull() & F.col("r.metadata_sha256").isNotNull() & (F.col("l.blob_sha256") != F.col("r.metadata_sha256"))
    appeared = is_local & is_remote & ~dead & (F.col("l.state") == int(State.NO_METADATA)) & F.col("r.has_metadata")
    differs = F.lit(False)
    for c in [*REFRESHED, "metadata_sha256", "yanked", "yanked_reason"]:
        if c in remote.columns and c in local.columns:
            differs = differs | ~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    action = (
        F.when(~is_remote & dead, "none").when(~is_remote, "tombstone").when(~is_local, "insert").when(dead, "resurrect").when(moved | appeared | differs, "update").otherwise("none")
    )
    fresh = F.when(F.col("r.has_metadata"), int(State.NEED_METADATA)).otherwise(int(State.NO_METADATA))
    state = (
        F.when(F.col("action") == "tombstone", int(State.DELETED))
        .when(F.col("action") == "insert", first_state(F.col("r.has_metadata"), F.col("unlinked_sha")))
        .when(F.col("action") == "resurrect", fresh)
        .when(moved | appeared, int(State.NEED_METADATA))
        .otherwise(F.col("l.state"))
    )
    blob = F.when(F.col("action") == "insert", F.col("unlinked_sha")).when((F.col("action") == "resurrect") | moved, F.lit(None)).otherwise(F.col("l.blob_sha256"))
    return j.withColumn("action", action).select("filename", "action", state.cast("int").alias("new_state"), moved.alias("drop_payload"), appeared.alias("drop_skip"), blob.alias("blob_sha256"))


def with_sequence(df: DataFrame, order: list[str], start: int, column: str = "change_seq", partitions: int | None = None) -> DataFrame:
    """``column``: start + 1, start + 2, ... in the order given, without one task that holds all rows.

    The keys alone are range-partitioned once; of each partition stay its first key and the number of rows before it,
    one row of them in all, which goes to every row. A row's range follows from its key by binary search, so no second
    partitioning has to come out like the first: Spark samples the bounds of each anew and joins small partitions as it
    likes. ``df`` is read twice and must give the same rows; rows of equal keys are numbered in any order."""
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.select(*order).repartitionByRange(parts, *order).select(F.spark_partition_id().alias("_part"), F.struct(*order).alias("_key"))
    sizes = cut.groupBy("_part").agg(F.min("_key").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = sizes.select(F.struct("_first", before.alias("_before")).alias("_range")).agg(F.array_sort(F.collect_list("_range")).alias("_ranges"))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(parts.bit_length()))])
    # how many ranges begin at or before the key; beyond the last one get() is null
    begun = F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(F.col("_ranges"), n + step - 1)["_first"] <= F.struct(*order), n + step).otherwise(n))
    placed = df.crossJoin(F.broadcast(ranges)).withColumn("_before", F.get(F.col("_ranges"), begun - 1)["_before"]).drop("_ranges")
    local = F.row_number().over(Window.partitionBy("_before").orderBy(*order))
    return placed.withColumn(column, (F.lit(start) + F.col("_before") + local).cast("long")).drop("_before")


def cdc_since(df: DataFrame, cursor: int) -> DataFrame:
    return df.where(F.col("change_seq") > cursor)
