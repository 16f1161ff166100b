"""Shard publishing: what is dirty, what a shard holds, what may be left out, and when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dirty_packages(changes: DataFrame) -> DataFrame:
    """name, last_seq of changes(old_name, new_name, change_seq): a remap dirties both names."""
    names = changes.select(F.explode(F.array_distinct(F.array("old_name", "new_name"))).alias("name"), "change_seq").where("name is not null")
    return names.groupBy("name").agg(F.max("change_seq").alias("last_seq"))


def shards(records: DataFrame) -> DataFrame:
    """subdir, name, n_records, hash: the records (subdir, name, item) of a shard in order, hashed; a package's records
    are few, so the list of one shard is."""
    return records.groupBy("subdir", "name").agg(F.array_sort(F.collect_list("item")).alias("items")).select("subdir", "name", F.size("items").cast("long").alias("n_records"), F.sha2(F.array_join("items", "\n"), 256).alias("hash"))


def changed_shards(built: DataFrame, index: DataFrame) -> DataFrame:
    """The built shards whose hash the index does not have."""
    return built.join(index.select("subdir", "name", F.col("hash").alias("_old")), ["subdir", "name"], "left").where(~F.col("hash").eqNullSafe(F.col("_old"))).drop("_old")


def cleared(dirty: DataFrame, read_up_to: int) -> DataFrame:
    """What stays dirty after a build that read changes up to a sequence number."""
    return dirty.where(F.col("last_seq") > read_up_to)


def publishable(dirty: DataFrame, pending_projects: DataFrame, now: Column, most_wait_s: float = 3600.0) -> DataFrame:
    """Dirty packages whose project has nothing pending, or that have waited long enough."""
    held = pending_projects.select("project").distinct().withColumn("_held", F.lit(True))
    waited = (F.unix_micros(now) - F.unix_micros("dirty_since")) / 1e6 >= most_wait_s
    return dirty.join(held, "project", "left").where(F.col("_held").isNull() | waited).drop("_held")


def should_publish(dirty: DataFrame, now: Column, count: int = 2000, age_s: float = 300.0) -> DataFrame:
    """dirty_count, oldest_s, publish in one row."""
    row = dirty.agg(F.count(F.lit(1)).alias("dirty_count"), ((F.unix_micros(now) - F.unix_micros(F.min("dirty_since"))) / 1e6).alias("oldest_s"))
    return row.withColumn("publish", (F.col("dirty_count") >= count) | F.coalesce(F.col("oldest_s") >= age_s, F.lit(False)))


def collectable_objects(objects: DataFrame, index: DataFrame, watermark: int, now: Column, grace_s: float) -> DataFrame:
    """Objects that no shard names, last named before the watermark and older than the grace."""
    old = (F.col("last_referenced_seq") < watermark) & ((F.unix_micros(now) - F.unix_micros("created_at")) / 1e6 > grace_s)
    return objects.where(old).join(index.select("hash"), "hash", "left_anti")


def subdir_index(built: DataFrame) -> DataFrame:
    """subdir, shard map name -> hash, in the order of names."""
    return built.groupBy("subdir").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "hash")))).alias("shards"))
