"""Structured Streaming forms: a snapshot per micro-batch, keyed breaker state, change capture."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cairnflow import model
from cairnflow.streaming.control import Breaker, folded


def micro_batches(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Hand each micro-batch to ``apply``; all there is now, or one batch at each interval."""
    out = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    return (out.trigger(processingTime=every) if every else out.trigger(availableNow=True)).start()


class Snapshots:
    """Versions of a table under a root; readers follow the newest version that is whole.

    A batch is merged by key into a new version, never over the one that is read; a batch that was applied already
    (the stream's retry) is left out."""

    def __init__(self, spark: SparkSession, root: str, key: list[str]):
        self.spark, self.root, self.key = spark, root, key

    def _paths(self) -> list[int]:
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted(int(n[1:]) for n in names if n.startswith("v") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.root}/{n}/_SUCCESS")))

    def latest(self) -> DataFrame | None:
        have = self._paths()
        return self.spark.read.parquet(f"{self.root}/v{have[-1]}") if have else None

    def apply(self, batch: DataFrame, batch_id: int, order: str) -> None:
        if batch_id in self._paths():
            return
        columns = [c for c in batch.columns if c not in self.key]
        last = batch.groupBy(*self.key).agg(F.max_by(F.struct(*columns), F.col(order)).alias("_s")).select(*self.key, *[F.col(f"_s.{c}").alias(c) for c in columns])
        old = self.latest()
        new = last if old is None else old.join(last.select(*self.key), self.key, "left_anti").unionByName(last)
        new.write.mode("overwrite").parquet(f"{self.root}/v{batch_id}")


BREAKER = "key long, state string, streak int, opened double"


def breaker_states(stream: DataFrame, key: str, ts: str, tie: str, failed: str) -> DataFrame:
    """key, state, streak, opened of every key after each batch: rows of a key arrive in any order inside a batch, so
    they are sorted before the fold."""

    def fold(k: tuple[Any], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts)).sort_values([ts, tie])
        b = folded(Breaker(*state.get) if state.exists else Breaker(), zip(rows[ts].map(lambda t: t.timestamp()), rows[failed], strict=True))
        state.update(tuple(b))
        yield pd.DataFrame({"key": [k[0]], "state": [b.name], "streak": [b.streak], "opened": pd.Series([b.opened], dtype="float64")})

    return stream.groupBy(key).applyInPandasWithState(fold, BREAKER, "streak int, opened double, trial boolean", "update", GroupStateTimeout.NoTimeout)


def breaker_batch(events: DataFrame, key: str, ts: str, tie: str, failed: str, failures: int = model.BREAKER_FAILURES, recovery: float = model.BREAKER_RECOVERY_S) -> DataFrame:
    """The same fold over a finished table."""

    def fold(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values([ts, tie])
        b = folded(Breaker(), zip(part[ts].map(lambda t: t.timestamp()), part[failed], strict=True), failures, recovery)
        return pd.DataFrame({"key": [part[key].iloc[0]], "state": [b.name], "streak": [b.streak], "opened": pd.Series([b.opened], dtype="float64")})

    return events.select(key, ts, tie, failed).groupBy(key).applyInPandas(fold, BREAKER)


def changes_since(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Change capture as a stream over the files that a writer appends."""
    return spark.readStream.schema(schema).parquet(path)
