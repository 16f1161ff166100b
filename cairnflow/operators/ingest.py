"""What a sync batch writes beside the plan of a project: projects that are gone, names that clash, routes, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnflow.model import MAX_ATTEMPTS, State
from cairnflow.operators.diff import with_sequence


def project_rows(artifacts: DataFrame, projects: DataFrame) -> DataFrame:
    """The artifacts of projects(project)."""
    return artifacts.join(projects.select("project").distinct(), "project", "left_semi")


def without_projects(artifacts: DataFrame, gone: DataFrame, now: Column) -> DataFrame:
    """The artifacts, those of gone(project) that live as tombstones of now."""
    g = gone.select(F.col("project").alias("_gone")).distinct()
    j = artifacts.join(g, F.col("project") == F.col("_gone"), "left")
    dies = F.col("_gone").isNotNull() & (F.col("state") != int(State.DELETED))
    new = {"state": F.lit(int(State.DELETED)), "deleted_at": now, "updated_at": now}
    return j.select(*[F.when(dies, new[c].cast(t)).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c, t in artifacts.dtypes])


def index_without(index: DataFrame, gone: DataFrame) -> DataFrame:
    """The index(name, ...) without the rows of gone(project)."""
    return index.join(gone.select(F.col("project").alias("name")), "name", "left_anti")


def duplicate_filenames(files: DataFrame, artifacts: DataFrame) -> DataFrame:
    """filename, project, owner: files(filename, project) whose name an artifact of another project has; they are not
    written, an error row each says so."""
    owned = artifacts.select("filename", F.col("project").alias("owner"))
    return files.select("filename", "project").join(owned, "filename").where("project <> owner")


def routed(outcomes: DataFrame, kind: str, attempts: str) -> DataFrame:
    """``outcomes`` with action: a rate limit slows the limiter down and writes nothing, a retry writes nothing until its
    attempts are used up, which an error row records; what is gone or fetched is applied."""
    action = (
        F.when(F.col(kind) == "rate_limited", "penalise")
        .when((F.col(kind) == "retry") & (F.col(attempts) > MAX_ATTEMPTS), "quarantine_error")
        .when(F.col(kind) == "retry", "none")
        .when(F.col(kind) == "gone", "tombstone")
        .otherwise("apply")
    )
    return outcomes.withColumn("action", action)


def batch_summary(written: DataFrame, action: str, project: str) -> DataFrame:
    """action, n, projects: what a batch has done, aggregated before anything moves."""
    return written.groupBy(F.col(action).alias("action")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(project).alias("projects"))


def last_sequence(artifacts: DataFrame) -> int:
    """The greatest change_seq, 0 where there is none: what the next writer starts behind."""
    return artifacts.agg(F.coalesce(F.max("change_seq"), F.lit(0))).first()[0]


def sequenced_behind(touched: DataFrame, order: list[str], artifacts: DataFrame) -> DataFrame:
    """``touched`` with the next values of change_seq behind those of ``artifacts``."""
    return with_sequence(touched, order, last_sequence(artifacts))


def change_window(rows: DataFrame, first: int, last: int) -> DataFrame:
    """Rows whose change_seq is from ``first`` to ``last``, both included; the bounds reach the scan."""
    return rows.where(F.col("change_seq").between(first, last))
