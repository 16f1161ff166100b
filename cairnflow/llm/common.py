"""What the corpus operators share: the shared folder, written intermediate tables, bounded Arrow slices."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one Python step holds at a time; a single longer text is a slice of its own.
SLICE_BYTES = 4 << 20

_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as the session names it.

    Where spark.checkpoint.dir is unset a folder of this machine is made, if driver and executors are one process
    there (a local master: tests, a notebook); on a cluster the setting is asked for."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own_folder:
            _own_folder.append(f"file://{tempfile.mkdtemp(prefix='cairnflow-')}")
            atexit.register(_remove_own)
        found = _own_folder[0]
    return found.rstrip("/")


def _remove_own() -> None:
    import shutil

    shutil.rmtree(_own_folder[0].removeprefix("file://"), ignore_errors=True)


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/cairnflow/{label}-{uuid.uuid4().hex}"


#: Paths of the tables that ``written`` made and nobody has deleted, the oldest first.
_made: list[str] = []


def written(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: a later failure goes back to the files, not to the input."""
    spark = df.sparkSession
    path = new_path(spark, label)
    out = df.write
    if partition_by:
        out = out.partitionBy(*partition_by)
    out.parquet(path)
    _made.append(path)
    again = spark.read.schema(df.schema).parquet(path)
    again._cairnflow_path = path
    return again


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    if path in _made:
        _made.remove(path)


def forget(df: DataFrame) -> None:
    """Delete what ``written`` made, once nothing reads it any more."""
    path = getattr(df, "_cairnflow_path", None)
    if path:
        _delete(df.sparkSession, path)


@contextmanager
def only_results_stay(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Tables that were written inside are deleted at the end, but for those appended to the list that it gives.

    An operator's result reads its tables until it is written itself, so this goes around both."""
    before, kept = set(_made), []
    yield kept
    stays = {df._cairnflow_path for df in kept}
    for path in [x for x in _made if x not in before and x not in stays]:
        _delete(spark, path)


def free_name(docs: DataFrame, name: str) -> str:
    """The name, longer until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text of each row, under fixed names, so that further columns cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))


def remainder(name: str, modulus: int) -> Column:
    """crc32 of the id as text (no id: of the empty text) modulo ``modulus``; it deals labelled rows into folds."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about ``most`` text bytes; no row is cut or left out."""
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for at, size in enumerate(sizes.tolist()):
            if held and held + size > most:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += size
        yield batch.slice(start)
