"""Content-addressed archive: packing blobs into compressed blocks and segments, random access, verification.

A segment file is blocks, then a JSON footer compressed with zstd, then a trailer of 32 bytes: magic, footer offset,
footer length, crc32 of the footer, 4 bytes of nothing, all little-endian. The footer lists each block's place and raw
length and each record's digest, block and place in the raw block.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnflow.functions.scalars import segment_number
from cairnflow.model import BLOCK_BYTES, SEAL_AGE_S, SEAL_BYTES, ZSTD_LEVEL

MAGIC = b"CAIRNSG1"
TRAILER = struct.Struct("<8sQQI4s")


def block_layout(sizes: list[int], limit: int) -> list[tuple[int, int]]:
    """(block, offset) of records in order: a block closes when the next record would overflow it; a record larger than
    the limit has a block of its own."""
    out, block, used = [], 0, 0
    for n in sizes:
        if used and used + n > limit:
            block, used = block + 1, 0
        out.append((block, used))
        used += n
    return out


def packed(rows: DataFrame, group: str, order: str, size: str, limit: int = BLOCK_BYTES) -> DataFrame:
    """group, order, size, block_no, offset. The running sum starts again with each block, which no window frame can
    say; the fold sees three numbers of each record, never its bytes."""

    def fold(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(order, kind="stable")
        layout = block_layout(part[size].tolist(), limit)
        return part.assign(block_no=pd.Series([b for b, _ in layout], index=part.index, dtype="int64"), offset=pd.Series([o for _, o in layout], index=part.index, dtype="int64"))

    kinds = dict(rows.dtypes)
    return rows.select(group, order, size).groupBy(group).applyInPandas(fold, f"{group} {kinds[group]}, {order} {kinds[order]}, {size} {kinds[size]}, block_no long, offset long")


class SegmentBuilder:
    """One segment in memory: records are deduplicated by digest, blocks are compressed as they fill."""

    def __init__(self, block_bytes: int = BLOCK_BYTES, level: int = ZSTD_LEVEL):
        import zstandard

        self.compressor = zstandard.ZstdCompressor(level=level)
        self.block_bytes = block_bytes
        self.body, self.raw = bytearray(), bytearray()
        self.blocks: list[tuple[int, int, int]] = []
        self.records: dict[str, tuple[int, int, int]] = {}

    def add(self, data: bytes) -> str:
        import hashlib

        sha = hashlib.sha256(data).hexdigest()
        if sha not in self.records:
            if self.raw and len(self.raw) + len(data) > self.block_bytes:
                self._close()
            self.records[sha] = (len(self.blocks), len(self.raw), len(data))
            self.raw += data
        return sha

    def _close(self) -> None:
        if self.raw:
            frame = self.compressor.compress(bytes(self.raw))
            self.blocks.append((len(self.body), len(frame), len(self.raw)))
            self.body += frame
            self.raw = bytearray()

    def seal(self) -> bytes:
        self._close()
        footer = self.compressor.compress(json.dumps({"version": 1, "blocks": self.blocks, "records": [[s, *p] for s, p in self.records.items()]}).encode())
        return bytes(self.body) + footer + TRAILER.pack(MAGIC, len(self.body), len(footer), zlib.crc32(footer), b"\0\0\0\0")


class CorruptSegment(ValueError):
    pass


def read_footer(data: bytes) -> dict:
    import zstandard

    if len(data) < TRAILER.size:
        raise CorruptSegment("no trailer")
    magic, offset, length, crc, _ = TRAILER.unpack(data[-TRAILER.size :])
    footer = data[offset : offset + length]
    if magic != MAGIC or offset + length + TRAILER.size != len(data) or zlib.crc32(footer) != crc:
        raise CorruptSegment("bad trailer or footer")
    return json.loads(zstandard.ZstdDecompressor().decompress(footer, max_output_size=1 << 30))


def iter_records(data: bytes) -> Iterator[tuple[str, int, int, int, bytes]]:
    """(sha256, block, offset, length, bytes); each block is decompressed once."""
    import zstandard

    footer = read_footer(data)
    own: dict[int, list] = {}
    for sha, block, offset, length in footer["records"]:
        own.setdefault(block, []).append((sha, offset, length))
    for n, (offset, length, raw) in enumerate(footer["blocks"]):
        block = zstandard.ZstdDecompressor().decompress(data[offset : offset + length], max_output_size=raw)
        for sha, at, size in own.get(n, ()):
            yield sha, n, at, size, block[at : at + size]


def build_segments(blobs: DataFrame, body: str, order: list[str], segments: int, block_bytes: int = BLOCK_BYTES, seal_bytes: int = SEAL_BYTES, first_id: int = 1) -> DataFrame:
    """segment_id, data, records, bytes: the distinct bodies, in ranges of the order (neighbours compress together), a
    new segment file whenever one is full. A segment is bounded, so is what a task holds. Ids start at ``first_id`` (see
    ``next_segment_id``); range k of n takes k, k + n, k + 2 n and so on, so that none is taken twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, count, builder = TaskContext.get().partitionId(), 0, SegmentBuilder(block_bytes)

        def sealed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"segment_id": pa.array([first_id + part + count * segments], pa.int64()), "data": pa.array([builder.seal()], pa.binary()), "records": pa.array([len(builder.records)], pa.int64())})

        for batch in batches:
            for data in batch.column(0).to_pylist():
                builder.add(data or b"")
                if len(builder.body) >= seal_bytes:
                    yield sealed()
                    count, builder = count + 1, SegmentBuilder(block_bytes)
        if builder.records:
            yield sealed()

    once = blobs.withColumn("_sha", F.sha2(F.col(body), 256)).groupBy("_sha").agg(F.min(F.struct(*order)).alias("_o"), F.first(F.col(body)).alias("_b"))
    dealt = once.repartitionByRange(segments, "_o").sortWithinPartitions("_o").select(F.col("_b").cast("binary").alias("b"))
    return dealt.mapInArrow(run, "segment_id long, data binary, records long").withColumn("bytes", F.length("data").cast("long"))


def footer_records(segments: DataFrame) -> DataFrame:
    """segment_id, sha256, block_no, offset, length from the footers: rebuilds the blob index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    rows = read_footer(data)["records"]
                except CorruptSegment:
                    continue
                if rows:
                    sha, block, offset, length = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_pydict({"segment_id": pa.array([sid] * len(rows), pa.int64()), "sha256": pa.array(sha), "block_no": pa.array(block, pa.int64()), "offset": pa.array(offset, pa.int64()), "length": pa.array(length, pa.int64())})

    return segments.select("segment_id", "data").mapInArrow(run, "segment_id long, sha256 string, block_no long, offset long, length long")


def read_records(segments: DataFrame) -> DataFrame:
    """segment_id, sha256, body of every record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    for sha, _, _, _, body in iter_records(data):
                        yield pa.RecordBatch.from_pydict({"segment_id": pa.array([sid], pa.int64()), "sha256": pa.array([sha]), "body": pa.array([body], pa.binary())})
                except Exception:  # a broken segment is verify's business
                    continue

    return segments.select("segment_id", "data").mapInArrow(run, "segment_id long, sha256 string, body binary")


def segment_blocks(segments: DataFrame) -> DataFrame:
    """segment_id, block_no, frame, raw_length: the compressed blocks, a row each, so that a reader takes those it needs.
    Blocks of files whose footer cannot be read are left out; ``verify`` reports them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    blocks = read_footer(data)["blocks"]
                except CorruptSegment:
                    continue
                for n, (offset, length, raw) in enumerate(blocks):
                    yield pa.RecordBatch.from_pydict({"segment_id": pa.array([sid], pa.int64()), "block_no": pa.array([n], pa.int64()), "frame": pa.array([data[offset : offset + length]], pa.binary()), "raw_length": pa.array([raw], pa.int64())})

    return segments.where("data is not null").select("segment_id", "data").mapInArrow(run, "segment_id long, block_no long, frame binary, raw_length long")


def read_by_block(blocks: DataFrame, index: DataFrame, wanted: DataFrame) -> DataFrame:
    """sha256, body of the wanted(sha256) that the index has: the places are grouped by block, and only blocks that hold
    one are moved and decompressed, once each, however many of their records are asked for. A block is bounded, so is
    its list of places. A block that cannot be decompressed gives its records with a null body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for batch in batches:
            for frame, raw, places in zip(*(batch.column(c).to_pylist() for c in ("frame", "raw_length", "places")), strict=True):
                try:
                    block = zstandard.ZstdDecompressor().decompress(frame, max_output_size=raw)
                    bodies = [block[p["offset"] : p["offset"] + p["length"]] for p in places]
                except zstandard.ZstdError:
                    bodies = [None] * len(places)
                yield pa.RecordBatch.from_pydict({"sha256": pa.array([p["sha256"] for p in places]), "body": pa.array(bodies, pa.binary())})

    places = index.join(wanted.select("sha256").distinct(), "sha256", "left_semi").dropDuplicates(["sha256"])
    asked = places.groupBy("segment_id", "block_no").agg(F.collect_list(F.struct("sha256", "offset", "length")).alias("places"))
    return blocks.join(asked, ["segment_id", "block_no"]).select("frame", "raw_length", "places").mapInArrow(run, "sha256 string, body binary")


def _outcome(indexed) -> Column:
    return F.when(~indexed, "archive_blob_missing").when(F.col("body").isNull() | (F.sha2("body", 256) != F.col("sha256")), "corrupt_blob").otherwise("ok")


def read_blobs(segments: DataFrame, wanted: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """sha256, body, outcome (ok, corrupt_blob, archive_blob_missing) of wanted(sha256), by the index (None: the footers')."""
    index = footer_records(segments) if index is None else index
    found = read_by_block(segment_blocks(segments), index, wanted).withColumn("indexed", F.lit(True))
    return wanted.select("sha256").distinct().join(found, "sha256", "left").select("sha256", "body", _outcome(F.coalesce("indexed", F.lit(False))).alias("outcome"))


def claimed_bodies(blocks: DataFrame, index: DataFrame, claimed: DataFrame) -> DataFrame:
    """Every row of claimed(id, sha256, ...) with body and outcome, for conversion in bulk: ids that share a blob share
    its read. A blob that the archive lacks is to be retried, a corrupt one to be skipped."""
    found = read_by_block(blocks, index, claimed).withColumn("indexed", F.lit(True))
    return claimed.join(found, "sha256", "left").withColumn("outcome", _outcome(F.coalesce("indexed", F.lit(False)))).drop("indexed")


def next_segment_id(segments: DataFrame, names: DataFrame) -> int:
    """One more than the greatest id of the segments table and of the file names: no run takes an id twice."""
    known = segments.agg(F.max("id")).first()[0]
    files = names.agg(F.max(segment_number(F.col("name")))).first()[0]
    return 1 + max(known or 0, files or 0)


def due_for_seal(open_files: DataFrame, now: Column, seal_bytes: int = SEAL_BYTES, seal_age_s: float = SEAL_AGE_S) -> DataFrame:
    """open_files(id, bytes, opened_at, ...) that are full or old enough; empty ones never are."""
    age = (F.unix_micros(now) - F.unix_micros(F.col("opened_at"))) / 1e6
    return open_files.where((F.col("bytes") > 0) & ((F.col("bytes") >= seal_bytes) | (age >= seal_age_s)))


def sealed(segments: DataFrame, done: DataFrame, now: Column) -> DataFrame:
    """The segments table with done(id, bytes, records) sealed now; ids it does not have are new rows."""
    d = done.select("id", F.col("bytes").alias("_bytes"), F.col("records").alias("_records"), F.lit(True).alias("_done"))
    j = segments.join(d, "id", "full_outer")
    new = lambda c, x: F.when(F.col("_done"), x).otherwise(F.col(c)).alias(c)
    return j.select("id", new("sealed_at", now), new("bytes", F.col("_bytes")), new("records", F.col("_records")))


def stale_open(open_files: DataFrame, segments: DataFrame) -> DataFrame:
    """Open files of segments that are not sealed: what a crash left behind, to be truncated before anything is added."""
    return open_files.join(segments.where("sealed_at is not null").select("id"), "id", "left_anti")


def verify(segments: DataFrame, index: DataFrame) -> DataFrame:
    """segment_id, sha256, problem: unreadable files, records whose bytes have another digest, and footer and index
    that disagree; a missing or broken file is a problem, not an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            for sid, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                bad: list[tuple[str, str]] = []
                try:
                    if data is None:
                        raise CorruptSegment("missing")
                    bad += [(sha, "corrupt") for sha, _, _, _, body in iter_records(data) if hashlib.sha256(body).hexdigest() != sha]
                except Exception:
                    bad.append(("", "unreadable"))
                if bad:
                    yield pa.RecordBatch.from_pydict({"segment_id": pa.array([sid] * len(bad), pa.int64()), "sha256": pa.array([s for s, _ in bad]), "problem": pa.array([p for _, p in bad])})

    bodies = segments.select("segment_id", "data").mapInArrow(run, "segment_id long, sha256 string, problem string")
    place = F.struct("block_no", "offset", "length")
    f = footer_records(segments.where("data is not null")).select("segment_id", "sha256", place.alias("f"))
    x = index.select("segment_id", "sha256", place.alias("x"))
    problem = F.when(F.col("x").isNull(), "extra").when(F.col("f").isNull(), "missing").when(~F.col("f").eqNullSafe(F.col("x")), "mismatched")
    diff = f.join(x, ["segment_id", "sha256"], "full_outer").select("segment_id", "sha256", problem.alias("problem")).where("problem is not null")
    return bodies.unionByName(diff)


def write_segments(segments: DataFrame, root: str) -> None:
    """The files as a binary table; Spark's committer renames them when the job is whole."""
    segments.write.mode("errorifexists").parquet(root)


def open_segments(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root)
