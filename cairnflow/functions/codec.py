"""Byte codecs as Arrow functions: zstd frames, JSON payloads, zlib bodies of an older corpus."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType

from cairnflow.model import ZSTD_LEVEL


@arrow_udf(BinaryType())
def _compress(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    import zstandard

    c = zstandard.ZstdCompressor(level=ZSTD_LEVEL)
    for part in parts:
        yield pa.array([None if x is None else c.compress(x) for x in part.to_pylist()], pa.binary())


@arrow_udf(BinaryType())
def _decompress(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    import zstandard

    d = zstandard.ZstdDecompressor()
    for part in parts:
        yield pa.array([None if x is None else d.decompressobj().decompress(x) for x in part.to_pylist()], pa.binary())


@arrow_udf(BinaryType())
def _inflate(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    import zlib

    def own(x: bytes | None) -> bytes | None:
        try:
            return None if x is None else zlib.decompress(x)
        except zlib.error:
            return None

    for part in parts:
        yield pa.array([own(x) for x in part.to_pylist()], pa.binary())


def zstd(body: Column) -> Column:
    return _compress(body)


def unzstd(frame: Column) -> Column:
    return _decompress(frame)


def inflated(body: Column) -> Column:
    """zlib; null where the body is broken."""
    return _inflate(body)


def json_frame(value: Column) -> Column:
    return zstd(F.to_json(value).cast("binary"))


def from_json_frame(frame: Column, schema: str) -> Column:
    return F.from_json(unzstd(frame).cast("string"), schema)
