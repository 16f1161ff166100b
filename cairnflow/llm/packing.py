"""Best-fit packing of tokenised documents by bin completion over the histogram of piece lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairnflow.llm.common import keyed_texts, slices, written
from cairnflow.llm.completion import pack_histogram

#: Pieces that share a rank bucket, and the least number of buckets.
BUCKET_ROWS, LEAST_BUCKETS = 1_000_000, 256


class Ids:
    """Token ids of a vocabulary file of the tokenizers library, no special tokens added.

    The file's merges are in the order of their results' ids, which makes its encoding that of a rank table; the
    faster rank encoder is used then. Any other file, any text that holds the content of an added token, which the
    library reads as that token, and any text that encoder refuses, goes to the library itself.
    """

    def __init__(self, path: str, pattern: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        vocab, merges = model["model"]["vocab"], model["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.added = added = {t["content"] for t in model.get("added_tokens", [])}
        plain = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
        unicode_of = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in set(plain))}
        byte_of = {c: b for b, c in unicode_of.items()}
        ranked = [vocab[a + b] for a, b in pairs]
        self.fast = None
        if (model.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and not model.get("normalizer") and ranked == sorted(ranked):
            ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in added}
            self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and not any(t in text for t in self.added):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
            except BaseException as e:  # the encoder's panics are no Exception
                if isinstance(e, (KeyboardInterrupt, SystemExit)):
                    raise
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


_ids: dict[tuple[str, str], Ids] = {}


def ids_of(path: str, pattern: str) -> Ids:
    if (path, pattern) not in _ids:
        _ids[path, pattern] = Ids(path, pattern)
    return _ids[path, pattern]


def cut(ids: np.ndarray, size: int) -> list[tuple[int, np.ndarray]]:
    """(start, ids) of the pieces: all of ``size`` tokens, but the first, which takes what is left over."""
    first = len(ids) % size or size
    bounds = [0, *range(min(first, len(ids)), len(ids) + 1, size)]
    return [(a, ids[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


def _pieces(path: str, pattern: str, size: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ids_of(path, pattern)
        for part in slices(batches):
            docs, piece, start, length, crc, held = [], [], [], [], [], []
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                for n, (at, ids) in enumerate(cut(np.append(encode(text), np.array([end_id], dtype="<u4")), size)):
                    docs.append(doc)
                    piece.append(n)
                    start.append(at)
                    length.append(len(ids))
                    crc.append(zlib.crc32(ids.tobytes()))
                    if with_ids:
                        held.append(ids.astype(np.int32))
            columns = {"doc_id": pa.array(docs, pa.int64()), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
            if with_ids:
                columns["ids"] = pa.array(held, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def slots(patterns: list[tuple[int, list[int]]]) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """size -> (first rank, items per bin, times, first bin, offset) intervals, in the order of ranks."""
    out: dict[int, list[tuple[int, int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    first = 0
    for times, sizes in patterns:
        offset = 0
        for size in sorted(set(sizes), reverse=True):
            n = sizes.count(size)
            out.setdefault(size, []).append((ranks.get(size, 0), n, times, first, offset))
            ranks[size] = ranks.get(size, 0) + n * times
            offset += n * size
        first += times
    return out


def _assign(table: dict[int, list[tuple[int, int, int, int, int]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = {size: np.array(x, dtype=np.int64).T for size, x in table.items()}
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_pk_rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for size in np.unique(length).tolist():
                at = np.flatnonzero(length == size)
                start, per, _, first, off = arrays[size]
                k = np.searchsorted(start, rank[at], side="right") - 1
                inside = rank[at] - start[k]
                sequence[at] = first[k] + inside // per[k]
                offset[at] = off[k] + (inside % per[k]) * size
            kept = [c for c in batch.schema.names if c != "_pk_rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, path: str, pattern: str, size: int = 1024, end_id: int = 2, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A document is its ids and ``end_id`` (null text: ``end_id`` alone); only a longer one than ``size`` is cut, its
    first piece taking the remainder. The histogram of piece lengths, at most ``size`` numbers, is all that comes to the
    driver; the patterns found there are dealt to the pieces by their rank among those of equal length. Ranks are
    counted inside buckets of bounded size and shifted by the counts of the buckets before, so a length that a third of
    all pieces share is no single group. Pieces are written to the shared folder once. Rows that repeat an id, or have
    none, are documents each. No documents give no rows. Other columns than the id and the text are not read.
    """
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    pieces = written(keyed_texts(docs, id_col, text_col).mapInArrow(_pieces(path, pattern, size, end_id, with_ids), kind), "pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = np.zeros(size + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    table = slots(pack_histogram(counts, size))
    buckets = max(LEAST_BUCKETS, int(counts.sum()) // BUCKET_ROWS)
    dealt = pieces.withColumn("_pk_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    before = dealt.groupBy("length", "_pk_bucket").agg(F.count(F.lit(1)).alias("_pk_n"))
    before = before.withColumn("_pk_before", F.sum("_pk_n").over(Window.partitionBy("length").orderBy("_pk_bucket").rowsBetween(Window.unboundedPreceding, -1))).select(
        F.col("length").alias("_pk_length"), F.col("_pk_bucket").alias("_pk_of"), F.coalesce("_pk_before", F.lit(0)).alias("_pk_before")
    )
    local = F.row_number().over(Window.partitionBy("_pk_bucket", "length").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = dealt.withColumn("_pk_local", local).join(before, (F.col("length") == F.col("_pk_length")) & (F.col("_pk_bucket") == F.col("_pk_of")))
    columns = pieces.columns
    return ranked.select(*columns, (F.col("_pk_before") + F.col("_pk_local")).cast("long").alias("_pk_rank")).mapInArrow(_assign(table), kind + ", sequence_id long, offset long")
