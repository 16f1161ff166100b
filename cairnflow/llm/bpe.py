"""Byte-level BPE encoding and decoding by recursive DuckDB queries inside each partition."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cairnflow.llm.common import keyed_texts, slices

#: Text bytes of one step: large enough that a recursion's rounds are spread over many words.
STEP_BYTES = 4 << 20
#: Words kept per generation of a worker's cache; two generations at most are held.
CACHED = 300_000
#: Rows that one recursive query may add up before its last state is taken as a new start.
ROWS = 3_000_000
#: Bytes from which a word is contracted at every occurrence of its best pair in one round.
LONG = 256

# One round: each live word's leftmost pair of least rank becomes one token; a word without a pair is handed on once
# more as finished. A pair's rank, its position and that of its right token are one number, whose minimum is the pair.
ENCODE = """
WITH RECURSIVE bpe(live, w, pos, tok) AS (
  SELECT TRUE, w, pos, tok FROM start
  UNION ALL
  SELECT c.least IS NOT NULL, s.w, s.pos, CASE WHEN s.pos = ((c.least >> 8) & 255) THEN (c.least >> 16)::INTEGER ELSE s.tok END
  FROM bpe s LEFT JOIN (
    SELECT w, min((m::BIGINT << 16) + (pos << 8) + npos) AS least
    FROM (SELECT w, pos, tok, lead(tok) OVER o AS nxt, lead(pos) OVER o AS npos FROM bpe WHERE live WINDOW o AS (PARTITION BY w ORDER BY pos)) p
    JOIN merges g ON g.l = p.tok AND g.r = p.nxt GROUP BY w) c ON s.w = c.w
  WHERE s.live AND (c.least IS NULL OR s.pos <> (c.least & 255)))
SELECT w, list(tok ORDER BY pos) AS toks FROM bpe WHERE NOT live GROUP BY w ORDER BY w
"""

# The same for long words: every occurrence of the least rank is contracted, from the left where occurrences overlap,
# if its token takes part in merges of higher rank alone; then no lesser pair can come between two occurrences. Where it
# can ("alone"), only the leftmost one is contracted. The fixpoint is that of one contraction at a time.
ENCODE_LONG = """
WITH RECURSIVE bpe(round, w, pos, tok) AS (
  SELECT 0, w, pos, tok FROM start
  UNION ALL
  SELECT s.round + 1, s.w, s.pos, coalesce(c.best, s.tok) FROM bpe s
  JOIN (SELECT DISTINCT w FROM (SELECT w, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS nxt FROM bpe) p JOIN merges g ON g.l = p.tok AND g.r = p.nxt) live ON live.w = s.w
  LEFT JOIN (
    SELECT w, pos, npos, best FROM (
      SELECT *, row_number() OVER (PARTITION BY w, idx - nth ORDER BY idx) % 2 AS odd FROM (
        SELECT *, row_number() OVER (PARTITION BY w ORDER BY idx) AS nth FROM (
          SELECT p.w, p.pos, p.npos, p.idx, g.m, g.alone, min(g.m) OVER (PARTITION BY p.w) AS best, p.tok = p.nxt AS twin
          FROM (SELECT w, pos, tok, lead(tok) OVER o AS nxt, lead(pos) OVER o AS npos, row_number() OVER o AS idx FROM bpe WINDOW o AS (PARTITION BY w ORDER BY pos)) p
          JOIN merges g ON g.l = p.tok AND g.r = p.nxt) WHERE m = best))
    WHERE (odd = 1 OR NOT twin) AND (NOT alone OR nth = 1)) c ON c.w = s.w AND c.pos = s.pos
  WHERE s.round < {rounds} AND NOT EXISTS (SELECT 1 FROM (
    SELECT w, npos FROM (
      SELECT *, row_number() OVER (PARTITION BY w, idx - nth ORDER BY idx) % 2 AS odd FROM (
        SELECT *, row_number() OVER (PARTITION BY w ORDER BY idx) AS nth FROM (
          SELECT p.w, p.npos, p.idx, g.m, g.alone, min(g.m) OVER (PARTITION BY p.w) AS best, p.tok = p.nxt AS twin
          FROM (SELECT w, pos, tok, lead(tok) OVER o AS nxt, lead(pos) OVER o AS npos, row_number() OVER o AS idx FROM bpe WINDOW o AS (PARTITION BY w ORDER BY pos)) p
          JOIN merges g ON g.l = p.tok AND g.r = p.nxt) WHERE m = best))
    WHERE (odd = 1 OR NOT twin) AND (NOT alone OR nth = 1)) d WHERE d.w = s.w AND d.npos = s.pos))
SELECT w, pos, tok, round FROM (SELECT *, max(round) OVER (PARTITION BY w) AS last FROM bpe) WHERE round = last ORDER BY w, pos
"""

DECODE = "SELECT w, from_hex(string_agg(hex, '' ORDER BY pos)) AS text FROM ids JOIN vocab USING (id) GROUP BY w ORDER BY w"


class Codec:
    """One worker's DuckDB connection with the merge table and the vocabulary, and a cache of words."""

    def __init__(self, ranks_path: str, pattern: str):
        import duckdb
        import regex

        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.split = regex.compile(pattern).findall
        self.byte_id = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        triples = [(self.ranks[t[:k]], self.ranks[t[k:]], i) for t, i in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        # tokens that can take part in a merge of lower rank than their own: making one can bring forth a lesser pair
        early = {x for a, b, m in triples for x in (a, b) if x > m}
        triples = [(a, b, m, m in early) for a, b, m in triples]
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        self.con.register("merges_in", pa.table(dict(zip(("l", "r", "m", "alone"), (pa.array(x, kind) for x, kind in zip(zip(*triples, strict=True), [pa.int32()] * 3 + [pa.bool_()], strict=True)), strict=True))))
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merges_in")
        self.con.register("vocab_in", pa.table({"id": pa.array(list(self.ranks.values()), pa.int32()), "hex": [t.hex() for t in self.ranks]}))
        self.con.execute("CREATE TABLE vocab AS SELECT * FROM vocab_in")
        self.con.unregister("merges_in")
        self.con.unregister("vocab_in")
        self.new: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}
        self.old: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}

    def _start(self, words: list[bytes]) -> pa.Table:
        sizes = np.array([len(w) for w in words])
        text = np.frombuffer(b"".join(words), dtype=np.uint8)
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        return pa.table({"w": np.repeat(np.arange(len(words), dtype=np.int32), sizes), "pos": (np.arange(len(text)) - first).astype(np.int32), "tok": self.byte_id[text]})

    def _short(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids laid end to end, number of ids of each word)."""
        self.con.register("start", self._start(words))
        toks = self.con.sql(ENCODE).to_arrow_table().column("toks").combine_chunks()
        return toks.flatten().to_numpy(), np.diff(toks.offsets.to_numpy())

    def _long(self, word: bytes) -> tuple[np.ndarray, np.ndarray]:
        state = self._start([word])
        while True:
            rounds = max(1, ROWS // len(state))
            self.con.register("start", state)
            state = self.con.sql(ENCODE_LONG.format(rounds=rounds)).to_arrow_table()
            if state.column("round")[0].as_py() < rounds:
                return state.column("tok").to_numpy(), np.array([len(state)])
            state = state.select(["w", "pos", "tok"])

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids laid end to end, number of ids of each word): its own id if a word is a token, else the fixpoint."""
        whole = [self.ranks.get(w, -1) for w in words]
        groups: list[list[int]] = [[]]
        held = 0
        for k, w in enumerate(words):
            if whole[k] < 0 and w:
                if len(w) >= LONG:
                    groups.append([k])
                else:
                    groups[0].append(k)
        parts, order = [], []
        short, step = groups[0], []
        for n, k in enumerate(short):
            step.append(k)
            held += len(words[k]) ** 2 // 2
            if held > ROWS or n == len(short) - 1:
                parts.append(self._short([words[i] for i in step]))
                order += step
                step, held = [], 0
        for (k,) in groups[1:]:
            parts.append(self._long(words[k]))
            order.append(k)
        own = [k for k, i in enumerate(whole) if i >= 0]
        parts.append((np.array([whole[k] for k in own], dtype=np.int64), np.ones(len(own), dtype=np.int64)))
        order += own
        flat, counts = np.concatenate([f for f, _ in parts]), np.concatenate([c for _, c in parts])
        sizes = np.zeros(len(words), dtype=np.int64)
        sizes[order] = counts
        # from the order of the groups to that of the words
        first = np.zeros(len(words), dtype=np.int64)
        first[order] = np.cumsum(counts) - counts
        at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        return flat[at].astype(np.int32), sizes

    def decode(self, flat: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The bytes of each list of ids: its tokens joined in the order of their positions. An unknown id is an error."""
        if len(flat) and not (0 <= flat.min() and flat.max() < len(self.ranks)):
            raise ValueError("an id is not in the vocabulary")
        self.con.register("ids", pa.table({"w": np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), "pos": np.arange(len(flat), dtype=np.int32 if len(flat) < 1 << 31 else np.int64), "id": flat.astype(np.int32)}))
        found = self.con.sql(DECODE).to_arrow_table()
        texts = found.column("text").to_pylist()
        if len(texts) == len(sizes):
            return texts
        out = [b""] * len(sizes)
        for w, text in zip(found.column("w").to_pylist(), texts, strict=True):
            out[w] = text
        return out

    def learn(self, words: set[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """(a word's ids as little-endian unsigned 32-bit integers, the bytes its ids decode to) by word."""
        if len(self.new[0]) > CACHED:
            self.new, self.old = ({}, {}), self.new
        ids, texts = self.new
        todo = []
        for w in words.difference(ids):
            if w in self.old[0]:
                ids[w], texts[w] = self.old[0][w], self.old[1][w]
            else:
                todo.append(w)
        if todo:
            flat, sizes = self.encode_words([w.encode("utf-8") for w in todo])
            raw, ends = flat.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
            ids.update(zip(todo, [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))
            texts.update(zip(todo, self.decode(flat, sizes), strict=True))
        return self.new


_codecs: dict[tuple[str, str], Codec] = {}


def codec(ranks_path: str, pattern: str) -> Codec:
    key = ranks_path, pattern
    if key not in _codecs:
        _codecs[key] = Codec(ranks_path, pattern)
    return _codecs[key]


def _round_trip(ranks_path: str, pattern: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for part in slices(batches, most=STEP_BYTES):
            texts = [c.split(x) for x in part.column("text").to_pylist()]
            known_ids, known_texts = c.learn(set().union(*texts))
            counts, shas, decoded, ids = [], [], [], []
            for words in texts:
                raw = b"".join(map(known_ids.__getitem__, words))
                counts.append(len(raw) // 4)
                shas.append(hashlib.sha256(raw).hexdigest())
                text = b"".join(map(known_texts.__getitem__, words))
                decoded.append(text if with_ids else hashlib.sha256(text).hexdigest())
                if with_ids:
                    ids.append(np.frombuffer(raw, dtype="<u4").astype(np.int32))
            columns = [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(shas, pa.string())]
            if with_ids:
                columns += [pa.array(ids, pa.list_(pa.int32())), pa.array([x.decode("utf-8") for x in decoded], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "ids", "decoded"]
            else:
                columns += [pa.array(decoded, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def bpe_encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, ids, decoded of every row.

    Each match of ``pattern`` is encoded by itself. In every step of a partition the distinct words not yet known to
    the worker become token-position rows of a DuckDB table; a recursive query joins them with the merge table and
    contracts each word's leftmost pair of least rank until no word has one. The ids are decoded by an ordered
    aggregation over the vocabulary, a list for each distinct word, and joined in the order of the words. No shuffle;
    memory is bound by the step, the cache and the longest text. Null texts count as empty and have no ids; rows that
    repeat, or have no id, are rows each; other columns are not read. Words of LONG bytes and more contract every
    occurrence of their least pair in a round where that leads to the same fixpoint.
    """
    return keyed_texts(docs, id_col, text_col).mapInArrow(_round_trip(ranks_path, pattern, True), "doc_id long, n_tokens long, ids_sha256 string, ids array<int>, decoded string")


def bpe_digest(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the digests that ``bpe_encode``'s columns have, without those columns."""
    return keyed_texts(docs).mapInArrow(_round_trip(ranks_path, pattern, False), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _decode(ranks_path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lists = [x or [] for x in part.column("ids").to_pylist()]
                texts = c.decode(np.array([i for x in lists for i in x], dtype=np.int64), np.array([len(x) for x in lists], dtype=np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.binary())], names=["doc_id", "decoded"])

    return run


def bpe_decode(ids: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, decoded (bytes) from doc_id, ids of any source; null ids count as none, an unknown id is an error."""
    return ids.select("doc_id", "ids").mapInArrow(_decode(ranks_path, pattern), "doc_id long, decoded binary")
