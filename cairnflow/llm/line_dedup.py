"""Corpus-wide line deduplication over levelled sorted runs of line hashes, in DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnflow.llm.common import forget, free_name, keyed_texts, text_or_empty, written

#: The characters stripped from both ends of a line: space and \t \n \v \f \r.
BLANKS = " \t\n\x0b\x0c\r"
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def key_hash(key: Column) -> Column:
    """128 bits of a key: two 64-bit hashes whose seeds differ."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"))


class LineRuns:
    """Levelled sorted runs of (h1, h2, n): in how many documents a line key was seen.

    A batch is aggregated, merge-anti-joined with the keys that the runs have already settled (n reached
    ``min_docs`` in one entry), and added as a sorted run of level 0. When a level has ``fanout`` runs they are
    compacted into one run of the next level, which adds up their counts. Every run is a table in the shared folder.
    """

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[DataFrame]] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _union(self, runs: list[DataFrame]) -> DataFrame:
        out = runs[0]
        for run in runs[1:]:
            out = out.unionByName(run)
        return out

    def _put(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(written(run.sortWithinPartitions(*HASH), f"line-run-{level}"))
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            self._put(self._union(old).groupBy(*HASH).agg(F.sum("n").alias("n")), level + 1)
            for run in old:
                forget(run)

    def add(self, keys: DataFrame) -> None:
        """keys: h1, h2, one row for each document and key of the batch."""
        batch = keys.groupBy(*HASH).agg(F.count(F.lit(1)).alias("n"))
        if self.runs():
            settled = self._union(self.runs()).where(F.col("n") >= self.min_docs).select(*HASH)
            batch = batch.join(settled.hint("merge"), HASH, "left_anti")
        self._put(batch, 0)

    def frequent(self) -> DataFrame:
        """h1, h2 of the keys of at least ``min_docs`` documents over all batches."""
        runs = self.runs()
        counts = runs[0] if len(runs) == 1 else self._union(runs).groupBy(*HASH).agg(F.sum("n").alias("n"))
        return counts.where(F.col("n") >= self.min_docs).select(*HASH)


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1, batches: int = 4, fanout: int = 2, counts: bool = False
) -> DataFrame:
    """All columns of ``docs``, the text without its frequent lines; with ``counts`` also n_lines and n_dropped (a column
    of ``docs`` that has such a name already gives way).

    A text is split at \\n; null or empty is one empty line (and comes out as '').
    A key of at least ``min_chars`` code points that is found in at least ``min_docs`` rows loses all its lines
    everywhere; the other lines stay in order, joined by \\n. Each input row is a document of its own, also where an
    id repeats or is null. ``batches`` deals the rows by a hash of id and text into the batches that LineRuns takes.

    The lines of a row are sorted by their hashes, so that the first of equal keys is known without a shuffle, and
    only firsts are counted. A frequent line comes back to its row as a place in the text: rows are told apart by id
    and a 128-bit hash of the text (rows that share both lose the same places), and the places that stay are the
    difference of two sets of numbers, so a row costs its number of lines, however many of them are dropped. The join
    of a line that a third of all documents hold is split by adaptive execution; no step gathers a key's rows.
    """
    spark = docs.sparkSession
    row = [F.col(id_col).cast("long").alias("id"), F.xxhash64(text_or_empty(text_col)).alias("t1"), F.xxhash64(F.lit("text"), text_or_empty(text_col)).alias("t2")]
    hashed = F.transform(F.split(text_or_empty(text_col), "\n"), lambda x, n: F.struct(key_hash(line_key(x)).alias("h"), n.alias("place"), (F.char_length(line_key(x)) >= min_chars).alias("counts")))
    sorted_lines = docs.select(*row, F.array_sort(F.filter(hashed, lambda x: x["counts"])).alias("lines"))
    marked = F.transform("lines", lambda x, n: F.struct(x["h"]["h1"].alias("h1"), x["h"]["h2"].alias("h2"), x["place"].alias("place"), ((n == 0) | (F.get(F.col("lines"), n - 1)["h"] != x["h"])).alias("first")))
    exploded = sorted_lines.select("id", "t1", "t2", F.explode(marked).alias("x")).select("id", "t1", "t2", "x.*", F.pmod(F.xxhash64("id", "t1"), F.lit(batches)).cast("int").alias("batch"))
    lines = written(exploded, "line-keys", ["batch"])
    runs = LineRuns(spark, min_docs, fanout)
    for batch in range(batches):
        runs.add(lines.where((F.col("batch") == batch) & F.col("first")).select(*HASH))
    hits = lines.select("id", "t1", "t2", "place", *HASH).join(runs.frequent(), HASH).groupBy("id", "t1", "t2").agg(F.collect_set("place").alias("places"))
    names = {x: free_name(docs, f"_{x}") for x in ("id", "t1", "t2", "places", "lines", "kept")}
    hits = hits.select(*[F.col(c).alias(names[c]) for c in hits.columns])
    same = row[0].eqNullSafe(F.col(names["id"])) & (row[1] == F.col(names["t1"])) & (row[2] == F.col(names["t2"]))
    joined = docs.join(hits, same, "left").withColumn(names["lines"], F.split(text_or_empty(text_col), "\n"))
    own, places = F.col(names["lines"]), F.col(names["places"])
    # numbers have a hash set: the difference takes the time of both sides, and keeps the order of the first
    stay = F.when(places.isNotNull(), F.array_except(F.sequence(F.lit(0), F.size(own) - 1), places))
    joined = joined.withColumn(names["kept"], stay)
    kept = F.col(names["kept"])
    text = F.when(kept.isNull(), F.array_join(own, "\n")).otherwise(F.array_join(F.transform(kept, lambda n: F.get(own, n)), "\n"))
    columns = [text.alias(text_col) if c == text_col else F.col(c) for c in docs.columns if not (counts and c in ("n_lines", "n_dropped"))]
    if counts:
        columns += [F.size(own).cast("long").alias("n_lines"), F.coalesce(F.size(own) - F.size(kept), F.lit(0)).cast("long").alias("n_dropped")]
    return joined.select(*columns)


def line_dedup_digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of each row, from ``line_dedup``."""
    return line_dedup(keyed_texts(docs), counts=True, **options).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
