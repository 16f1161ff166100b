"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnflow.llm.common import forget, written


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()


def components(edges: DataFrame) -> DataFrame:
    """node, root: for each node of the edges (u, v) the smallest node that can be reached.

    Every round joins each edge with the least neighbour of its end and hooks the larger ends on it; edges stay
    distinct and their number never grows. Each round's edges are written to the shared folder, so a lost executor
    costs one round. Only a count and a checksum come to the driver. The number of rounds is logarithmic.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = _state(now)
    while seen[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
        large = both.join(least, "u").where("v > u and v <> w").select(F.col("v").alias("u"), F.col("w").alias("v"))
        large = written(large.distinct(), "edges")
        small_least = large.groupBy("u").agg(F.min("v").alias("w"))
        hooked = large.join(small_least, "u").select(F.explode(F.array(F.struct("u", F.col("w").alias("v")), F.struct(F.col("v").alias("u"), F.col("w").alias("v")))).alias("e"))
        after = written(hooked.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        forget(now)
        forget(large)
        was, seen = seen, _state(after)
        now = after
        if tuple(was) == tuple(seen):
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
