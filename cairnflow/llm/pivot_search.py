"""Exact top-k inner-product search by pivot-table elimination."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnflow.llm.common import written

#: Bytes of a lot of candidates (vectors and distances); a query block has a quarter of its rows.
LOT_BYTES, LEAST_ROWS = 16 << 20, 256
#: Rows from which the pivots are chosen; every row is then indexed against them.
PIVOT_SAMPLE = 2000
#: Candidates of a query that are evaluated at once, in the order of their bounds.
STEP = 128


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, x (components as doubles) of the rows that have an id and a vector of finite components."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(F.coalesce(finite, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows of the sample, each the furthest from those chosen before; the first is the furthest from the mean."""
    far = np.linalg.norm(sample - sample.mean(0), axis=1)
    chosen = [int(far.argmax())]
    near = np.linalg.norm(sample - sample[chosen[0]], axis=1)
    while len(chosen) < min(count, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(1)[:, None] + (p * p).sum(1)[None] - 2 * x @ p.T
    return np.sqrt(np.maximum(d2, 0))


def _table(pivots: dict[int, np.ndarray]):
    """The pivot table: each row's distances to the pivots of its dimension, and the nearest one's number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("v").to_pylist()
            out: list[list[float]] = [[] for _ in vectors]
            near = np.zeros(len(vectors), dtype=np.int32)
            for dim, p in pivots.items():
                at = [k for k, v in enumerate(vectors) if len(v) == dim]
                if at:
                    d = _distances(np.array([vectors[k] for k in at], dtype=np.float64).reshape(len(at), dim), p)
                    near[at] = d.argmin(1)
                    for k, row in zip(at, d.tolist(), strict=True):
                        out[k] = row
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(out, pa.list_(pa.float64())), pa.array(near)], names=["vec_id", "v", "d", "near"])

    return run


def _scaled(scale: float):
    """vec_id, v: floor(scale * x) of each component, whole numbers held as doubles; rows beyond doubles leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x")
            flat = np.floor(x.flatten().to_numpy(zero_copy_only=False) * scale) + 0.0
            ends = x.offsets.to_numpy()
            out = pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.ListArray.from_arrays(pa.array(ends - ends[0]), pa.array(flat))], names=["vec_id", "v"])
            if not np.isfinite(flat).all():
                out = out.filter(pa.array([bool(np.isfinite(v).all()) for v in out.column("v").to_pylist()]))
            yield out

    return run


def _products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products; in doubles where these hold every partial sum, in Python's integers elsewhere."""
    if float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * len(q) < 2**53:
        return (x @ q).astype(np.int64)
    whole = [int(c) for c in q.tolist()]
    return np.array([sum(int(c) * w for c, w in zip(row, whole, strict=True)) for row in x.tolist()], dtype=object)


def _order(ids: np.ndarray, scores: np.ndarray) -> list[int]:
    """Places by falling score, ties by rising id."""
    if scores.dtype == object:
        return sorted(range(len(ids)), key=lambda n: (-scores[n], ids[n]))
    return np.lexsort((ids, -scores)).tolist()


def best_of_block(q_ids: np.ndarray, q: np.ndarray, q_d: np.ndarray, ids: np.ndarray, x: np.ndarray, x_d: np.ndarray, k: int, floor: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(place of the query, vec_id, score) of each query's k best rows of the block, ties to the smaller vec_id.

    |d(q, p) - d(x, p)| bounds d(q, x) from below for every pivot p; the greatest of these bounds the score from
    above, since 2 q.x = |q|^2 + |x|^2 - d(q, x)^2. Candidates are evaluated in the order of that bound, and a query
    stops once its k-th score, or the one it has from elsewhere (``floor``), is above the next bound (the slack covers
    the rounding of the distances).
    """
    out = []
    norms = (x * x).sum(1)
    slack = 1e-6 * (1 + norms.max(initial=0))
    for n in range(len(q_ids)):
        low = np.zeros(len(ids))
        for p in range(x_d.shape[1]):
            np.maximum(low, np.abs(x_d[:, p] - q_d[n, p]), out=low)
        own = float((q[n] * q[n]).sum())
        upper = (own + norms - low * low) / 2 + slack + 1e-6 * own
        upper[ids == q_ids[n]] = -np.inf
        order = np.argsort(-upper, kind="stable")
        best_ids, best = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        least = -np.inf if floor is None else floor[n]
        for start in range(0, len(order), STEP):
            take = order[start : start + STEP]
            if upper[take[0]] < least or (len(best) >= k and best[-1] > upper[take[0]]):
                break
            take = take[upper[take] > -np.inf]
            best_ids, best = np.concatenate([best_ids, ids[take]]), np.concatenate([best, _products(x[take], q[n])])
            top = _order(best_ids, best)[:k]
            best_ids, best = best_ids[top], best[top]
        out += zip([n] * len(best), best_ids.tolist(), best.tolist(), strict=True)
    return out


FOUND = "query_id long, k1 long, k2 long, vec_id long, score long, down string"


def _down(score: int) -> str:
    """A text that sorts as the falling whole number does, whatever its size."""
    digits = str(abs(score))
    if score <= 0:
        return f"1{len(digits):05d}{digits}"
    return f"0{99999 - len(digits):05d}{''.join(str(9 - int(c)) for c in digits)}"


def _rows(found: list[tuple[int, int, int]], asked: pd.DataFrame) -> pd.DataFrame:
    at = [n for n, _, _ in found]
    scores = [s for _, _, s in found]
    out = pd.DataFrame({"query_id": asked.vec_id.to_numpy()[at], "k1": asked.k1.to_numpy()[at], "k2": asked.k2.to_numpy()[at], "vec_id": [i for _, i, _ in found], "score": [max(-(2**63), min(2**63 - 1, s)) for s in scores]}).astype("int64")
    return out.assign(down=pd.Series([_down(int(s)) for s in scores], dtype=object))


def _search(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return _rows([], queries)
        parts = [np.stack(c.to_numpy()) for c in (queries.v, queries.d, rows.c_v, rows.c_d)]
        floor = queries.floor.to_numpy(dtype=np.float64) if "floor" in queries else None
        return _rows(best_of_block(queries.vec_id.to_numpy(), parts[0], parts[1], rows.c_id.to_numpy(), parts[2], parts[3], k, floor), queries)

    return run


def _survivors(queries: pd.DataFrame, lots: pd.DataFrame) -> pd.DataFrame:
    """The lots that a query has to visit: all but its first whose bound, taken from the interval of their distances to
    each pivot, reaches the query's k-th score there."""
    out: list[tuple[int, int, int, int]] = []
    if len(queries) and len(lots):
        near, far = np.stack(lots.lo.to_numpy()), np.stack(lots.hi.to_numpy())
        norm, lot = lots.norm.to_numpy(), lots.lot.to_numpy()
        ids, k1, k2, seen, floors = (queries[c].to_numpy() for c in ("vec_id", "k1", "k2", "seen", "floor"))
        for n, (v, d) in enumerate(zip(queries.v, queries.d, strict=True)):
            low = np.maximum(np.maximum(near - d, d - far), 0).max(1, initial=0)
            own = float(np.dot(v, v))
            upper = (own + norm - low * low) / 2 + 1e-6 * (1 + norm + own)
            out += [(int(ids[n]), int(k1[n]), int(k2[n]), int(x)) for x in lot[(upper >= floors[n]) & (lot != seen[n])]]
    return pd.DataFrame(out, columns=["vec_id", "k1", "k2", "lot"]).astype("int64")


def pivot_top_k(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5, scale: float = 256.0, pivots: int = 24, lot_bytes: int = LOT_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k rows of greatest inner product, ties to the smaller vec_id.

    Queries are the rows whose id is divisible by ``every``; all other rows are candidates. A row takes part if its id
    and vector are there and every component is finite, also scaled; rows of other dimension than the query's are no
    candidates of it (an empty vector's are the other empty ones, with score 0). A query is never its own candidate:
    rows that repeat its id are left out, and rows that repeat a candidate's id are candidates each. Queries that
    repeat id and vector are one; rows that share an id but not the vector are queries each, with ranks of their own.
    Components are floor(scale * x). Ranks go by exact whole numbers; a score beyond 64 bits is given as the nearest
    number these hold.

    The pivots of each dimension come from a sample bounded by PIVOT_SAMPLE; all rows are in the pivot table, which is
    written to the shared folder and cut into lots by the nearest pivot. Of each lot the interval of its distances to
    every pivot is kept. A query first searches the lot of its own pivot; its k-th score there rules out all lots whose
    interval bounds them below it, and only the others see the query. Inside a lot candidates go by their own bounds.
    Lots and query blocks are bounded in bytes, copies are spread over them.
    """
    spark = rows.sparkSession
    vectors = usable(rows, id_col, vector_col).mapInArrow(_scaled(scale), "vec_id long, v array<double>")
    vectors = written(vectors.withColumn("dim", F.size("v")), "vectors")
    sizes = {r.dim: r.n for r in vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = {}
    for dim in sizes:
        some = vectors.where(F.col("dim") == dim).orderBy(F.xxhash64("vec_id", "v"), "vec_id").select("v").limit(PIVOT_SAMPLE).collect()
        chosen[dim] = choose_pivots(np.array([r.v for r in some], dtype=np.float64).reshape(len(some), dim), pivots)
    if not chosen:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    most = {dim: max(LEAST_ROWS, lot_bytes // (8 * (dim + len(chosen[dim])))) for dim in sizes}
    # the row numbers are fixed with the table, so that copies are spread and a task that runs again deals them alike
    table = vectors.select("vec_id", "v").mapInArrow(_table(chosen), "vec_id long, v array<double>, d array<double>, near int")
    table = written(table.withColumn("dim", F.size("v")).withColumn("row", F.monotonically_increasing_id()), "pivot-table")
    cells = {(r.dim, r.near): -(-r.n // most[r.dim]) for r in table.groupBy("dim", "near").agg(F.count(F.lit(1)).alias("n")).collect()}
    lots_of = F.create_map(*[F.lit(x) for (dim, near), n in cells.items() for x in (f"{dim},{near}", n)])[F.concat_ws(",", "dim", "near")]
    lot = F.col("near") * F.lit(1 << 32) + F.pmod(F.xxhash64("row"), lots_of)
    offered = table.select(F.col("vec_id").alias("c_id"), F.col("v").alias("c_v"), F.col("d").alias("c_d"), F.col("dim").alias("c_dim"), lot.alias("c_lot"))
    key = [F.xxhash64("v").alias("k1"), F.xxhash64(F.lit("query"), "v").alias("k2")]
    asked = table.where(F.pmod("vec_id", F.lit(every)) == 0).select("vec_id", "v", "d", "near", "dim", *key).dropDuplicates(["vec_id", "v"])
    blocks = {dim: max(1, 4 * -(-n // every) // most[dim]) for dim, n in sizes.items()}
    block = F.pmod(F.xxhash64("vec_id", "k1"), F.create_map(*[F.lit(x) for d, n in blocks.items() for x in (d, n)])[F.col("dim")])
    asked = written(asked.withColumn("qb", block).withColumn("seen", F.col("near") * F.lit(1 << 32) + F.pmod(F.xxhash64("vec_id"), lots_of)), "queries")

    def visit(queries: DataFrame) -> DataFrame:
        """The best of each query in each lot it is sent to; a lot goes to the query blocks that have a query for it."""
        met = queries.select(F.col("dim").alias("c_dim"), F.col("qb").alias("c_qb"), F.col("lot").alias("c_lot")).distinct()
        sent = offered.join(met, ["c_dim", "c_lot"])
        return queries.groupBy("dim", "qb", "lot").cogroup(sent.groupBy("c_dim", "c_qb", "c_lot")).applyInPandas(_search(k), FOUND)

    first = written(visit(asked.withColumn("lot", F.col("seen"))), "first-visits")
    reached = first.groupBy("query_id", "k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
    reached = reached.where(F.col("least") > -(2**63)).select(F.col("query_id").alias("vec_id"), "k1", "k2", F.col("least").cast("double").alias("floor"))
    bounded = written(asked.join(reached, ["vec_id", "k1", "k2"], "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))), "bounded-queries")
    spans = [F.array(*[f(F.get("c_d", n)) for n in range(max(map(len, chosen.values())))]) for f in (F.min, F.max)]
    square = F.aggregate("c_v", F.lit(0.0), lambda a, x: a + x * x)
    lots = offered.groupBy("c_dim", "c_lot").agg(*[F.filter(x, lambda c: c.isNotNull()).alias(n) for x, n in zip(spans, ("lo", "hi"), strict=True)], F.max(square).alias("norm")).withColumnRenamed("c_lot", "lot")
    lots = lots.withColumn("c_qb", F.explode(F.sequence(F.lit(0), F.lit(max(blocks.values()) - 1))))
    visits = bounded.select("dim", "qb", "vec_id", "k1", "k2", "v", "d", "seen", "floor").groupBy("dim", "qb").cogroup(lots.groupBy("c_dim", "c_qb")).applyInPandas(_survivors, "vec_id long, k1 long, k2 long, lot long")
    second = visit(bounded.join(visits, ["vec_id", "k1", "k2"]).select("vec_id", "v", "d", "dim", "qb", "k1", "k2", "floor", "lot"))
    found = first.unionByName(second)
    # in two steps, so that no list grows with the number of lots
    ordered = found.select("query_id", "k1", "k2", F.struct("down", "vec_id", "score").alias("x"), F.pmod(F.xxhash64("vec_id"), F.lit(max(1, int(sum(cells.values()) ** 0.5)))).alias("part"))
    asks = ["query_id", "k1", "k2"]
    firsts = ordered.groupBy(*asks, "part").agg(F.slice(F.array_sort(F.collect_list("x")), 1, k).alias("top"))
    best = firsts.groupBy(*asks).agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top"))
    return best.select("query_id", F.posexplode("top").alias("at", "x")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
