"""SimHash near-duplicates by the generalised pigeonhole principle over correlated bit groups; where links are verified,
bands of seeded minima add the candidates that a fingerprint of 64 bits does not see."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairnflow.llm.common import free_name, keyed_texts, slices, text_or_empty, written
from cairnflow.llm.components import components

BITS = 64
#: Words that are hashed at a time, so that a text of any length is bounded in memory.
WORDS_AT_ONCE = 1 << 16
#: What a probe costs and what a candidate costs, as units of the plan's estimate.
PROBE_COST, CANDIDATE_COST = 1.0, 0.2


#: Shingles whose sets a task keeps while it verifies pairs.
HELD = 1_000_000

#: Bands of seeded minima, and the minima in one: of pairs of Jaccard similarity j, 1 - (1 - j**6)**24 share a band.
BANDS, ROWS = 24, 6


def hashes(words: list[bytes], size: int) -> Iterator[np.ndarray]:
    """The hashes of the shingles, a bounded number at a time."""
    import xxhash

    hashed, total = xxhash.xxh64_intdigest, max(len(words) - size + 1, 1)
    for start in range(0, total, WORDS_AT_ONCE):
        part = words[start : start + WORDS_AT_ONCE + size - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(size)), strict=False)) if len(words) >= size else [b" ".join(words)]
        yield np.fromiter(map(hashed, shingles, repeat(42)), dtype=np.uint64)


def bit_counts(words: list[bytes], size: int) -> tuple[np.ndarray, int]:
    """In how many of the shingles' hashes each bit is set, and the number of shingles."""
    counts, total = np.zeros(BITS, dtype=np.int64), 0
    for h in hashes(words, size):
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(h)
    return counts, total


def fingerprint(text: str, size: int = 3) -> int:
    """The signed 64-bit SimHash of the text's word shingles; bytes.lower and bytes.split act on ASCII alone."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    counts, total = bit_counts(words, size)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.int64)[0])


_seeds = np.random.default_rng(42).integers(0, 1 << 32, (2, BANDS * ROWS, 1), dtype=np.uint32) | np.array([[[1]], [[0]]], dtype=np.uint32)
#: Shingles whose permutations are taken at a time, so that they stay in the cache.
SHINGLES_AT_ONCE = 1 << 11


def bands(text: str, size: int) -> np.ndarray:
    """One signed 64-bit number a band: a hash of the least values its seeded permutations give the shingles' hashes."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, dtype=np.uint32)
    for h in hashes(text.encode("utf-8", "surrogatepass").lower().split(), size):
        low = h.astype(np.uint32)
        for start in range(0, len(low), SHINGLES_AT_ONCE):
            np.minimum(least, ((low[start : start + SHINGLES_AT_ONCE] ^ _seeds[1]) * _seeds[0]).min(1), out=least)
    out = np.zeros(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        out = (out ^ row) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _banded(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            values = pa.array(np.concatenate([bands(x, size) for x in texts]))
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS), values)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), pa.array([fingerprint(x, size) for x in texts], pa.int64()), values], names=["doc_id", "text_key", "fp", "bands"])

    return run


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            fps = [fingerprint(x, size) for x in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), pa.array(fps, pa.int64())], names=["doc_id", "text_key", "fp"])

    return run


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (a hash of the text), fp of every row; no words: fp 0."""
    keyed = keyed_texts(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    return keyed.mapInArrow(_fingerprints(size), "doc_id long, text_key long, fp long")


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many fingerprints bits i and j are both set, for one task."""
    total = np.zeros((BITS, BITS), dtype=np.int64)
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        for start in range(0, len(fps), 1 << 14):
            bits = np.unpackbits(fps[start : start + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += np.rint(bits.T @ bits).astype(np.int64)
    i, j = np.divmod(np.arange(BITS * BITS), BITS)
    yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total.ravel())], names=["i", "j", "n"])


def bit_statistics(fps: DataFrame) -> np.ndarray:
    """The 64 x 64 co-occurrence counts over all distinct fingerprints; 4096 numbers come to the driver."""
    rows = fps.select("fp").mapInArrow(_pair_counts, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((BITS, BITS))
    for r in rows:
        out[r.i, r.j] = r.n
    return out


def correlated_groups(both: np.ndarray, total: int, parts: int) -> list[list[int]]:
    """The 64 bits in ``parts`` groups of nearly equal width, each grown by the bit most correlated with it."""
    p = np.diag(both) / max(total, 1)
    cov = both / max(total, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = set(range(BITS)), []
    for k in range(parts):
        width = len(left) // (parts - k)
        order = sorted(left)
        grown = [max(order, key=lambda b: (corr[b, order].sum(), -b))]
        left.discard(grown[0])
        while len(grown) < width:
            nxt = max(sorted(left), key=lambda b: (corr[b, grown].sum(), -b))
            grown.append(nxt)
            left.discard(nxt)
        groups.append(sorted(grown))
    return groups


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 whose sum is ``budget`` and whose summed costs are least.

    costs[i][t + 1] is the cost of part i at threshold t. Dynamic programming over parts and spent budget."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for k, c in enumerate(row):
                at = (cost + c, [*chosen, k - 1])
                if (s := spent + k - 1) not in step or at[0] < step[s][0]:
                    step[s] = at
        best = step
    return best[budget]


def _within(q: np.ndarray, most: int) -> np.ndarray:
    """Chance that at most 0..most of independent bits differ, bit b differing with chance q[b]."""
    dist = np.zeros(len(q) + 1)
    dist[0] = 1
    for x in q:
        dist[1:] = dist[1:] * (1 - x) + dist[:-1] * x
        dist[0] *= 1 - x
    return np.cumsum(dist)[: most + 1]


def part_value(group: list[int]):
    """The bits of a group as one integer column of fp."""
    out = F.lit(0).cast("long")
    for at, bit in enumerate(group):
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(F.col("fp"), bit).bitwiseAND(F.lit(1).cast("long")), at))
    return out


def flipped(value, masks: list[int]):
    """The value with each mask's bits flipped, as an array."""
    return F.transform(F.array(*[F.lit(x).cast("long") for x in masks]), lambda x: x.bitwiseXOR(value))


def plan_partitions(fps: DataFrame, total: int, distance: int) -> list[tuple[list[int], int]]:
    """(bit group, threshold) of each part to probe.

    For every number of parts m up to distance + 1, the thresholds must sum to distance - m + 1: were each part of a
    pair further apart than its threshold, the pair would be further apart than ``distance``. Candidates at threshold
    0 are counted from all distinct fingerprints; at higher thresholds that count is scaled by the independent-bits
    model. m and the thresholds of least estimated cost win, whatever the size of the input.
    """
    both = bit_statistics(fps)
    p = np.diag(both) / max(total, 1)
    plans = {m: correlated_groups(both, total, m) for m in range(1, distance + 2)}
    values = [F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"), part_value(g).alias("value")) for m, gs in plans.items() if m > 1 for i, g in enumerate(gs)]
    counted = fps.select(F.explode(F.array(*values)).alias("x")).groupBy("x.m", "x.i", "x.value").agg(F.count(F.lit(1)).alias("n"))
    pairs = {(r.m, r.i): float(r.pairs) for r in counted.groupBy("m", "i").agg(F.sum(F.expr("cast(n as double) * (n - 1) / 2")).alias("pairs")).collect()}
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for m, groups in plans.items():
        if m == 1:
            continue
        budget, costs = distance - m + 1, []
        for i, group in enumerate(groups):
            model = _within(2 * p[group] * (1 - p[group]), max(budget + m - 1, 0))
            measured = pairs.get((m, i), 0.0)
            row = [0.0]
            for t in range(0, budget + m):
                probes = max(total, 1) * sum(len(list(combinations(range(len(group)), k))) for k in range(t + 1))
                row.append(PROBE_COST * probes + CANDIDATE_COST * measured * model[min(t, len(model) - 1)] / max(model[0], 1e-300))
            costs.append(row)
        cost, thresholds = allocate(costs, budget)
        if best is None or cost < best[0]:
            best = cost, [(g, t) for g, t in zip(groups, thresholds, strict=True) if t >= 0]
    return best[1]


def near_pairs(fps: DataFrame, total: int, distance: int = 3) -> DataFrame:
    """u, v: all pairs of distinct fingerprints at ``distance`` or fewer differing bits.

    The smaller fingerprint is indexed by each part's value, the larger probes every value within that part's
    threshold, and a pair leaves the join only if its whole distance holds, and only from the first part that finds
    it. Exact, with no cap on a bucket.
    """
    if distance < 1:
        raise ValueError("equal fingerprints need no search")
    parts = plan_partitions(fps, total, distance)
    index = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("part"), part_value(g).alias("value")) for i, (g, _) in enumerate(parts)])).alias("k")).select(F.col("fp").alias("u"), "k.part", "k.value")
    probes = []
    for i, (group, t) in enumerate(parts):
        masks = [sum(1 << b for b in flips) for k in range(t + 1) for flips in combinations(range(len(group)), k)]
        probes.append(fps.select(F.col("fp").alias("v"), F.lit(i).alias("part"), F.explode(flipped(part_value(group), masks)).alias("value")))
    probe = probes[0]
    for more in probes[1:]:
        probe = probe.unionByName(more)
    differ = F.col("u").bitwiseXOR(F.col("v"))
    first = F.lit(True)
    for i, (group, t) in enumerate(parts[:-1]):
        mask = sum(1 << b for b in group)
        first &= (index.part <= i) | (F.bit_count(differ.bitwiseAND(F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask).cast("long"))) > t)
    near = (index.part == probe.part) & (index.value == probe.value) & (F.col("u") < F.col("v")) & (F.bit_count(differ) <= distance) & first
    return index.join(probe, near).select("u", "v")


def _alike(size: int, least: float):
    def shingles(text: str) -> set[bytes]:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        return set(map(b" ".join, zip(*(words[k:] for k in range(size)), strict=False))) if len(words) >= size else {b" ".join(words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the sets of texts that many pairs share, as many as HELD shingles
        known: dict[int, set[bytes]] = {}
        held = 0
        for batch in batches:
            for part in slices(slices([batch], "a"), "b"):
                kept = []
                for u, v, a, b in zip(*(part.column(c).to_pylist() for c in ("u", "v", "a", "b")), strict=True):
                    if held > HELD:
                        known, held = {}, 0
                    for key, text in ((u, a), (v, b)):
                        if key not in known:
                            known[key] = shingles(text)
                            held += len(known[key])
                    own, other = known[u], known[v]
                    both = len(own & other)
                    kept.append(both >= least * (len(own) + len(other) - both))
                yield part.select(["u", "v"]).filter(pa.array(kept, pa.bool_()))

    return run


def alike_pairs(pairs: DataFrame, docs: DataFrame, size: int, least: float, id_col: str, text_col: str) -> DataFrame:
    """The pairs (u, v) of text_keys whose texts' shingle sets have a Jaccard similarity of at least ``least``; the texts
    without a pair move no further than one join."""
    ends = pairs.select("u").union(pairs.select("v")).distinct().withColumnRenamed("u", "own_key")
    texts = keyed_texts(docs, id_col, text_col).withColumn("own_key", F.xxhash64("text"))
    held = written(texts.join(ends, "own_key").select("own_key", "text").dropDuplicates(["own_key"]), "near-texts")
    both = pairs.join(held.select(F.col("own_key").alias("u"), F.col("text").alias("a")), "u").join(held.select(F.col("own_key").alias("v"), F.col("text").alias("b")), "v")
    return both.select("u", "v", "a", "b").mapInArrow(_alike(size, least), "u long, v long").distinct()


def _distinct_hashes(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = [np.unique(np.concatenate(list(hashes(x.encode("utf-8", "surrogatepass").lower().split(), size)))).view(np.int64) for x in part.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([part.column("own_key"), pa.array(np.diff(ends)), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))], names=["text_key", "n", "grams"])

    return run


def prefix_pairs(open_texts: DataFrame, docs: DataFrame, size: int, least: float, id_col: str, text_col: str) -> DataFrame:
    """u, v: pairs of ``open_texts`` (text_key, root) of different roots, among them all of a similarity of ``least``.

    Of n shingles such a pair shares at least ``least * n``, so the two share one of each one's ``n - ceil(least * n) + 1``
    rarest. Rare ones come first: a passage that thousands of texts hold makes no pairs unless it fills them, and a
    shingle of one text takes its place in the order but is never joined.
    """
    texts = keyed_texts(docs, id_col, text_col).withColumn("own_key", F.xxhash64("text"))
    texts = texts.join(open_texts.select(F.col("text_key").alias("own_key")), "own_key").select("own_key", "text").dropDuplicates(["own_key"])
    sets = written(texts.mapInArrow(_distinct_hashes(size), "text_key long, n int, grams array<long>"), "shingle-sets")
    grams = sets.select("text_key", "n", F.explode("grams").alias("gram"))
    # written, so that both sides of the next join have an exchange of their own and a hot shingle can be split
    common = written(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("held_by")).where("held_by > 1"), "common-shingles")
    place = Window.partitionBy("text_key").orderBy("held_by", "gram")
    alone = F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("text_key"))
    ranked = grams.join(common, "gram").withColumn("place", F.row_number().over(place) + alone)
    prefix = ranked.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1)
    prefix = written(prefix.join(open_texts, "text_key").select("gram", "text_key", "n", "place", "root"), "prefixes")
    one, two = prefix.alias("one"), prefix.alias("two")
    fits = F.least("one.n", "two.n") >= F.greatest("one.n", "two.n") * least - 1e-9
    # from the rarest shingle that two texts share on they hold no more in common than the shorter rest
    fits &= 1 + F.least(F.col("one.n") - F.col("one.place"), F.col("two.n") - F.col("two.place")) >= (F.col("one.n") + F.col("two.n")) * (least / (1 + least)) - 1e-9
    near = (F.col("one.gram") == F.col("two.gram")) & (F.col("one.text_key") < F.col("two.text_key")) & (F.col("one.root") != F.col("two.root")) & fits
    return one.join(two, near).select(F.col("one.text_key").alias("u"), F.col("two.text_key").alias("v")).distinct()


def _ordered(u, v) -> list:
    return [F.least(u, v).alias("u"), F.greatest(u, v).alias("v")]


def alike_components(texts: DataFrame, shared: DataFrame, near: DataFrame, docs: DataFrame, size: int, least: float, id_col: str, text_col: str) -> DataFrame:
    """node, root: the text_keys that verified links connect, and the smallest that each reaches.

    ``texts`` has text_key, fp; ``shared`` bucket, value, text_key: all texts of a bucket are candidates of each other;
    ``near`` u, v: all texts of two fingerprints are. First each text meets the smallest of its bucket alone. Then the
    texts with a candidate that is still apart meet again by their rarest shingles, and every pair that can be alike is
    verified. So what is left out could not join anything, and a large group of copies costs a row each and not its square.
    """
    firsts = written(shared.groupBy("bucket", "value").agg(F.min("text_key").alias("first"), F.max("text_key").alias("last")).where("first < last").drop("last"), "firsts")
    heads = texts.groupBy("fp").agg(F.min("text_key").alias("first"))
    star = shared.join(firsts, ["bucket", "value"]).where("text_key <> first").select(F.col("first").alias("u"), F.col("text_key").alias("v"))
    across = near.join(heads.select(F.col("fp").alias("u"), F.col("first").alias("a")), "u").join(heads.select(F.col("fp").alias("v"), F.col("first").alias("b")), "v").select(*_ordered("a", "b"))
    tried = written(star.union(across).distinct(), "near-pairs")
    links = written(alike_pairs(tried, docs, size, least, id_col, text_col), "links")
    reached = components(links).select(F.col("node").alias("text_key"), "root")
    texts = written(texts.join(reached, "text_key", "left").withColumn("root", F.coalesce("root", "text_key")), "text-roots")
    members = shared.join(firsts, ["bucket", "value"]).select("bucket", "value", "text_key").join(texts.select("text_key", "root"), "text_key")
    members = written(members, "members")
    split = members.groupBy("bucket", "value").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("bucket", "value")
    apart = members.join(split, ["bucket", "value"]).select("text_key")
    ends = [texts.select(F.col("fp").alias(x), F.col("text_key").alias(f"{x}_key"), F.col("root").alias(f"{x}_root")) for x in "uv"]
    across = near.join(ends[0], "u").join(ends[1], "v").where("u_root <> v_root")
    apart = apart.union(across.select(F.explode(F.array("u_key", "v_key")).alias("text_key"))).distinct()
    apart = written(texts.join(apart, "text_key").select("text_key", "root"), "apart")
    rest = prefix_pairs(apart, docs, size, least, id_col, text_col)
    rest = written(rest.join(tried, ["u", "v"], "left_anti"), "near-pairs")
    return components(links.union(alike_pairs(rest, docs, size, least, id_col, text_col)))


def near_dedup(docs: DataFrame, size: int = 3, distance: int = 3, similarity: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, fp, component_id, root of every row: the smallest id that links of ``distance`` or fewer bits
    reach, and the smallest fingerprint there, which names the group.

    Texts are lower-cased in A-Z and cut into words at ASCII blanks; shingles of ``size`` words count as often as they
    occur; a text of fewer words is one shingle, a text of none (null, empty, blanks) has fingerprint 0 and is linked
    like any other. Equal fingerprints meet in one row before the search, so copies cost one row however many there
    are. With ``similarity`` only equal texts meet so: a link joins two texts, of equal or near fingerprints or
    of an equal band of seeded minima, whose shingle sets (Jaccard) are that similar, and the smallest text_key names the group. A null id has its own rows in
    the result and never names a component unless all its ids are null.
    """
    if similarity is not None:
        return _similar_dedup(docs, size, distance, similarity, id_col, text_col)
    table = written(fingerprints(docs, size, id_col, text_col), "fingerprints")
    fps = written(table.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    pairs = near_pairs(fps, fps.count(), distance)
    return _named(table, fps, "fp", components(pairs))


def _named(table: DataFrame, nodes: DataFrame, key: str, linked: DataFrame) -> DataFrame:
    """Every row of ``table`` with the component of its ``key``."""
    linked = linked.select(F.col("node").alias(key), "root")
    named = linked.join(nodes, key).groupBy("root").agg(F.min("least").alias("reached"))
    far = linked.join(named, "root").select(key, "reached", "root")
    # written, so that both sides of the last join have an exchange of their own and a hot key can be split
    classes = nodes.join(far, key, "left").select(key, F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("reached")).alias("component_id"), F.coalesce("root", key).alias("root"))
    classes = written(classes, "classes")
    return table.join(classes, key).select("doc_id", "text_key", "fp", "component_id", "root")


def _similar_dedup(docs: DataFrame, size: int, distance: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    keyed = keyed_texts(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    table = written(keyed.mapInArrow(_banded(size), "doc_id long, text_key long, fp long, bands array<long>"), "fingerprints")
    texts = written(table.groupBy("text_key").agg(F.min("doc_id").alias("least"), F.min("fp").alias("fp")), "distinct-texts")
    fps = written(texts.select("fp").distinct(), "distinct-fingerprints")
    near = written(near_pairs(fps, fps.count(), distance), "near-fingerprints")
    banded = written(table.select("text_key", "bands").dropDuplicates(["text_key"]).select("text_key", F.posexplode("bands").alias("bucket", "value")), "bands")
    shared = banded.select("bucket", "value", "text_key").union(texts.select(F.lit(-1).alias("bucket"), F.col("fp").alias("value"), "text_key"))
    linked = alike_components(texts.select("text_key", "fp"), shared, near, docs, size, similarity, id_col, text_col)
    return _named(table, texts.select("text_key", "least"), "text_key", linked)


def one_of_each(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each group of ``near_dedup`` the row of the smallest id (no id comes last), of
    rows that share it the one of the smallest text_key, of rows that repeat both one. All columns as they were."""
    own, kept_id, kept_key = (free_name(docs, x) for x in ("_own", "_kept_id", "_kept_key"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    stays = classes.groupBy("root").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias(kept_id), F.col("k.text_key").alias(kept_key)).distinct()
    keyed = docs.withColumn(own, F.xxhash64(text_or_empty(text_col)))
    kept = keyed.join(stays, F.col(id_col).cast("long").eqNullSafe(F.col(kept_id)) & (F.col(own) == F.col(kept_key)), "left_semi")
    return kept.dropDuplicates([id_col, own]).drop(own)


def near_dedup_digest(docs: DataFrame, **options) -> DataFrame:
    return near_dedup(docs, **options).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
