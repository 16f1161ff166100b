"""Top-k search, the registered queries, and the pipeline against a brute-force run of its stages."""

import math
import random

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from cairnflow.llm import langid, line_dedup, pivot_search, queries, secrets, simhash

ROWS = "vec_id long, embedding array<float>, label int, v string, d int, dim int, cb int"


def brute_top(rows, every, k, scale):
    vectors = [(i, [math.floor(scale * float(np.float32(x))) for x in e]) for i, e in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = set()
    for q, x in {(i, tuple(v)) for i, v in vectors if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(x, v, strict=True)), i) for i, v in vectors if i != q and len(v) == len(x))
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


def test_pivot_search(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows += [(i, [0.5] * 8) for i in range(300, 340)] + [(340, None), (341, []), (342, [None] * 8), (343, [float("nan")] + [1.0] * 7), (344, [float("inf")] * 8), (None, [1.0] * 8), (345, [1.0, 2.0]), (350, [3.0, -2.0]), (360, [0.0] * 8)]
    df = spark.createDataFrame([(i, e, 0, "x", 1, 2, 3) for i, e in rows], ROWS)
    got = {tuple(r) for r in pivot_search.pivot_top_k(df, every=10, k=5).select("query_id", "rank", "vec_id", "score").collect()}
    assert got == brute_top(rows, 10, 5, 256.0)
    assert pivot_search.pivot_top_k(df.limit(0)).count() == 0
    two = spark.createDataFrame([(0, [1.0], 0, "", 0, 0, 0), (7, [2.0], 0, "", 0, 0, 0)], ROWS)
    assert [tuple(r) for r in pivot_search.pivot_top_k(two).collect()] == [(0, 1, 7, 256 * 512)]


def test_pivot_search_of_odd_vectors(spark):
    rows = [(100, [3e12, 1.0]), (0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [2.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [-1.0, 0.5]), (50, []), (4, []), (5, []), (200, [1e30, 1e30]), (6, [2e30, -1e30]), (7, [1.5e30, 1e30]), (7, [-0.0, 0.0])]
    got = sorted(tuple(r) for r in pivot_search.pivot_top_k(spark.createDataFrame([(i, e, 0, "x", 1, 2, 3) for i, e in rows], ROWS), every=50, k=4).select("query_id", "rank", "vec_id", "score").collect())
    want = []
    vectors = [(i, tuple(int(math.floor(256.0 * float(np.float32(x)))) for x in e)) for i, e in rows]
    for q, x in {(i, v) for i, v in vectors if i % 50 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(x, v, strict=True)), i) for i, v in vectors if i != q and len(v) == len(x))
        want += [(q, n + 1, i, max(-(2**63), min(2**63 - 1, -s))) for n, (s, i) in enumerate(scored[:4])]
    assert got == sorted(want)


def test_lots_that_cannot_matter_are_not_visited(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 40, (6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(0, 0.2, 8)).tolist()) for i in range(1200)]
    frame = spark.createDataFrame([(i, e, 0, "x", 1, 2, 3) for i, e in rows], ROWS)
    got = {tuple(r) for r in pivot_search.pivot_top_k(frame, every=50, k=5, pivots=6, lot_bytes=1).select("query_id", "rank", "vec_id", "score").collect()}
    assert got == brute_top(rows, 50, 5, 256.0)
    import pandas as pd

    x = np.array([e for _, e in rows])
    d = pivot_search._distances(x, centres)
    lots = pd.DataFrame([{"lo": d[i::6].min(0), "hi": d[i::6].max(0), "norm": float((x[i::6] ** 2).sum(1).max()), "lot": i} for i in range(6)])
    score = np.sort(x[::6] @ x[0])[-6]
    asked = pd.DataFrame([{"vec_id": 0, "k1": 0, "k2": 0, "v": x[0], "d": d[0], "seen": 0, "floor": float(score)}])
    assert len(pivot_search._survivors(asked, lots)) < 5


def test_elimination_leaves_candidates_out():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.integers(-5, 5, (2000, 16)), rng.integers(200, 260, (50, 16))])
    p = pivot_search.choose_pivots(x.astype(float), 8)
    d = np.sqrt(((x[:, None] - p[None]) ** 2).sum(2))
    seen = []
    products = pivot_search._products
    pivot_search._products = lambda a, b: (seen.append(len(a)), products(a, b))[1]
    try:
        got = pivot_search.best_of_block(np.array([-1]), x[-1:], d[-1:], np.arange(len(x)), x, d, 5)
    finally:
        pivot_search._products = products
    want = sorted((-int(v @ x[-1]), i) for i, v in enumerate(x))[:5]
    assert [(-s, i) for _, i, s in got] == want and sum(seen) < 600


def shown(v):
    return "~" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_statement(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = con.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in got.description]
    at = [names.index(c) for c in columns]
    assert sorted(names) == columns
    assert sorted(tuple(map(shown, r)) for r in df.select(*columns).collect()) == sorted(tuple(shown(r[i]) for i in at) for r in got.fetchall())


def brute_stages(docs, languages, table, path):
    """The first four stages in plain Python: {doc_id: text}."""
    scorer = langid.Scorer(languages, table, path)
    texts = {i: t for i, t in docs if t and scorer([t])[0][0] != "und" and scorer([t])[0][1] >= 0.5}
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(line_dedup.BLANKS))
    seen: dict[str, int] = {}
    for t in texts.values():
        for k in {key(x) for x in t.split("\n")}:
            seen[k] = seen.get(k, 0) + 1
    texts = {i: "\n".join(x for x in t.split("\n") if not key(x) or seen[key(x)] < 10) for i, t in texts.items()}

    def shingles(t):
        w = t.encode().lower().split()
        return {b" ".join(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {b" ".join(w)}

    sets = {i: shingles(t) for i, t in texts.items()}
    group = {i: i for i in texts}
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(group[a], group[b])
            if group[a] != low or group[b] != low:
                group[a] = group[b] = low
                changed = True
    kept = {i: texts[i] for i in set(group.values())}
    return {i: secrets.redacted(t, secrets.secret_spans(t)[1]) for i, t in kept.items()}


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    path = corpus_pipeline.public_tokenizers.path("piece_bpe_32k.model")
    want = brute_stages([(r.doc_id, r.text) for r in docs.collect()], *langid.learned(docs, path, noise=True), path)
    rows = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, sf)
        assert rows.columns == docs.columns and dict(rows.dtypes) == dict(docs.dtypes)
    got = {r.doc_id: r for r in rows.collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())
    out = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in out.collect()} == set(want)


def test_stages_on_odd_rows(spark, sf):
    like = "doc_id long, text string, lang string, source string, n_chars long, _id long, _own long, _kept_id string, _lines string, places string, root long, text_key long, fp long, n_lines int, batch int, lines string, spans string, length int"
    more = (1, 2, "x", "y", "z", 3, 4, 5, 6, 7, "w", "v", 8)
    plain, other = "this is the plain text of a row that goes on for a while", "the text of this row goes on for a while and that is the plain row "
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "123 !", "en", "s", 5), (4, plain, None, None, 1), (4, plain, None, None, 1), (None, other * 3, "en", None, None), (5, (other + plain + "\n") * 3000, "en", None, None)]
    odd = spark.createDataFrame([r + more for r in rows], like)
    for df in (odd, odd.limit(0)):
        rows = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, sf)
            assert rows.columns == df.columns
        assert sorted(str(r.doc_id) for r in rows.collect()) == (["4", "5", "None"] if df is odd else [])
        packed = corpus_pipeline.STAGES[-1][1](spark, rows, sf)
        assert (packed.count() > 20) if df is odd else packed.count() == 0
