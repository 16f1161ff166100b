"""Exact dedup, line dedup, SimHash, language ID, packing, secrets, personal data, BPE and toxicity on small tables."""

import hashlib
import random
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cairnflow.llm import bpe, completion, exact_dedup, langid, line_dedup, packing, pii, secrets, simhash, toxicity
from cairnflow.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, h1 long, kept string, digest string, length int, spans string, root long"
TEXTS = [
    None, "", " ", "\n\n", "One line.", "one LINE.  ", "Same text here\nand a second line", "Same text here\nand a second line", "é ü ß 日本語 \U0001f600",
    "long " * 20_000, "x" * 5000, "token = \"0123456789abcdef0123456789abcdef\" mail bob@example.com +1 (302) 555-8032", "One line.",
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, texts, ids=None):
    """Rows with further columns whose names the operators use inside."""
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, None, None, None, 0.5, 1, 2, "k", "d", 3, "s", 4) for i, t in zip(ids, texts, strict=True)], DOCS)


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, blanks, a long text, ties, a repeated row and a row without an id."""
    return frame(spark, [*TEXTS, "no id", TEXTS[4]], [*range(len(TEXTS)), None, 4])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def sample(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def pairs_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


# --- exact dedup ---


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_dedup(sample, edge, none, keep):
    pick = max if keep == "largest" else min
    for df in (sample, edge):
        groups = defaultdict(list)
        for i, t in pairs_of(df):
            groups[t].append(i)
        want = Counter()
        for i, t in pairs_of(df):
            best = pick((x for x in groups[t] if x is not None), default=None)
            want[i, best, len(groups[t]), i == best, sha(t)] += 1
        got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_dedup(df, keep=keep).collect())
        assert got == want
    assert exact_dedup.exact_dedup(none).count() == 0


# --- line dedup ---

BLANK = " \t\n\x0b\x0c\r"


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANK))


def lines_without(texts, least):
    seen = Counter(k for t in texts for k in {key(x) for x in t.split("\n")} if k)
    return [[x for x in t.split("\n") if not (key(x) and seen[key(x)] >= least)] for t in texts]


@pytest.mark.parametrize(("least", "batches", "fanout"), [(2, 4, 2), (3, 1, 2), (2, 5, 3)])
def test_line_dedup(spark, edge, none, least, batches, fanout):
    rng = random.Random(least)
    many = frame(spark, ["\n".join(rng.choice(["a", " A ", "b\t", "", "\x0bc", "É", "é", "d e"]) for _ in range(rng.randrange(6))) for _ in range(80)])
    for df in (many, edge):
        rows = pairs_of(df)
        want = Counter((i, len(t.split("\n")), len(t.split("\n")) - len(k), sha("\n".join(k))) for (i, t), k in zip(rows, lines_without([t for _, t in rows], least), strict=True))
        got = line_dedup.line_dedup_digest(df, min_docs=least, batches=batches, fanout=fanout)
        assert Counter(map(tuple, got.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect())) == want
    out = line_dedup.line_dedup(none, min_docs=least)
    assert out.count() == 0 and out.columns[: len(none.columns)] == none.columns
    plan = line_dedup.line_dedup(edge, min_docs=2)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_line_runs_settle_and_compact(spark):
    runs = line_dedup.LineRuns(spark, 3, fanout=2)
    for n in range(5):
        runs.add(spark.createDataFrame([(1, 1), (2, n)] + [(3, 3)] * 4, "h1 long, h2 long"))
    assert len(runs.runs()) <= 3 and len(runs.levels) >= 2
    assert sorted((r.h1, r.h2) for r in runs.frequent().collect()) == [(1, 1), (3, 3)]


# --- SimHash ---


def brute_classes(fps, distance):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if bin((fps[a] ^ fps[b]) & (2**64 - 1)).count("1") <= distance:
                parent[find(a)] = find(b)
    return [find(x) for x in range(len(fps))]


def brute_fingerprint(text, size):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] if len(words) >= size else [" ".join(words)]
    hashed = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def test_fingerprints(sample):
    for _, t in pairs_of(sample)[:40] + list(enumerate(x or "" for x in TEXTS[:9])):
        assert simhash.fingerprint(t) & (2**64 - 1) == brute_fingerprint(t, 3)
    long = " ".join(random.Random(1).choices("abcdefgh", k=3 * simhash.WORDS_AT_ONCE))
    words = long.encode().split()
    counts, total = simhash.bit_counts(words, 3)
    kept, simhash.WORDS_AT_ONCE = simhash.WORDS_AT_ONCE, 1000
    try:
        again, n = simhash.bit_counts(words, 3)
    finally:
        simhash.WORDS_AT_ONCE = kept
    assert (counts == again).all() and total == n == len(words) - 2


@pytest.mark.parametrize("distance", [1, 3, 5])
def test_near_pairs_are_all_pairs(spark, distance):
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = sorted({(b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5)))) & (2**64 - 1) for b in base for _ in range(25)})
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    got = simhash.near_pairs(spark.createDataFrame([(f,) for f in signed], "fp long"), len(signed), distance)
    want = {(min(a, b), max(a, b)) for n, a in enumerate(signed) for b in signed[:n] if bin((a ^ b) & (2**64 - 1)).count("1") <= distance}
    rows = [(r.u, r.v) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_thresholds():
    cost, t = simhash.allocate([[0, 1, 5], [0, 100, 100], [0, 1, 2]], 0)
    assert sum(t) == 0 and cost == 7 and t == [1, -1, 0] or t == [0, -1, 1]
    groups = simhash.correlated_groups(np.eye(64) * 50, 100, 3)
    assert sorted(b for g in groups for b in g) == list(range(64)) and {len(g) for g in groups} == {21, 22}


@pytest.mark.parametrize("distance", [3])
def test_near_dedup(sample, edge, none, distance):
    for df in (sample, edge):
        rows = pairs_of(df)
        fps = [brute_fingerprint(t, 3) for _, t in rows]
        classes, least = brute_classes(fps, distance), {}
        for (i, _), c in zip(rows, classes, strict=True):
            if i is not None:
                least[c] = min(least.get(c, i), i)
        want = Counter((i, f"{f:016x}", least.get(c)) for (i, _), f, c in zip(rows, fps, classes, strict=True))
        assert Counter(map(tuple, simhash.near_dedup_digest(df).select("doc_id", "fingerprint", "component_id").collect())) == want
    assert simhash.near_dedup_digest(none).count() == 0


def test_one_of_each(spark):
    words = [f"w{k}" for k in range(400)]
    near = " ".join(words[:200] + ["other"] + words[201:])
    df = frame(spark, [" ".join(words), near, " ".join(words), "quite another text of its own", None, ""], [5, 3, 5, 7, None, 9])
    classes = simhash.near_dedup(df, size=5, distance=6, similarity=0.8)
    got = simhash.one_of_each(df, classes)
    assert sorted(r.doc_id for r in got.collect()) == [3, 7, 9] and got.columns == df.columns


def similar(a, b, size=5):
    def shingles(t):
        w = t.lower().split()
        return {" ".join(w[k : k + size]) for k in range(max(len(w) - size + 1, 1))}

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def kept_of(spark, texts):
    df = frame(spark, texts, list(range(len(texts))))
    return sorted(r.doc_id for r in simhash.one_of_each(df, simhash.near_dedup(df, size=5, distance=6, similarity=0.8)).collect())


def test_equal_fingerprints_are_verified(spark):
    laugh, own, other = "ha " * 60, [f"a{k}" for k in range(50)], [f"b{k}" for k in range(50)]
    texts = [laugh + " ".join(x) for x in (own, other, [*other[:49], "c"], [*own[:49], "c"])]
    assert len({simhash.fingerprint(t, 5) for t in texts}) == 1 and similar(texts[0], texts[1]) < 0.05
    assert similar(texts[0], texts[3]) >= 0.8 and similar(texts[1], texts[2]) >= 0.8
    assert kept_of(spark, texts) == [0, 1]


def test_pairs_of_every_similarity_are_found(spark):
    rng, texts = random.Random(8), []
    for k in range(60):
        words = [f"w{k}x{n}" for n in range(400)]
        other = list(words)
        for at in rng.sample(range(400), rng.randrange(2, 14)):
            other[at] = f"o{k}x{at}"
        texts += [" ".join(words), " ".join(other)]
    want = sorted([k for k in range(0, 120, 2)] + [k + 1 for k in range(0, 120, 2) if similar(texts[k], texts[k + 1]) < 0.8])
    far = [k for k in range(0, 120, 2) if similar(texts[k], texts[k + 1]) >= 0.8 and (simhash.fingerprint(texts[k], 5) ^ simhash.fingerprint(texts[k + 1], 5)).bit_count() > 6]
    assert 60 < len(want) < 120 and len(far) > 5
    assert kept_of(spark, texts) == want


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + k, 1001 + k) for k in range(60)] + [(5, 5)]
    least = {n: n for e in edges for n in e}
    while True:
        before = dict(least)
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
        if before == least:
            break
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    alone = {n for n in least if all(a == b for a, b in edges if n in (a, b))}
    assert got == {n: r for n, r in least.items() if n not in alone}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- language ID ---

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba"]
    p = {"▁": 0.1, "a": 0.2, "b": 0.3, "ab": 0.15, "▁a": 0.25, "ba": 0.05}

    def total(word):
        if not word:
            return 1.0
        return sum((p.get(word[:n], langid.UNCOVERED if n == 1 else 0.0)) * total(word[n:]) for n in range(1, len(word) + 1))

    words = ["ab", "a", "abba", "c", "", "ab!ab", "abcab", "bab"]
    model = langid.Pieces(pieces)
    table = np.array([[p[x]] for x in pieces] + [[0.0]])
    got = model.forward(table, words)[:, 0]
    assert np.allclose(got, [np.log(total("▁" + "".join(c for c in w if c.isalpha()))) for w in words])
    long = model.forward(table, ["ab" * 2000])[0, 0]
    step = model.forward(table, ["ab" * 1000])[0, 0] - model.forward(table, ["ab" * 500])[0, 0]
    assert np.isclose(long, model.forward(table, ["ab" * 1000])[0, 0] + 2 * step, rtol=1e-6)
    counts = model.expect(np.array(list(p.values())), ["ab", "ba"], np.array([1.0, 2.0]))
    size = np.array([len(x) for x in pieces])
    assert np.isclose((counts * size).sum(), 9)  # every character is covered once by each path


def test_language_id(sample, edge, none):
    got = {r.doc_id: r for r in langid.language_id(sample, PIECES).collect()}
    truth = {r.doc_id: r.lang for r in sample.collect()}
    assert len(got) == len(truth)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all(got[i].held_out == (i in set(held)) for i in truth)
    assert sum(got[i].lang_pred == truth[i] for i in held) / len(held) >= 0.95
    assert all(0 <= r.score <= 1 for r in got.values())
    labelled = edge.withColumn("lang", F.lit("xx"))
    rows = langid.language_id(labelled, PIECES).collect()
    assert len(rows) == edge.count()
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {0, 1, 2, 3} == und and all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert {r.lang_pred for r in langid.language_id(edge, PIECES).collect()} == {"und"}
    assert langid.language_id(none, PIECES).count() == 0
    kept = langid.known_language(labelled, PIECES)
    assert kept.columns == edge.columns and not {r.doc_id for r in kept.collect()} & {0, 1, 2, 3}
    assert langid.known_language(edge, PIECES).count() == edge.count() - 4


def test_long_pieces_and_long_words_are_counted_whole():
    rng = random.Random(4)
    pieces = sorted({"▁", "a", "b", "▁a", *("".join(rng.choice("ab") for _ in range(n)) for n in range(2, 15) for _ in range(3))})
    p = np.array([rng.random() for _ in pieces])
    p /= p.sum()
    model, chance = langid.Pieces(pieces), dict(zip(pieces, p.tolist(), strict=True))
    assert model.longest == 14
    words = ["".join(rng.choice("abc") for _ in range(n)) for n in (1, 5, 13, 20, 40, 90, 700)]
    want = Counter()
    totals = []
    for w in words:
        text = "▁" + w
        step = lambda a, b: max(chance.get(text[a:b], 0.0), langid.UNCOVERED if b - a == 1 else 0.0)  # noqa: B023, E731
        ahead, back = [1.0] + [0.0] * len(text), [0.0] * len(text) + [1.0]
        scale = 4.0  # keeps the plain sums inside doubles
        for b in range(1, len(text) + 1):
            ahead[b] = sum(ahead[a] * step(a, b) * scale ** (b - a) for a in range(max(0, b - 14), b))
        for a in range(len(text) - 1, -1, -1):
            back[a] = sum(back[b] * step(a, b) * scale ** (b - a) for b in range(a + 1, min(len(text), a + 14) + 1))
        totals.append(np.log(ahead[-1]) - len(text) * np.log(scale))
        for a in range(len(text)):
            for b in range(a + 1, min(len(text), a + 14) + 1):
                if text[a:b] in chance:
                    want[text[a:b]] += 2.0 * ahead[a] * step(a, b) * scale ** (b - a) * back[b] / ahead[-1]
    assert np.allclose(model.forward(np.append(p, 0.0)[:, None], words)[:, 0], totals)
    got = model.expect(p, words, np.full(len(words), 2.0))
    assert np.allclose(got, [want[x] for x in pieces], rtol=1e-5, atol=1e-9)


def test_texts_that_no_language_explains_go(spark, sample):
    rng = random.Random(1)
    junk = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(30)) for _ in range(5)]
    df = sample.select("doc_id", "text", "lang").union(spark.createDataFrame([(-1 - n, t, None) for n, t in enumerate([*junk, "xqzv kjwq zzxv qqkj", "12 !"])], "doc_id long, text string, lang string"))
    kept = {r.doc_id for r in langid.known_language(df, PIECES).collect()}
    assert min(kept) >= 0 and len(kept) >= 0.99 * sample.count()  # each of these holds a letter, but the last
    english = {r.doc_id for r in langid.known_language(df, PIECES, languages=["en"]).collect()}
    truth = {r.doc_id for r in sample.where("lang = 'en'").collect()}
    assert len(english & truth) >= 0.97 * len(truth) and len(english - truth) <= 0.02 * len(truth)


def test_labels_of_the_held_out_fold_are_not_read(sample):
    wrong = sample.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "zz").otherwise(F.col("lang")))
    assert "zz" not in {r.lang_pred for r in langid.language_id(wrong, PIECES).collect()}


# --- byte-level BPE ---

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference_encoder():
    import base64

    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark, sample, edge, none, reference_encoder):
    rng = random.Random(3)
    odd = ["".join(rng.choice("ab éñ\t\n\x0b 日本0٣'sS,.\U0001f600") for _ in range(200)) for _ in range(60)] + ["<|endoftext|> I'll", "a" * 3000, " " * 1000 + "x", "ab" * 400, "".join(rng.choice("abcdefghij") for _ in range(900))]
    for df in (sample, edge, frame(spark, odd)):
        want = Counter()
        for i, t in pairs_of(df):
            ids = reference_encoder.encode_ordinary(t)
            want[i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), sha(t)] += 1
        assert Counter(map(tuple, bpe.bpe_digest(df, RANKS, public_tokenizers.PATTERN).collect())) == want
    assert bpe.bpe_digest(none, RANKS, public_tokenizers.PATTERN).count() == 0
    encoded = bpe.bpe_encode(edge, RANKS, public_tokenizers.PATTERN)
    assert all(r.decoded == (r.text or "") for r in encoded.join(edge.dropDuplicates(["doc_id"]).select("doc_id", "text"), "doc_id").collect())
    back = {r.doc_id: r.decoded.decode() for r in bpe.bpe_decode(encoded, RANKS, public_tokenizers.PATTERN).collect()}
    assert back[8] == TEXTS[8] and back[0] == ""


def test_a_lesser_pair_that_comes_between_is_taken_first(tmp_path):
    """A vocabulary in which a merge brings forth a pair of lower rank: ab (300) and a (97) make aba (290)."""
    import base64

    import tiktoken

    ranks = {bytes([n]): n for n in range(256)} | {b"aba": 290, b"ab": 300, b"abab": 310}
    (tmp_path / "ranks").write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % n for t, n in ranks.items()))
    codec, library = bpe.Codec(str(tmp_path / "ranks"), r"\S+|\s+"), tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    for word in ["ab" * 200, "abab" * 99 + "a", *("".join(rng.choice("aab") for _ in range(300)) for _ in range(6))]:
        flat, _ = codec.encode_words([word.encode()])
        assert flat.tolist() == library.encode_ordinary(word)


def test_bpe_short_and_long_forms_agree(reference_encoder):
    c = bpe.codec(RANKS, public_tokenizers.PATTERN)
    for w in (b"aaaaaaaaaaaaaaaaaaaaa", "ééééééé日".encode(), b"thethethetheth", bytes(range(33, 127))):
        if w not in c.ranks:
            assert c._short([w])[0].tolist() == c._long(w)[0].tolist() == reference_encoder._encode_single_piece(w)
    with pytest.raises(ValueError):
        c.decode(np.array([10**6]), np.array([1]))


# --- packing ---

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def check_packing(rows, texts, size):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(VOCABULARY)
    want = Counter()
    for i, t in texts:
        ids = [*lib.encode(t, add_special_tokens=False).ids, 2]
        first = len(ids) % size or size
        cuts = [0, *range(first, len(ids) + 1, size)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[i, n, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def best_fit_decreasing(items, capacity):
    bins = []
    for x in sorted(items, reverse=True):
        at = bisect_left(bins, x)
        insort(bins, (bins.pop(at) if at < len(bins) else capacity) - x)
    return len(bins)


def test_text_of_an_added_token_is_that_token(spark):
    df = frame(spark, ["a <|endoftext|> b", "plain <|endoftext", "<|endoftext|>" * 3])
    check_packing(packing.pack(df, VOCABULARY, public_tokenizers.PATTERN, size=16).collect(), pairs_of(df), 16)


@pytest.mark.parametrize(("table", "column"), [("sf0.01", "n_chars"), ("sf0.1", "n_chars")])
def test_packing_is_never_worse_than_best_fit_decreasing(spark, table, column):
    sizes = [r[0] % 1024 or 1024 for r in spark.read.parquet(f"/root/testdata/{table}/documents.parquet").select(column).collect()]
    counts = np.bincount(sizes, minlength=1025)
    patterns = packing.pack_histogram(counts, 1024)
    assert Counter(s for t, x in patterns for s in x for _ in range(t)) == Counter(sizes) and all(sum(x) <= 1024 for _, x in patterns)
    fewest = best_fit_decreasing(sizes, 1024)
    assert completion.least_bins(counts, 1024) <= sum(t for t, _ in patterns) <= fewest == sum(t for t, _ in completion.best_fit_decreasing(counts, 1024))


@pytest.mark.parametrize("size", [1024, 64])
def test_packing(sample, edge, none, size):
    for df in (sample, edge):
        rows = packing.pack(df, VOCABULARY, public_tokenizers.PATTERN, size=size).collect()
        bins = check_packing(rows, pairs_of(df), size)
        assert bins <= best_fit_decreasing([r.length for r in rows], size)
    assert packing.pack(none, VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_bin_completion_is_optimal_where_it_can_be_told():
    rng = np.random.default_rng(2)
    for _ in range(60):
        items, capacity = rng.integers(1, 21, rng.integers(1, 11)), 20

        def best(left, bins, most):
            if not left:
                return len(bins)
            if len(bins) >= most:
                return most
            out, seen = most, set()
            for n, free in enumerate(bins):
                if free >= left[0] and free not in seen:
                    seen.add(free)
                    out = min(out, best(left[1:], (*bins[:n], free - left[0], *bins[n + 1 :]), out))
            return min(out, best(left[1:], (*bins, capacity - left[0]), out)) if len(bins) + 1 <= out else out

        patterns = packing.pack_histogram(np.bincount(items, minlength=capacity + 1), capacity)
        assert Counter(s for t, x in patterns for s in x for _ in range(t)) == Counter(items.tolist())
        assert all(sum(x) <= capacity for _, x in patterns)
        fewest = best(sorted(items.tolist(), reverse=True), (), len(items))
        assert sum(t for t, _ in patterns) == fewest and completion.least_bins(np.bincount(items, minlength=capacity + 1), capacity) <= fewest
    assert sum(t for t, _ in packing.pack_histogram(np.bincount([6] * 10**6 + [4] * 10**6, minlength=11), 10)) == 10**6


# --- secrets ---

SECRET = {
    "assign": r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def brute_secrets(text):
    out = []
    for kind, least in (("assign", 8), ("access", 16), ("hex", 32)):
        for m in re.finditer(SECRET[kind], text, re.ASCII | (re.IGNORECASE if kind == "assign" else 0)):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda x: (x[1], ["assign", "access", "hex"].index(x[0])))


def test_secrets(spark, sample, edge, none):
    rng = random.Random(6)
    made = ["".join(rng.choice(["token", "PassWord", "api_key", "apikey", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH", "0123456789abcdef", "deadbeef", "x.y", "\n", "ſecret", "é"]) for _ in range(rng.randrange(30))) for _ in range(300)]
    for df in (sample, edge, frame(spark, made)):
        texts = defaultdict(list)
        for i, t in pairs_of(df):
            texts[i].append(t)
        for r in secrets.secret_scan(df).collect():
            found = [(t, brute_secrets(t)) for t in texts[r.doc_id]]
            base = next(b for _, b in found if sha(secrets.joined(b)) == r.base_sha256)
            n = Counter(k for k, _, _ in base)
            assert (r.n_assign, r.n_access, r.n_hex) == (n["assign"], n["access"], n["hex"])
            spans = r.spans.split(",") if r.spans else []
            assert set(secrets.joined(base).split(",") if base else []) <= set(spans)
    assert secrets.secret_scan(none).count() == 0
    out = secrets.redact_secrets(edge)
    assert out.columns == edge.columns and out.count() == edge.count()
    assert "0123456789abcdef" not in out.where("doc_id = 11").first().text and out.where("doc_id = 0").first().text is None


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ('db_pass = "hunter2secret!"', ["hunter2secret!"]), ('x = "abc123DEF456ghi789"\nauth_token = x', ["abc123DEF456ghi789"]), ('{"client_secret_value": "a8Fk29" + "sLq0Zx"}', ["a8Fk29", "sLq0Zx"]),
        ("k1=Zx8qLw92mTn4\nk2=k1\nprivate_key=k2", ["Zx8qLw92mTn4"]), ("PRIVATE_KEY=MIIEvQIBADANBgkqh", ["MIIEvQIBADANBgkqh"]), ("private_key: ${KEY}", []), ("max_tokens_count: 1024000000", []),
        ("the key: idea", []), ("auth_key = changeme", []), ("passphrase: unterminated \"abc", ["unterminated"]), ("a = b\nb = a\nsigning_key = b", []),
    ],
)
def test_lexed_secrets(text, found):
    base, spans = secrets.secret_spans(text)
    assert [text[a:b] for k, a, b in spans if k == "literal"] == found
    for piece in found:
        assert piece not in secrets.redacted(text, spans)


# --- personal data ---

PERSONAL = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_personal(text):
    out = []
    for kind, pattern in PERSONAL.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or kind == "card" and 16 <= len(digits) <= 19 and pii.luhn(digits) or kind == "phone" and 8 <= len(digits) <= 15:
                out.append((kind, m.start(), m.end()))
    return out


def test_personal_patterns():
    rng = random.Random(2)
    for _ in range(20_000):
        text = "".join(rng.choice("ab@.+-1234 ()0999x\n") for _ in range(rng.randrange(40)))
        assert pii.base_spans(text) == brute_personal(text)
    assert pii.base_spans("1" * 200_000 + "." + "a" * 200_000 + "@") == []


def test_gradients_are_those_of_the_loss():
    codes = [pii.classes_of("ab 1.2.3.4 cd"), pii.classes_of("x@y.com z")]
    x, size = pii.batch_of(codes, [(0, 0, 13), (1, 0, 9)])
    tags = np.stack([pii.tags_of(0, 13, [("ip", 3, 10)]), pii.tags_of(0, 9, [("email", 0, 7)])])
    model = {k: v.astype(np.float64) for k, v in pii.fresh().items()}
    _, g = pii.gradients(model, x, size, tags)
    for name in ("wf", "wb", "embed", "out", "trans", "cf", "first"):
        at = np.unravel_index(np.argmax(np.abs(g[name])), g[name].shape)
        model[name][at] += 1e-2
        up, _ = pii.gradients(model, x, size, tags)
        model[name][at] -= 2e-2
        down, _ = pii.gradients(model, x, size, tags)
        model[name][at] += 1e-2
        assert np.isclose((up - down) / 2e-2, g[name][at], rtol=2e-2)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    k = len(pii.TAGS)
    model = {"first": rng.normal(size=k).astype(np.float32), "trans": rng.normal(size=(k, k)).astype(np.float32)}
    em = rng.normal(size=(1, 3, k)).astype(np.float32)
    best = max(((a, b, c) for a in range(k) for b in range(k) for c in range(k)), key=lambda p: model["first"][p[0]] + model["trans"][p[0], p[1]] + model["trans"][p[1], p[2]] + sum(em[0, t, p[t]] for t in range(3)))
    assert tuple(pii.viterbi(model, em, np.array([3]))[0]) == best


def test_personal_data(sample, edge, none):
    assert pii.pii_scan(none).count() == 0
    for df in (sample, edge):
        texts = defaultdict(list)
        for i, t in pairs_of(df):
            texts[i].append(t)
        hit = 0
        for r in pii.pii_scan(df).collect():
            base = next(b for b in map(brute_personal, texts[r.doc_id]) if sha(pii.joined(b)) == r.base_sha256)
            n = Counter(k for k, _, _ in base)
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in pii.KINDS)
            assert set(pii.joined(base).split(",") if base else []) <= set(r.spans.split(",") if r.spans else [])
            hit += len(base)
        assert hit


@pytest.fixture(scope="module")
def personal_model(sample):
    return pii.fit([t for _, t in pairs_of(sample) if pii.TRIGGER.search(t) and len(t) < 20_000])


def test_the_network_finds_what_no_pattern_has(personal_model):
    """Held-out recall of spans beyond the patterns: this fails if the network is left out."""
    data = pii.invented(200, seed=99)
    beyond, hit, wrong = 0, 0, 0
    for (text, spans), found in zip(data, pii.decoded(personal_model, [t for t, _ in data]), strict=True):
        base = set(pii.base_spans(text))
        added = set(pii.reconciled(text, sorted(base), found)) - base
        beyond += len(set(spans) - base)
        hit += len(set(spans) & added)
        wrong += len(added - set(spans))
    assert beyond > 150 and hit >= 0.85 * beyond and wrong <= 0.05 * beyond


def test_the_network_leaves_clean_texts_alone(sample, personal_model):
    texts = [t for _, t in pairs_of(sample)]
    added = sum(len(pii.reconciled(t, pii.base_spans(t), f)) - len(pii.base_spans(t)) for t, f in zip(texts, pii.decoded(personal_model, texts), strict=True))
    assert added <= 0.01 * len(texts)


def test_spans_of_any_length_are_stitched(monkeypatch):
    """A tagger that marks every x as personal: its spans come out whole, however many windows they run through."""
    text = "1 " + "x" * 300 + " ab 2 " + "x" * 40 + " " + "x" * 5 + "9"
    monkeypatch.setattr(pii, "emissions", lambda model, x, size: ((x == pii.classes_of("x")[0]).astype(np.float32), None))
    monkeypatch.setattr(pii, "marginals", lambda model, em, size: (np.ones((*em.shape, len(pii.TAGS))), None, None))

    def marked(model, em, size):
        starts = em.copy()
        starts[:, 1:] = em[:, 1:] * (1 - em[:, :-1])
        starts[:, 0] = 0
        return np.where(starts > 0, 1, np.where(em > 0, 2, 0))

    monkeypatch.setattr(pii, "viterbi", marked)
    want = [("email", m.start(), m.end()) for m in re.finditer("x+", text)]
    assert [x[1:] for x in pii.decoded({}, [text])[0]] == want


def test_parts_of_an_address_are_checked():
    assert pii.whole("ip", "10.0.0.30") and pii.whole("ip", "10[.]0[.]0[.]3") and not pii.whole("ip", "10.0.0.300")
    many = [(0.95, "phone", 16 * n, 16 * n + 12) for n in range(20_000)]
    text = "302-555-8032    " * 20_000
    assert len(pii.reconciled(text, [], many)) == 20_000


def test_windows_cover_every_region():
    text = "a" * 500 + "1" * 300 + "b" * 200 + "@" + "c" * 50
    for a, b in pii.regions(text):
        covered = set()
        for s, e, _, _ in pii.windows(text):
            assert e - s <= pii.WINDOW
            covered |= set(range(s, e))
        assert set(range(a, b)) <= covered
    assert pii.windows("no trigger here") == []
    assert pii.reconciled("0123456789", [("ip", 0, 5)], [(0.99, "phone", 3, 9)]) == [("ip", 0, 5)]


# --- toxicity ---


def brute_kernel(a, b):
    """The kernel's sum over equal subsequences, from its definition."""
    def subs(word):
        out = defaultdict(float)
        c = [toxicity.START] + [int(x) for x in toxicity.folded()[[ord(ch) for ch in word]] if x]
        for offsets, gaps in toxicity.SHAPES:
            for n in range(len(c) - offsets[-1]):
                out[tuple(c[n + o] for o in offsets)] += toxicity.DECAY**gaps
        return out

    x, y = subs(a), subs(b)
    return sum(v * y[k] for k, v in x.items())


def test_kernel():
    words = ["idiot", "id-iot", "idxiot", "thing", "a", "clown"]
    lm = toxicity.Landmarks(words)
    n = toxicity.norms(words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert np.isclose(lm.kernel(words)[i, j], brute_kernel(a, b) / n[i] / n[j])
    assert lm.kernel(["idiot"])[0, 1] == pytest.approx(lm.kernel(["idiot"])[0, 0]) and lm.kernel(["idiot"])[0, 2] > 0.4 > lm.kernel(["idiot"])[0, 3]


def test_toxicity(spark, sample, edge, none):
    rng = random.Random(9)
    clean = ["".join(rng.choice(["ba", "to", "li", "mo", "ren", "sta", "ku"]) for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    rude = ["idiot", "moron", "scumbag"]
    rows = []
    for k in range(600):
        words = rng.choices(clean, k=rng.randrange(5, 60))
        if k % 4 == 0:
            words.insert(rng.randrange(len(words)), rng.choice(rude))
        rows.append((k, " ".join(words), int(k % 4 == 0)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert held and all(got[i].held_out for i, _ in held)
    assert sum(got[i].predicted == y for i, y in held) / len(held) > 0.95
    machine = toxicity.fit([t for _, t, _ in rows], [y for _, _, y in rows])
    p = lambda t: machine.probability(toxicity.best_scores(machine, [t]))[0]
    assert all(p(t) >= 0.7 for t in ("you i d i o t", "m*o*r*o*n", "such an idi-ot")) and p("") < 0.5 and p("molito stato") < 0.5
    for df in (edge, none):
        out = toxicity.toxicity(df, labels)
        assert out.count() == df.count() and all(0 <= r.score <= 1 for r in out.collect())
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r.doc_id: r.score for r in toxicity.toxicity(docs, flipped).collect()} == {i: r.score for i, r in got.items()}


def test_prefix_pairs_hold_every_alike_pair(spark):
    """All pairs of five-word Jaccard similarity 0.8 come out, of a family of edited copies, of texts around one passage,
    and of texts of exactly 0.8; without words, short and repeated texts too."""
    dice = random.Random(5)
    word = lambda: "".join(dice.choice("abcdefghij") for _ in range(4))
    base, passage = [word() for _ in range(150)], [word() for _ in range(60)]
    texts = ["", " ", "one", "One", "a b c d e f g h", "a b c d e f g h i"]
    for k in range(60):
        family = list(base)
        for at in dice.sample(range(150), k % 5):
            family[at] = word()
        texts += [" ".join(family), " ".join(passage + [word() for _ in range(k % 17)])]
    texts.append(texts[-1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = docs.selectExpr("xxhash64(text) as text_key", "text")
    keys = {r.text: r.text_key for r in table.collect()}
    open_texts = table.select("text_key", F.col("text_key").alias("root")).distinct()
    got = {(r.u, r.v) for r in simhash.prefix_pairs(open_texts, docs, 5, 0.8, "doc_id", "text").collect()}

    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}

    sets = {k: shingles(x) for x, k in keys.items()}
    alike = {(u, v) for u in sets for v in sets if u < v and len(sets[u] & sets[v]) * 5 >= 4 * len(sets[u] | sets[v])}
    assert len(alike) > 100 and alike <= got
    assert len(got) < len(sets) * (len(sets) - 1) // 2
