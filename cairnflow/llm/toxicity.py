"""Toxicity by a support vector machine on a gapped subsequence string kernel with Nystroem landmarks."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnflow.llm.common import keyed_texts, remainder, slices

#: Subsequences of 3 and 4 characters with at most GAPS skipped characters; each skipped one costs the factor DECAY.
ORDERS, GAPS, DECAY = (3, 4), 2, 0.6
#: Labelled rows of each class that are learned from, how long such a row may be, landmarks, and rounds of relabelling.
TRAIN_ROWS, TRAIN_CHARS, LANDMARKS, ROUNDS = 1200, 20_000, 160, 4
#: Distinct words of clean training rows that the kernel sees at most, by their number of rows, beside all words that
#: evidence speaks against; most associated words from which landmarks are chosen; words a worker remembers.
TRAIN_WORDS, POOL, CACHED = 40_000, 8 * LANDMARKS, 400_000
PENALTY, STEMS, START = 10.0, (5, 6), 31

#: Letters of a spelled-out word ("i d i o t"): three or more single characters with single blanks between.
SPELLED = re.compile(r"(?<!\S)(?:\S ){2,}\S(?!\S)")
SENTENCE = re.compile(r"[.!?]+\s+|\n+")
#: Signs that stand for letters.
LOOKALIKE = dict(zip("013457@$", "oieastas", strict=True))

_folded: list[np.ndarray] = []


def folded() -> np.ndarray:
    """Code point -> class: 1..26 a letter from a to z, 27..30 other letters, 0 all else; 31 stands for a word's start."""
    if not _folded:
        table = np.zeros(0x110000, dtype=np.uint8)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = unicodedata.normalize("NFKC", ch).lower()
                table[c] = ord(low) - 96 if "a" <= low <= "z" and len(low) == 1 else 27 + ord(low[0]) % 4
        for sign, letter in LOOKALIKE.items():
            table[ord(sign)] = ord(letter) - 96
        _folded.append(table)
    return _folded[0]


def shapes() -> list[tuple[tuple[int, ...], int]]:
    """(offsets of a subsequence's characters, skipped characters) of all shapes the kernel counts."""
    out = []
    for order in ORDERS:
        for gaps in product(range(GAPS + 1), repeat=order - 1):
            if sum(gaps) <= GAPS:
                offsets = [0]
                for g in gaps:
                    offsets.append(offsets[-1] + g + 1)
                out.append((tuple(offsets), sum(gaps)))
    return out


SHAPES = shapes()
#: Keys of 3-character subsequences come first, then those of 4.
KEYS = 32**3 + 32**4


def features(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(word numbers, keys, weight) of the subsequences of one shape after the other, each start position once.

    Characters that stand for no letter are taken out first: put between letters they hide nothing."""
    codes = np.frombuffer("".join(["\n" + w for w in words]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    c, start = folded()[codes].astype(np.int64), codes == 10
    c[start] = START
    kept = c > 0
    c, word = c[kept], np.cumsum(start)[kept] - 1
    for offsets, gaps in SHAPES:
        n = len(c) - offsets[-1]
        if n <= 0:
            continue
        ok = word[:n] == word[offsets[-1] :]
        key = np.zeros(n, dtype=np.int64)
        for o in offsets:
            key = key * 32 + c[o : o + n]
        at = np.flatnonzero(ok)
        yield word[at], key[at] + (32**3 if len(offsets) == 4 else 0), DECAY**gaps


def norms(words: list[str]) -> np.ndarray:
    """What a word's kernel values are divided by: the root of its subsequences' squared weights."""
    total = np.zeros(len(words))
    for word, _, weight in features(words):
        total += np.bincount(word, minlength=len(words)) * weight**2
    return np.sqrt(np.maximum(total, 1e-12))


class Landmarks:
    """The landmarks' subsequences as columns: kernel values of any words against all landmarks by table lookups."""

    def __init__(self, words: list[str]):
        self.words = words
        scale = 1 / norms(words)
        found: dict[tuple[int, int], float] = {}
        for word, key, weight in features(words):
            for w, k in zip(word.tolist(), key.tolist(), strict=True):
                found[k, w] = found.get((k, w), 0.0) + weight * scale[w]
        self.keys = np.array(sorted({k for k, _ in found}), dtype=np.int64)
        self.number = np.full(KEYS, len(self.keys), dtype=np.int32)
        self.number[self.keys] = np.arange(len(self.keys))
        self.rows = np.zeros((len(self.keys) + 1, len(words)))
        for (k, w), v in found.items():
            self.rows[self.number[k], w] = v

    def kernel(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.words)))
        for word, key, weight in features(words):
            number = self.number[key]
            hit = np.flatnonzero(number < len(self.keys))
            for start in range(0, len(hit), 1 << 15):
                part = hit[start : start + (1 << 15)]  # in the order of words
                own, at = np.unique(word[part], return_index=True)
                out[own] += weight * np.add.reduceat(self.rows[number[part]], at, axis=0)
        return out / norms(words)[:, None]


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, start: np.ndarray, steps: int = 12) -> np.ndarray:
    """Weights (the last is the bias) of a linear machine with squared hinge loss, by Newton steps on the active rows."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = start.copy()
    reg = np.full(x.shape[1], 1.0)
    reg[-1] = 1e-3
    for _ in range(steps):
        active = y * (x @ w) < 1
        xa, wa = x[active], weight[active] * PENALTY
        new = np.linalg.solve((xa * wa[:, None]).T @ xa + np.diag(reg), xa.T @ (wa * y[active]))
        if np.abs(new - w).max() < 1e-6:
            return new
        w = new
    return w


def words_of(text: str) -> list[str]:
    """The units of a text: its words between blanks, and each spelled-out word as one more."""
    low = text.lower()
    return low.split() + [m.group().replace(" ", "") for m in SPELLED.finditer(low)]


def sentences_of(text: str) -> list[list[str]]:
    return [w for s in SENTENCE.split(text) if (w := words_of(s))]


class Machine:
    """The trained scorer: a table of subsequence weights, a bias, and the logistic scale of a text's score."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bias: float, slope: float, shift: float):
        self.keys, self.values, self.bias, self.slope, self.shift = keys, values, bias, slope, shift

    def word_scores(self, words: list[str]) -> np.ndarray:
        """The machine's value of each word."""
        table = _table_of(self)
        total = np.zeros(len(words))
        for word, key, weight in features(words):
            total += np.bincount(word, table[key], len(words)) * weight
        return total / norms(words) + self.bias

    def probability(self, best: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * best + self.shift, -30, 30)))


_tables: dict[int, tuple[Machine, np.ndarray]] = {}


def _table_of(machine: Machine) -> np.ndarray:
    held = _tables.get(0)
    if held is None or held[0] is not machine:
        table = np.zeros(KEYS)
        table[machine.keys] = machine.values
        _tables[0] = held = machine, table
    return held[1]


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of the class's chance by the score, with smoothed targets."""
    pos, neg = max(y.sum(), 1), max((1 - y).sum(), 1)
    goal = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - goal) * x).sum() + 1e-3 * a, (p - goal).sum()])
        r = p * (1 - p) + 1e-9
        h = np.array([[(r * x * x).sum() + 1e-3, (r * x).sum()], [(r * x).sum(), r.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 1e-3)), float(b)


def fit(texts: list[str], labels: list[int]) -> Machine | None:
    """The machine from whole labelled texts, or None where one of the classes is missing.

    Copies count once, else a copied text's words would look like evidence. A text's label is that of its sentences; in a toxic text only the witness of a sentence, its highest word, can be
    toxic, and labels may be wrong. The first witnesses are words whose share of toxic texts chance does not explain
    among that many words (a Chernoff bound at one in a hundred). The machine is trained on witnesses against the words
    of clean texts, relabels the witnesses by its own values and is trained again, ROUNDS times. A toxic text without
    a witness says nothing. Landmarks are words of toxic texts that are furthest apart in the kernel, and as many
    frequent words of clean texts. The logistic scale is fitted on the texts that have a witness or are clean.
    """
    if len(set(labels)) < 2:
        return None
    kept = distinct_rows(texts)
    texts, labels = [texts[k] for k in kept], [labels[k] for k in kept]
    if len(set(labels)) < 2:
        return None
    split = [sentences_of(t) for t in texts]
    seen: tuple[Counter, Counter] = Counter(), Counter()
    for s, label in zip(split, labels, strict=True):
        seen[label].update({w for words in s for w in words})
    total = max(1, labels.count(0)), max(1, labels.count(1))
    count = seen[0] + seen[1]
    words = [w for w, _ in sorted(count.items(), key=lambda x: (-x[1], x[0]))]
    toxic, clean = (np.array([seen[k][w] for w in words], dtype=np.float64) for k in (1, 0))
    evidence, level = stem_evidence(words, seen, split, labels)
    suspect = (toxic / total[1] > 10 * clean / total[0]) & (evidence > 0)
    # every suspect word stays, however rare; of the others the commonest
    use = np.sort(np.concatenate([np.flatnonzero(suspect), np.flatnonzero(~suspect)[:TRAIN_WORDS]]))
    words, toxic, clean, evidence, suspect = [words[k] for k in use], toxic[use], clean[use], evidence[use], suspect[use]
    order = sorted(np.flatnonzero(suspect).tolist(), key=lambda k: (-evidence[k], words[k]))
    worst = [words[k] for k in order if evidence[k] >= level] or [words[k] for k in order[:20]]
    marks = _spread(worst[:POOL], LANDMARKS // 2) + [w for k, w in enumerate(words) if evidence[k] == 0][: LANDMARKS // 2]
    if not worst:
        return None
    lm = Landmarks(marks)
    kmm = lm.kernel(marks)
    kmm = (kmm + kmm.T) / 2
    val, vec = np.linalg.eigh(kmm)
    keep = val > 1e-6
    root = vec[:, keep] / np.sqrt(val[keep])
    number = {w: n for n, w in enumerate(words)}
    x = lm.kernel(words) @ root
    bags = [[np.array([number[w] for w in s if w in number], dtype=np.int64) for s in t] for t, label in zip(split, labels, strict=True) if label]
    bags = [[s for s in t if len(s)] for t in bags]
    score = np.where(suspect & (evidence >= min(level, max(evidence.max(), 1e-9))), evidence, -1.0)
    w = np.zeros(x.shape[1] + 1)
    for _ in range(ROUNDS):
        positive = np.zeros(len(words))
        for text in bags:
            for s in text:
                k = s[score[s].argmax()]
                positive[k] += score[k] > 0 and suspect[k]
        # a word of a toxic text that is no witness and not seen in clean texts says nothing
        use_pos, use_neg = positive > 0, (positive == 0) & (clean > 0)
        if not use_pos.any() or not use_neg.any():
            break
        rows = np.concatenate([np.flatnonzero(use_pos), np.flatnonzero(use_neg)])
        y = np.concatenate([np.ones(use_pos.sum()), -np.ones(use_neg.sum())])
        weight = np.concatenate([np.log1p(positive[use_pos]) * max(1.0, use_neg.sum() / max(1, use_pos.sum())) ** 0.25, np.log1p(clean[use_neg])])
        w = svm(x[rows], y, weight, w)
        score = x @ w[:-1] + w[-1]
    beta = root @ w[:-1]
    values = lm.rows[:-1] @ beta
    machine = Machine(lm.keys, values, float(w[-1]), 1.0, 0.0)
    best, y = best_scores(machine, texts), np.array(labels, dtype=np.float64)
    told = (y == 0) | (best > 0)
    machine.slope, machine.shift = logistic(best[told], y[told])
    return machine


def distinct_rows(texts: list[str], hashes: int = 8, shared: int = 4) -> list[int]:
    """The texts, by number, that share fewer than ``shared`` of ``hashes`` min-hashes of their runs of three words with
    one before."""
    from zlib import crc32

    held: dict[tuple[int, int], list[int]] = {}
    out = []
    for n, text in enumerate(texts):
        words = text.lower().split()
        runs = {" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))}
        h = np.array([crc32(r.encode("utf-8", "surrogatepass")) for r in runs], dtype=np.uint64)
        keys = [(k, int((h * np.uint64(2 * k + 0x9E3779B1) % np.uint64(4_294_967_291)).min())) for k in range(hashes)]
        if max(Counter(r for key in keys for r in held.get(key, ())).values(), default=0) < shared:
            out.append(n)
            for key in keys:
                held.setdefault(key, []).append(n)
    return out


def parts_of(word: str) -> set[str]:
    """The word's runs of 5 and 6 letters, its own ends marked; signs are no letters."""
    letters = "^" + "".join(c for c in word if c.isalpha()) + "$"
    return {letters[k : k + n] for n in STEMS for k in range(max(1, len(letters) - n + 1))}


def stem_evidence(words: list[str], seen: tuple[Counter, Counter], split: list, labels: list[int]) -> tuple[np.ndarray, float]:
    """(evidence of each word: the most surprising of its parts, the level that chance reaches in one case of a hundred).

    Parts are counted over texts, so that inflected insults that are rare as words add up."""
    counts: tuple[Counter, Counter] = Counter(), Counter()
    cache = {w: parts_of(w) for w in words}
    for sentences, label in zip(split, labels, strict=True):
        counts[label].update(set().union(*(cache[w] for s in sentences for w in s if w in cache)))
    parts = sorted(counts[0].keys() | counts[1].keys())
    toxic, clean = (np.array([counts[k][p] for p in parts], dtype=np.float64) for k in (1, 0))
    found = dict(zip(parts, surprise(toxic, clean, labels.count(1) / len(labels)).tolist(), strict=True))
    return np.array([max(found[p] for p in cache[w]) for w in words]), float(np.log(len(parts) + 1) + np.log(100))


def surprise(toxic: np.ndarray, clean: np.ndarray, share: float) -> np.ndarray:
    """Minus the log of a bound on the chance that so many of a word's texts are toxic; 0 if no more than the share."""
    n = np.maximum(toxic + clean, 1)
    f = np.clip(toxic / n, 1e-12, 1 - 1e-12)
    return np.where(toxic / n > share, n * (f * np.log(f / share) + (1 - f) * np.log((1 - f) / (1 - share))), 0.0)


def _spread(words: list[str], most: int) -> list[str]:
    """Words each furthest, in the kernel, from those taken before; the first is the most associated one."""
    if len(words) <= most:
        return words
    k = Landmarks(words).kernel(words)
    taken, near = [0], k[:, 0].copy()
    while len(taken) < most:
        nxt = int(near.argmin())
        taken.append(nxt)
        near = np.maximum(near, k[:, nxt])
    return [words[n] for n in sorted(taken)]


_known: dict[int, tuple[Machine, dict[str, float]]] = {}


def best_scores(machine: Machine, texts: list[str]) -> np.ndarray:
    """The highest word value of each whole text; a text without words has the bias."""
    held = _known.get(0)
    if held is None or held[0] is not machine:
        _known[0] = held = machine, {}
    known = held[1]
    words = [words_of(t) for t in texts]
    distinct = set().union(*words)
    if len(known) + len(distinct) > CACHED:
        known.clear()
    new = list(distinct - known.keys())
    step, size = [], 0
    for n, w in enumerate(new):
        step.append(w)
        size += len(w) + 1
        if size > 300_000 or n == len(new) - 1:
            known.update(zip(step, machine.word_scores(step).tolist(), strict=True))
            step, size = [], 0
    return np.array([max(map(known.__getitem__, w), default=machine.bias) for w in words])


def _score(machine: Machine | None, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            p = machine.probability(best_scores(machine, texts)) if machine else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(p), pa.array((p >= least).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return run


def training_rows(texts: DataFrame, labels: DataFrame, label_col: str, folds: int, held_out: int) -> tuple[list[str], list[int]]:
    """At most TRAIN_ROWS whole texts of each class outside the held-out fold, by a hash of the id. A row whose id has
    several labels counts as toxic if one says so; null ids and labels are left out."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    marked = marked.where(remainder("doc_id", folds) != held_out).groupBy("doc_id").agg(F.max("y").alias("y"))
    # ordered by a hash, so the same rows are learned from in every run; at most 2 * TRAIN_ROWS ids, a proven bound for the broadcast
    chosen = [marked.where(F.col("y") == y).orderBy(F.xxhash64("doc_id", F.lit("toxicity")), "doc_id").limit(TRAIN_ROWS) for y in (0, 1)]
    rows = texts.where(F.char_length("text") <= TRAIN_CHARS).join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").select("doc_id", "text", "y")
    # an id may have several rows: of all of them as many as of ids, by a hash of the text
    out = [r for y in (0, 1) for r in rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text").limit(TRAIN_ROWS).collect()]
    kept = sorted({(r.doc_id, r.text, r.y) for r in out})
    return [r[1] for r in kept], [r[2] for r in kept]


def toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", folds: int = 3, held_out: int = 1, least: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    The machine reads every word of every text; a sentence is as toxic as its worst word and a text as its worst
    sentence. Skipped and inserted characters cost a factor each, signs that look like letters count as these, and a
    spelled-out word is read as one. Empty and null texts have the score of no word. Where labels of one class are
    missing nothing can be learned and every score is 0. Map only; each row stands by itself, also where an id repeats
    or is missing (it deals no fold then); a very long text costs time in proportion to its length; other columns are
    not read. Labels are learned from texts of at most TRAIN_CHARS characters, at most TRAIN_ROWS of each class.
    """
    texts = keyed_texts(docs, id_col, text_col)
    machine = fit(*training_rows(texts, labels, label_col, folds, held_out))
    return texts.withColumn("held_out", remainder("doc_id", folds) == held_out).mapInArrow(_score(machine, least), "doc_id long, held_out boolean, score double, predicted int")
