"""Language identification by unigram piece models whose score sums over all segmentations of a word."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnflow.llm.common import keyed_texts, remainder, slices, text_or_empty

UNKNOWN = "und"
#: Labelled rows of each language that a model is learned from, and how long such a row may be.
TRAIN_ROWS, TRAIN_CHARS = 400, 20_000
#: Lengths of pieces that are looked up at every place; the few longer ones are looked up where their start is found.
DENSE = 8
#: Rounds of expectation-maximisation, smoothing, words cached.
ROUNDS, SMOOTH, CACHED = 3, 0.05, 300_000
#: Characters of a word up to which chances need no rescaling when pieces are counted, and cells of a batch of words.
PLAIN, CELLS = 24, 2_000_000
#: Chance of a character that no piece covers, and the steps after which chances are rescaled.
UNCOVERED, RESCALE = 1e-7, 16
MARK = 0x2581
BASE = np.uint64(1_099_511_628_211)

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def pieces_of(path: str) -> list[str]:
    """The vocabulary's pieces of lower-case letters, with or without the word mark. Texts are read as their lower-case
    letters, in which no other piece can occur."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {model.id_to_piece(i) for i in range(model.get_piece_size())}
    mark = chr(MARK)
    return sorted(p for p in found if p and (p == mark or (b := p.removeprefix(mark)).isalpha() and b == b.lower()))


def _hash(codes: np.ndarray) -> np.ndarray:
    """The rolling hash of each row of code points."""
    h = np.zeros(len(codes), dtype=np.uint64)
    for k in range(codes.shape[1]):
        h = h * BASE + codes[:, k]
    return h


class Lattice:
    """The pieces of words laid end to end, the words in the order of falling length (``order``).

    ``dense[n - 1][i]`` is the number of the piece of n characters that starts at place i, ``count`` if there is none;
    longer pieces are told one by one. first, length: where each word starts and how long it is, its mark included."""

    def __init__(self, dense: list[np.ndarray], first: np.ndarray, length: np.ndarray, longer: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]):
        self.dense, self.order = dense, np.argsort(-length, kind="stable")
        self.first, self.length = first[self.order], length[self.order]
        self.longest = int(length.max(initial=0))
        # at step t the first lives[t] words are not at their end yet
        self.lives = np.searchsorted(-self.length, -np.arange(self.longest + 2), side="right").tolist()
        back = np.empty_like(self.order)
        back[self.order] = np.arange(len(self.order))
        self.longer = []
        for size, word, start, number in longer:
            by_start = np.argsort(start, kind="stable")
            begins = np.searchsorted(start[by_start], np.arange(-size, self.longest + 2)).tolist()
            self.longer.append((size, back[word[by_start]], number[by_start], begins))

    def from_place(self, t: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, words, numbers) of the longer pieces that start at place t of their words."""
        for size, word, number, begins in self.longer:
            lo, hi = begins[t + size], begins[t + size + 1]
            if lo < hi:
                yield size, word[lo:hi], number[lo:hi]

    def to_place(self, t: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The same of those that end there."""
        for size, word, number, begins in self.longer:
            lo, hi = begins[t], begins[t + 1]
            if lo < hi:
                yield size, word[lo:hi], number[lo:hi]


class Pieces:
    """Piece numbers of all substrings of many words at once, by a rolling hash for each length."""

    def __init__(self, pieces: list[str]):
        self.count, self.longest = len(pieces), max(map(len, pieces), default=1)
        self.sorted: list[tuple[np.ndarray, np.ndarray]] = []
        starts: list[np.ndarray] = []
        for size in range(1, self.longest + 1):
            own = [(n, p) for n, p in enumerate(pieces) if len(p) == size]
            codes = np.array([[ord(c) for c in p] for _, p in own], dtype=np.uint64).reshape(len(own), size)
            h = _hash(codes)
            order = np.argsort(h)
            self.sorted.append((h[order], np.array([n for n, _ in own], dtype=np.int64)[order]))
            if size > DENSE:
                starts.append(_hash(codes[:, :DENSE]))
        self.starts = np.unique(np.concatenate(starts)) if starts else np.empty(0, dtype=np.uint64)

    def _numbers(self, size: int, h: np.ndarray) -> np.ndarray:
        keys, ids = self.sorted[size - 1]
        out = np.full(len(h), self.count, dtype=np.int64)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[at] == h
            out[hit] = ids[at[hit]]
        return out

    def lattice(self, words: list[str]) -> Lattice:
        """A word is its letters behind a mark."""
        joined = "".join(chr(MARK) + w for w in words)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        kept = letters()[codes]
        sizes = np.array([len(w) + 1 for w in words], dtype=np.int64)
        start = np.cumsum(sizes) - sizes
        kept[start] = True
        word = np.repeat(np.arange(len(words)), sizes)[kept]
        codes = codes[kept].astype(np.uint64)
        length = np.bincount(word, minlength=len(words))
        first = np.cumsum(length) - length
        place = np.arange(len(codes)) - first[word]
        left = length[word] - place
        dense, h = [], np.zeros(len(codes), dtype=np.uint64)
        for n in range(1, min(DENSE, self.longest) + 1):
            h = h * BASE
            whole = max(0, len(codes) - n + 1)
            h[:whole] += codes[n - 1 : n - 1 + whole]
            dense.append(np.where(left >= n, self._numbers(n, h), self.count))
        longer: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        if len(self.starts):
            at = np.flatnonzero(left > DENSE)
            at = at[self.starts[np.minimum(np.searchsorted(self.starts, h[at]), len(self.starts) - 1)] == h[at]]
            h = h[at]
            for n in range(DENSE + 1, self.longest + 1):
                fits = left[at] >= n
                at, h = at[fits], h[fits] * BASE + codes[at[fits] + n - 1]
                number = self._numbers(n, h)
                hit = number < self.count
                if hit.any():
                    longer.append((n, word[at[hit]], place[at[hit]], number[hit]))
        return Lattice(dense, first, length, longer)

    def forward(self, table: np.ndarray, words: list[str]) -> np.ndarray:
        """log P(word | language) for each word and language, summed over all segmentations by the forward recursion.

        table: chance of each piece (rows; the last row is "no piece") in each language. Alphas are rescaled
        every RESCALE steps, so a word may have any length."""
        of = self.lattice(words)
        k = table.shape[1]
        table = np.concatenate([table, np.zeros((1, k))])[: self.count + 1]
        window, scale, ends = [np.ones((len(words), k))], np.zeros((len(words), k)), np.empty((len(words), k))
        for t in range(1, of.longest + 1):
            live = of.lives[t]
            total = np.zeros((live, k))
            for n in range(1, min(len(of.dense), t) + 1):
                p = table[of.dense[n - 1][of.first[:live] + (t - n)]]
                total += window[-n][:live] * (np.maximum(p, UNCOVERED) if n == 1 else p)
            for n, w, number in of.to_place(t):
                total[w] += window[-n][w] * table[number]
            window = [*window[-(self.longest - 1) :], total] if self.longest > 1 else [total]
            if t % RESCALE == 0:
                top = np.maximum(total.max(1, keepdims=True), 1e-300)
                scale[:live] += np.log(top)
                for x in window:
                    x[:live] /= top
            done = slice(of.lives[t + 1], live)
            ends[done] = np.log(np.maximum(total[done], 1e-300)) + scale[done]
        out = np.empty((len(words), k))
        out[of.order] = ends
        return out

    def expect(self, p: np.ndarray, words: list[str], weight: np.ndarray) -> np.ndarray:
        """Expected count of each piece in the weighted words, whole ones, under piece chances p: forward and backward
        sums over batches of words of like lengths."""
        order = sorted(range(len(words)), key=lambda n: len(words[n]))
        counts, start = np.zeros(self.count), 0
        while start < len(order):
            end = start + 1
            plain = len(words[order[start]]) <= PLAIN
            while end < len(order) and (end - start + 1) * (len(words[order[end]]) + 2) <= CELLS and (len(words[order[end]]) <= PLAIN) == plain:
                end += 1
            counts += self._expect(p, [words[n] for n in order[start:end]], weight[order[start:end]], not plain)
            start = end
        return counts

    def _expect(self, p: np.ndarray, words: list[str], weight: np.ndarray, rescaled: bool) -> np.ndarray:
        of, table, n_words = self.lattice(words), np.append(p, 0.0), len(words)
        weight, every = weight[of.order], np.arange(n_words)
        chance = lambda n, at: np.maximum(table[of.dense[n - 1][at]], UNCOVERED) if n == 1 else table[of.dense[n - 1][at]]
        # sums are held as alpha * exp(up) and beta * exp(down); without rescaling both exponents stay 0
        alpha, beta, up, down = (np.zeros((of.longest + 1, n_words)) for _ in range(4))
        alpha[0], now = 1, np.zeros(n_words)
        for t in range(1, of.longest + 1):
            live = of.lives[t]
            for n in range(1, min(len(of.dense), t) + 1):
                step = alpha[t - n, :live] * chance(n, of.first[:live] + t - n)
                alpha[t, :live] += step * np.exp(up[t - n, :live] - now[:live]) if rescaled else step
            for n, w, number in of.to_place(t):
                alpha[t, w] += alpha[t - n, w] * table[number] * np.exp(up[t - n, w] - now[w])
            if rescaled and t % RESCALE == 0:
                top = np.maximum(alpha[t, :live], 1e-300)
                now[:live] += np.log(top)
                alpha[t, :live] /= top
            up[t] = now
        beta[of.length, every] = 1
        total = np.log(np.maximum(alpha[of.length, every], 1e-300)) + up[of.length, every]
        counts, now = np.zeros(self.count + 1), np.zeros(n_words)
        for t in range(of.longest - 1, -1, -1):
            for n in range(1, min(len(of.dense), of.longest - t) + 1):
                live = of.lives[t + n]
                at = of.first[:live] + t
                step = chance(n, at) * beta[t + n, :live]
                if rescaled:
                    step = step * np.exp(down[t + n, :live] - now[:live])
                beta[t, :live] += step
                counts += np.bincount(of.dense[n - 1][at], alpha[t, :live] * step * weight[:live] * np.exp(up[t, :live] + now[:live] - total[:live]), self.count + 1)
            for n, w, number in of.from_place(t):
                step = table[number] * beta[t + n, w] * np.exp(down[t + n, w] - now[w])
                beta[t, w] += step
                np.add.at(counts, number, alpha[t, w] * step * weight[w] * np.exp(up[t, w] + now[w] - total[w]))
            if rescaled and t % RESCALE == 0:
                live = of.lives[t + 1]
                top = np.maximum(beta[t, :live], 1e-300)
                now[:live] += np.log(top)
                beta[t, :live] /= top
            down[t] = now
        return counts[:-1]


DIGIT = re.compile(r"[0-9]")


def words_of(text: str) -> list[str]:
    """The lower-case words between blanks. Those that hold a digit are codes and numbers, not of a language; they are
    read only where there are no others with a letter."""
    words = text.lower().split()
    if DIGIT.search(text):
        plain = [w for w in words if not DIGIT.search(w)]
        if any(any(map(str.isalpha, w)) for w in plain):
            return plain
    return words


def learn(texts: dict[str, list[str]], pieces: list[str], noise: bool = False) -> tuple[list[str], np.ndarray]:
    """(languages, chance of each piece in each): unigram models by expectation-maximisation over the words' counts.

    With ``noise`` a last model stands for no language (UNKNOWN): letters drawn one by one by their share in all texts,
    that is, the chances of the pieces of one character alone."""
    from collections import Counter

    lattice, languages, columns, number = Pieces(pieces), sorted(texts), [], {p: n for n, p in enumerate(pieces)}
    single = np.zeros(len(pieces))
    for language in languages:
        counted = Counter(w for x in texts[language] for w in words_of(x))
        words = sorted(w for w in counted if any(c.isalpha() for c in w))
        weight = np.array([counted[w] for w in words], dtype=np.float64)
        p = np.full(len(pieces), 1 / len(pieces))
        for _ in range(ROUNDS if words else 0):
            counts = lattice.expect(p, words, weight) + SMOOTH
            p = counts / counts.sum()
        columns.append(p)
        for w in words:
            for c in chr(MARK) + w:
                if c in number:
                    single[number[c]] += counted[w]
    if noise and columns:
        languages, columns = [*languages, UNKNOWN], [*columns, single / max(single.sum(), 1)]
    table = np.stack(columns, 1) if columns else np.zeros((len(pieces), 0))
    return languages, np.concatenate([table, np.zeros((1, table.shape[1]))]).astype(np.float32)


class Scorer:
    """One worker's models and its cache of words' log chances."""

    def __init__(self, languages: list[str], table: np.ndarray, path: str):
        self.languages, self.table = languages, table.astype(np.float64)
        self.pieces = Pieces(pieces_of(path))
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, len(languages)))

    def _learn(self, words: list[list[str]]) -> None:
        distinct = set().union(*words)
        if len(self.known) + len(distinct) > CACHED:
            self.known, self.rows = {}, np.zeros((0, len(self.languages)))
        new = list(distinct - self.known.keys())
        steps, held = [0], 0
        for n, w in enumerate(new):
            held += len(w) + 1
            if held > 400_000:
                steps.append(n + 1)
                held = 0
        steps.append(len(new))
        found = [self.pieces.forward(self.table, new[a:b]) for a, b in zip(steps, steps[1:], strict=False) if b > a]
        self.known.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
        self.rows = np.concatenate([self.rows, *found])

    def __call__(self, texts: list[str]) -> list[tuple[str, float]]:
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        words = [words_of(x) for x in texts]
        self._learn(words)
        out = []
        for text, own in zip(texts, words, strict=True):
            if not any(map(str.isalpha, text)):
                out.append((UNKNOWN, 0.0))
                continue
            total = self.rows[np.fromiter(map(self.known.__getitem__, own), np.int64, len(own))].sum(0)
            odds = np.exp(total - total.max())
            best = int(total.argmax())
            out.append((self.languages[best], float(odds[best] / odds.sum())))
        return out


_scorers: dict[tuple, Scorer] = {}


def _scorer(languages: list[str], table: np.ndarray, path: str) -> Scorer:
    """The worker's scorer for these models; another training replaces it."""
    key = (tuple(languages), hash(table.tobytes()), path)
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(languages, table, path)
    return _scorers[key]


def _predict(languages: list[str], table: np.ndarray, path: str, others: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(languages, table, path)
        for part in slices(batches):
            found = scorer(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=[*others, "lang_pred", "score"])

    return run


def learned(docs: DataFrame, path: str, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", folds: int = 4, held_out: int = 2, noise: bool = False) -> tuple[list[str], np.ndarray]:
    """Models of the languages that ``lang_col`` names, from a bounded sample of each language's rows outside the
    held-out fold: at most TRAIN_ROWS whole texts of at most TRAIN_CHARS characters, by a hash of id and text. The number
    of languages must be small; each is a query of its own."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("lang").isNotNull() & (F.char_length("text") <= TRAIN_CHARS) & (F.char_length("text") > 0) & (remainder("doc_id", folds) != held_out)
    )
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    texts: dict[str, list[str]] = {}
    if counts:
        # ordered by a hash of id and text: which rows are learned from is the same in every run, and no id comes before others
        deal = F.xxhash64("doc_id", "text")
        for lang in sorted(counts):
            some = rows.where(F.col("lang") == lang).orderBy(deal, "doc_id", "text").limit(TRAIN_ROWS).collect()
            texts[lang] = [r.text for r in some]
    return learn(texts, pieces_of(path), noise)


def language_id(docs: DataFrame, path: str, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row.

    The score is the posterior of the predicted language under equal priors; P(text | language) is the product of its
    words', and a word's is the sum over all its segmentations into pieces of the vocabulary at ``path``. Texts that
    are null or have no letter, and all texts where nothing could be learned, are ``und`` with score 0. The id's fold
    decides what may be learned from, nothing else; a null id counts as empty there. Rows that repeat are rows each;
    other columns than these three are not read. Map only; memory is bound by a slice, the cache and the longest text.
    """
    languages, table = learned(docs, path, lang_col, id_col, text_col, folds, held_out)
    texts = keyed_texts(docs, id_col, text_col).withColumn("held_out", remainder("doc_id", folds) == held_out)
    return texts.mapInArrow(_predict(languages, table, path, ["doc_id", "held_out"]), "doc_id long, held_out boolean, lang_pred string, score double")


def _keep(languages: list[str], table: np.ndarray, path: str, text_col: str, wanted: frozenset[str], least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(languages, table, path)
        for part in slices(batches, text_col):
            texts = [x or "" for x in part.column(text_col).to_pylist()]
            yield part.filter(pa.array([lang in wanted and score >= least for lang, score in scorer(texts)]))

    return run


def known_language(docs: DataFrame, path: str, text_col: str = "text", languages: list[str] | None = None, least: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs``, unchanged, whose language is one of ``languages`` (None: of those that were learned) with a
    posterior of at least ``least``.

    Beside the languages stands a model of no language: letters drawn one by one. A text that it explains better than
    every language's pieces do, or that no model tells from the others, goes, and so do null texts and texts without a
    letter. Where nothing could be learned whatever has a letter is kept. Rows that repeat, or have no id, are judged
    each by its text."""
    learned_languages, table = learned(docs, path, text_col=text_col, noise=True, **options)
    if not learned_languages:
        return docs.where(F.col(text_col).rlike(r"\p{L}"))
    wanted = frozenset(learned_languages if languages is None else languages) - {UNKNOWN}
    return docs.mapInArrow(_keep(learned_languages, table, path, text_col, wanted, least), docs.schema)
