"""Personal data: fixed patterns, and a character-level BiLSTM-CRF trained in numpy from labelled spans."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnflow.llm.common import keyed_texts, slices

KINDS = ["email", "ip", "card", "phone"]
TAGS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
#: Characters of a window and of the step to the next; characters kept on either side of a digit or an @.
WINDOW, STRIDE, REACH = 64, 32, 24
#: Rows from which labelled windows are drawn, and how long such a row may be.
TRAIN_ROWS, TRAIN_CHARS, TRAIN_WINDOWS = 500, 20_000, 5000
HIDDEN, EMBED, STEPS, BATCH, RATE = 24, 12, 700, 48, 0.02
#: Windows decoded at once, and the least mean marginal of a span that the model adds.
AT_ONCE, LEAST = 512, 0.9

EMAIL_RIGHT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_LEFT = re.compile(r"[A-Za-z0-9._%+-]+@")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
#: How an address is spelled out: "(at)", "[at]", " dot ".
SPELLED = re.compile(r"[(\[{]\x20?(?:at|AT)\x20?[)\]}]|\x20(?:dot|DOT)\x20")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if n % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern. A match can only start where the run of local characters before an @ starts (or
    where the last match ended), so each @ is looked at once; the pattern itself would try every start of a run."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = EMAIL_RIGHT.match(text, at) if start < at else None
        if m:
            done = m.end()
            yield start, done
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start. A digit run is only tried from its first digit: a start inside it would
    succeed or fail as the first one does."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not TRIGGER.search(text):
        return out
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


# --- characters and windows ---

PAD = 0


def _classes() -> np.ndarray:
    """Code point -> class: 1..26 letters, 27..36 digits, then signs, blanks and all else; upper case like lower."""
    table = np.full(0x110000, 63, dtype=np.uint8)
    for n in range(26):
        table[97 + n] = table[65 + n] = 1 + n
    for n in range(10):
        table[48 + n] = 27 + n
    for n, c in enumerate("@.+-_%()/:,;#*=\"' \n\t[]<>!?"):
        table[ord(c)] = 37 + min(n, 25)
    return table


CLASSES = 64
_table: list[np.ndarray] = []


def classes_of(text: str) -> np.ndarray:
    if not _table:
        _table.append(_classes())
    return _table[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]


def regions(text: str) -> list[tuple[int, int]]:
    """Where a span can be: around every digit, @ and spelled-out sign, up to the ends of the blank-delimited words
    there. A text without them has none, whatever its length."""
    places = [m.span() for m in TRIGGER.finditer(text)]
    if "dot" in text or "DOT" in text or "at" in text or "AT" in text:
        places = sorted(places + [m.span() for m in SPELLED.finditer(text)])
    out: list[list[int]] = []
    for start, end in places:
        if out and end <= out[-1][1]:
            continue
        floor = out[-1][1] if out else 0
        a, b = max(floor, start - REACH), min(len(text), end + REACH)
        while a > floor and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def windows(text: str) -> list[tuple[int, int, int, int]]:
    """(start, end, first place, place behind the last one that the window decides): overlapping windows of the regions.
    A place is decided by the window whose ends are furthest from it, so that decided places lie side by side."""
    out = []
    for a, b in regions(text):
        starts = [a] if b - a <= WINDOW else [*range(a, b - WINDOW, STRIDE), b - WINDOW]
        cuts = [a, *((s + WINDOW + t) // 2 for s, t in pairwise(starts)), b]
        out += [(s, min(s + WINDOW, b), lo, hi) for s, lo, hi in zip(starts, cuts, cuts[1:], strict=False)]
    return out


def tags_of(start: int, end: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    out = np.zeros(WINDOW, dtype=np.int64)
    for kind, a, b in spans:
        lo, hi = max(a, start), min(b, end)
        if lo < hi:
            tag = 1 + 2 * KINDS.index(kind)
            out[lo - start : hi - start] = tag + 1
            if a >= start:
                out[a - start] = tag
    return out


def batch_of(texts: list[np.ndarray], spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(classes, lengths) of the windows (text number, start, end)."""
    x = np.full((len(spans), WINDOW), PAD, dtype=np.int64)
    size = np.zeros(len(spans), dtype=np.int64)
    for n, (t, a, b) in enumerate(spans):
        x[n, : b - a] = texts[t][a:b]
        size[n] = b - a
    return x, size


# --- the model ---


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def fresh(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    n = len(TAGS)
    model = {"embed": rng.normal(0, 0.3, (CLASSES, EMBED)), "out": rng.normal(0, 0.2, (2 * HIDDEN, n)), "bias": np.zeros(n), "trans": np.zeros((n, n)), "first": np.zeros(n)}
    for d in "fb":
        model[f"w{d}"] = rng.normal(0, 0.25, (EMBED + HIDDEN, 4 * HIDDEN))
        model[f"c{d}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    # an I tag follows its own kind only
    for j, tag in enumerate(TAGS):
        if tag[0] == "I":
            model["first"][j] = -8.0
            for i, before in enumerate(TAGS):
                if before[1:] != tag[1:]:
                    model["trans"][i, j] = -8.0
    return {k: v.astype(np.float32) for k, v in model.items()}


def _lstm(x: np.ndarray, mask: np.ndarray, w: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, list]:
    n, steps, _ = x.shape
    h, s = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    inner = x.reshape(n * steps, EMBED) @ w[:EMBED] + c
    inner = inner.reshape(n, steps, 4 * HIDDEN)
    out, kept = np.empty((n, steps, HIDDEN), np.float32), []
    for t in range(steps):
        z = inner[:, t] + h @ w[EMBED:]
        g = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = g[:, :HIDDEN], g[:, HIDDEN : 2 * HIDDEN], g[:, 2 * HIDDEN :]
        u = np.tanh(z[:, 3 * HIDDEN :])
        m = mask[:, t, None]
        s_new = (f * s + i * u) * m
        th = np.tanh(s_new)
        h_new = o * th * m
        kept.append((i, f, o, u, s, th, h))
        h, s = h_new, s_new
        out[:, t] = h
    return out, kept


def _lstm_back(d_out: np.ndarray, x: np.ndarray, mask: np.ndarray, w: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, steps, _ = x.shape
    dw, dc, dx = np.zeros_like(w), np.zeros(4 * HIDDEN, np.float32), np.zeros_like(x)
    dh, ds = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        i, f, o, u, s, th, h = kept[t]
        m = mask[:, t, None]
        dh = (dh + d_out[:, t]) * m
        ds = (ds + dh * o * (1 - th * th)) * m
        dz = np.concatenate([ds * u * i * (1 - i), ds * s * f * (1 - f), dh * th * o * (1 - o), ds * i * (1 - u * u)], 1)
        dw[:EMBED] += x[:, t].T @ dz
        dw[EMBED:] += h.T @ dz
        dc += dz.sum(0)
        dx[:, t] = dz @ w[:EMBED].T
        dh, ds = dz @ w[EMBED:].T, ds * f
    return dw, dc, dx


def _reverse(x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Each row's first ``size`` steps in reverse order."""
    at = np.arange(x.shape[1])[None]
    at = np.where(at < size[:, None], size[:, None] - 1 - at, at)
    return np.take_along_axis(x, at.reshape(at.shape + (1,) * (x.ndim - 2)), 1)


def emissions(model: dict, x: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, tuple]:
    mask = (np.arange(x.shape[1])[None] < size[:, None]).astype(np.float32)
    e = model["embed"][x]
    back = _reverse(e, size)
    hf, kf = _lstm(e, mask, model["wf"], model["cf"])
    hb, kb = _lstm(back, mask, model["wb"], model["cb"])
    h = np.concatenate([hf, _reverse(hb, size)], 2)
    return h @ model["out"] + model["bias"], (mask, e, back, kf, kb, h)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def marginals(model: dict, em: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of each tag, expected transitions, log of the partition sum) by the forward-backward recursion."""
    n, steps, k = em.shape
    trans = model["trans"]
    alpha, beta = np.zeros((n, steps, k), np.float32), np.zeros((n, steps, k), np.float32)
    alpha[:, 0] = model["first"] + em[:, 0]
    live = np.arange(steps)[None] < size[:, None]
    for t in range(1, steps):
        alpha[:, t] = np.where(live[:, t, None], _logsum(alpha[:, t - 1, :, None] + trans[None], 1) + em[:, t], alpha[:, t - 1])
    z = _logsum(alpha[:, -1], 1)
    pairs = np.zeros((k, k))
    for t in range(steps - 2, -1, -1):
        nxt = em[:, t + 1] + beta[:, t + 1]
        joint = trans[None] + nxt[:, None]
        beta[:, t] = np.where(live[:, t + 1, None], _logsum(joint, 2), 0)
        pairs += (np.exp(alpha[:, t, :, None] + joint - z[:, None, None]) * live[:, t + 1, None, None]).sum(0)
    return np.exp(alpha + beta - z[:, None, None]) * live[:, :, None], pairs, z


def gradients(model: dict, x: np.ndarray, size: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
    """(mean negative log-likelihood of the tag sequences, its gradients)."""
    em, (mask, e, back, kf, kb, h) = emissions(model, x, size)
    post, pairs, z = marginals(model, em, size)
    n, steps, k = em.shape
    gold = np.eye(k, dtype=np.float32)[tags] * mask[:, :, None]
    steps_live = mask[:, 1:].astype(bool)
    score = (em * gold).sum((1, 2)) + model["first"][tags[:, 0]] + (model["trans"][tags[:, :-1], tags[:, 1:]] * steps_live).sum(1)
    gold_pairs = np.zeros((k, k))
    np.add.at(gold_pairs, (tags[:, :-1][steps_live], tags[:, 1:][steps_live]), 1)
    d_em = ((post - gold) / n).astype(np.float32)
    g = {"trans": (pairs - gold_pairs) / n, "first": (post[:, 0] - gold[:, 0]).sum(0) / n, "bias": d_em.sum((0, 1)), "out": h.reshape(-1, 2 * HIDDEN).T @ d_em.reshape(-1, k)}
    dh = d_em @ model["out"].T
    g["wf"], g["cf"], dx_f = _lstm_back(dh[:, :, :HIDDEN], e, mask, model["wf"], kf)
    g["wb"], g["cb"], dx_b = _lstm_back(_reverse(dh[:, :, HIDDEN:], size), back, mask, model["wb"], kb)
    g["embed"] = np.zeros_like(model["embed"])
    np.add.at(g["embed"], x, dx_f + _reverse(dx_b, size))
    return float((z - score).mean()), g


def train(x: np.ndarray, size: np.ndarray, tags: np.ndarray, steps: int = STEPS, seed: int = 11) -> dict[str, np.ndarray]:
    """Adam over minibatches; deterministic for the same windows in the same order."""
    model, rng = fresh(), np.random.default_rng(seed)
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    for step in range(1, steps + 1):
        take = rng.integers(0, len(x), BATCH)
        _, g = gradients(model, x[take], size[take], tags[take])
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, v in model.items():
            d = np.clip(g[k], -1, 1).astype(np.float32)
            first[k] = 0.9 * first[k] + 0.1 * d
            second[k] = 0.999 * second[k] + 0.001 * d * d
            v -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def invented(count: int = 900, seed: int = 5) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Labelled texts of invented words, data of each kind, and numbers that are none: they stand beside the sample, so
    that a corpus without personal data trains too. Half of the data is written as no fixed pattern has it: numbers
    without a plus, with other separators, addresses whose signs are spelled out."""
    rng = np.random.default_rng(seed)
    pick = lambda *x: x[rng.integers(len(x))]
    word = lambda: "".join(rng.choice(list("abcdefghiklmnoprstuvw"), rng.integers(2, 9)))
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))

    def card() -> str:
        body = pick(digits(15), digits(15), digits(1) + digits(1) * 14)
        whole_number = next(body + str(d) for d in range(10) if luhn(body + str(d)))
        return pick("", "", " ", "-", ".", "/", "_").join(whole_number[k : k + 4] for k in range(0, 16, 4))

    def email() -> str:
        name, host = word() + pick("", f"{pick('.', '_', '')}{pick(digits(2), word())}"), word() + pick("", "3")
        at, dot = pick(("@", "."), ("@", "."), (" (at) ", "."), ("(at)", "."), (" [at] ", "."), (" [at] ", " dot "), (" (at) ", " dot "), (" @ ", "."))
        return f"{name}{at}{host}{dot}{pick('com', 'org', 'net', f'example{dot}com')}"

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return pick(f"+{rng.integers(1, 99)} ({a}) {b}-{c}", f"+{rng.integers(1, 99)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{rng.integers(1, 99)} {a} {b} {c}", f"1-{a}-{b}-{c}")

    def none() -> str:
        two = lambda: f"{rng.integers(1, 13):02d}"
        return pick(
            f"{rng.integers(0, 20)}.{rng.integers(0, 20)}", digits(rng.integers(1, 8)), digits(rng.integers(9, 22)), "".join(rng.choice(list("0123456789abcdef"), rng.integers(6, 41))), f"20{two()}-{two()}-{two()}",
            f"{two()}/{two()}/20{two()}", f"{two()}:{two()}:{two()}", f"{digits(2)},{digits(3)}", f"{rng.integers(1, 9)}.{rng.integers(1, 9)}.{rng.integers(1, 9)}", f"{digits(3)}-{digits(3)}", f"{word()} at {word()}", f"(at {word()})",
            f"{digits(4)} {digits(2)} {digits(3)}", f"{rng.integers(256, 999)}.{rng.integers(256, 999)}.{digits(2)}.{digits(1)}", f"{digits(2)}-{digits(5)}-{digits(2)}", f"{word()}{digits(3)}", f"#{digits(6)}", f"{digits(3)} {digits(3)} {digits(3)} {digits(3)} {digits(3)}",
        )

    out = []
    for _ in range(count):
        text, spans = "", []
        for _ in range(rng.integers(2, 6)):
            text += " ".join(word() for _ in range(rng.integers(1, 6))) + " "
            what = rng.integers(0, 8)
            kind = ("card", "ip", "email", "phone", "", "", "", "")[what]
            if kind == "ip":
                item = pick(".", ".", "[.]", " . ").join(str(rng.integers(0, 256)) for _ in range(4))
            else:
                item = {"card": card, "email": email, "phone": phone, "": none}[kind]()
            if kind:
                spans.append((kind, len(text), len(text) + len(item)))
            text += item + str(rng.choice([" ", ", ", ". "]))
        out.append((text + word(), spans))
    return out


def fit(texts: list[str], most: int = TRAIN_WINDOWS) -> dict[str, np.ndarray]:
    """The model from windows of the texts, labelled by the fixed patterns, and of the invented ones."""
    labelled = [(t, base_spans(t)) for t in texts] + invented()
    codes = [classes_of(t) for t, _ in labelled]
    spans = [(n, a, b) for n, (t, _) in enumerate(labelled) for a, b, _, _ in windows(t)]
    rng = np.random.default_rng(3)
    spans = [spans[k] for k in sorted(rng.permutation(len(spans))[:most])]
    x, size = batch_of(codes, spans)
    tags = np.stack([tags_of(a, b, labelled[n][1]) for n, a, b in spans])
    return train(x, size, tags)


def viterbi(model: dict, em: np.ndarray, size: np.ndarray) -> np.ndarray:
    n, steps, k = em.shape
    score = model["first"] + em[:, 0]
    back = np.zeros((n, steps, k), np.int64)
    for t in range(1, steps):
        all_ = score[:, :, None] + model["trans"][None]
        best = all_.argmax(1)
        live = (t < size)[:, None]
        back[:, t] = np.where(live, best, np.arange(k)[None])
        score = np.where(live, all_.max(1) + em[:, t], score)
    out = np.zeros((n, steps), np.int64)
    out[:, -1] = score.argmax(1)
    for t in range(steps - 1, 0, -1):
        out[:, t - 1] = np.take_along_axis(back[:, t], out[:, t, None], 1)[:, 0]
    return out


def decoded(model: dict, texts: list[str]) -> list[list[tuple[float, str, int, int]]]:
    """For each text (mean marginal, kind, start, end) of every span of its tags. Each window's best tag sequence decides
    the places in its middle; what they decide is laid end to end, so a span may run through any number of windows."""
    codes = {n: classes_of(t) for n, t in enumerate(texts) if TRIGGER.search(t) or SPELLED.search(t)}
    todo = [(n, *w) for n in codes for w in windows(texts[n])]
    out: list[list[tuple[float, str, int, int]]] = [[] for _ in texts]
    # the span that is open: text, kind, start, marginals
    open_span: tuple[int, int, int, list[float]] | None = None
    behind = (-1, -1)

    def close(end: int) -> None:
        nonlocal open_span
        if open_span:
            n, kind, start, sure = open_span
            out[n].append((sum(sure) / len(sure), KINDS[kind], start, end))
            open_span = None

    for k in range(0, len(todo), AT_ONCE):
        part = todo[k : k + AT_ONCE]
        x, size = batch_of(codes, [(n, a, b) for n, a, b, _, _ in part])
        em, _ = emissions(model, x, size)
        post, _, _ = marginals(model, em, size)
        best = viterbi(model, em, size)
        sure = np.take_along_axis(post, best[:, :, None], 2)[:, :, 0]
        busy = (best > 0).any(1).tolist()
        for r, (n, a, _, lo, hi) in enumerate(part):
            if behind != (n, lo):
                close(behind[1])
            behind = n, hi
            if not busy[r]:
                close(lo)
                continue
            tags, chances = best[r, lo - a : hi - a].tolist(), sure[r, lo - a : hi - a].tolist()
            for at, (tag, chance) in enumerate(zip(tags, chances, strict=True), lo):
                if open_span and tag == 2 + 2 * open_span[1]:
                    open_span[3].append(chance)
                    continue
                close(at)
                if tag:
                    open_span = n, (tag - 1) // 2, at, [chance]
    close(behind[1])
    return out


def whole(kind: str, text: str) -> bool:
    """What a span of that kind must hold, whoever found it."""
    digits = "".join(c for c in text if c in "0123456789")
    if text != text.strip() or "\n" in text:
        return False
    if kind == "email":
        host = re.split(r"@|[(\[{]\s?at\s?[)\]}]", text, flags=re.IGNORECASE)
        return len(host) == 2 and bool(host[0].strip()) and bool(re.search(r"[A-Za-z0-9](?:\.|\sdot\s)[A-Za-z]", host[1], re.IGNORECASE))
    if kind == "ip":
        parts = re.split(r"[^0-9]+", text)
        return len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return (8 if "+" in text else 10) <= len(digits) <= 15


def reconciled(text: str, base: list[tuple[str, int, int]], found: list[tuple[float, str, int, int]], least: float = LEAST) -> list[tuple[str, int, int]]:
    """All spans of a text, by kind, then start: base ones stay; of the model's spans the surest that overlap neither
    a base span nor a surer one are added (ties: the longer, then the earlier)."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b in sorted((a, b) for _, a, b in base):  # disjoint runs of base spans
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    out = list(base)
    for sure, kind, a, b in sorted(set(found), key=lambda x: (-x[0], x[2] - x[3], x[2], x[1])):
        if sure >= least and whole(kind, text[a:b]):
            n = bisect_left(starts, b)
            if not n or ends[n - 1] <= a:
                starts.insert(n, a)
                ends.insert(n, b)
                out.append((kind, a, b))
    return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            rows = []
            for text, found in zip(texts, decoded(model, texts), strict=True):
                base = base_spans(text)
                n = Counter(k for k, _, _ in base)
                rows.append((*(n[k] for k in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(reconciled(text, base, found))))
            cols = list(zip(*rows, strict=True))
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:4]), *(pa.array(c, pa.string()) for c in cols[4:])], names=names)

    return run


def training_texts(texts: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> list[str]:
    """At most ``rows`` whole texts of at most ``chars`` characters that have a digit or an @, by a hash of id and
    text."""
    fit_for = texts.where((F.char_length("text") <= chars) & F.col("text").rlike("[0-9@]"))
    # ordered by a hash of id and text, so the same rows are learned from in every run
    some = fit_for.select("doc_id", "text").orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text").limit(rows).collect()
    return [r.text for r in some]


def pii_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row; offsets are code points, ends exclusive.

    The fixed patterns run over whole texts. The model is trained on the driver from a bounded sample whose spans the
    patterns label, and from invented texts half of whose data no pattern has; it then reads every region around a
    digit, an @ or a spelled-out sign in overlapping windows, whose tags are joined, and ``reconciled`` settles the
    spans over the whole text. Map only: each row stands by itself, also where an id repeats or is missing; null texts
    count as empty; a very long text costs time in proportion to its length. Other columns are not read.
    """
    texts = keyed_texts(docs, id_col, text_col)
    model = fit(training_texts(texts))
    names = "".join(f"n_{k} long, " for k in KINDS)
    return texts.mapInArrow(_scan(model), f"doc_id long, {names}base_sha256 string, spans string")
