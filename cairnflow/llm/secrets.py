"""Secret scanning by assignment-aware lexing, beside fixed patterns."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, pairwise

import pyarrow as pa
from pyspark.sql import DataFrame

from cairnflow.llm.common import keyed_texts, slices

KINDS = ["assign", "access", "hex", "literal"]
LEAST = {"assign": 8, "access": 16, "hex": 32}
BASE = {
    "assign": re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    # a run of 32 or more is the whole match of [0-9a-f]+ there, and shorter matches are dropped
    "hex": re.compile(r"[0-9a-f]{32,}"),
}

# Weights of the words of a target name.
NAME_WORDS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.8, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9,
    "credentials": 0.9, "bearer": 0.8, "auth": 0.6, "authorization": 0.8, "signature": 0.5, "salt": 0.5, "private": 0.5, "key": 0.5, "access": 0.3,
    "api": 0.3, "client": 0.1, "master": 0.3, "encryption": 0.3, "signing": 0.3, "session": 0.2, "cookie": 0.4, "connection": 0.2, "dsn": 0.5,
}
# Words that say that a name holds something about a secret, not the secret.
NAME_OTHER = {"length", "len", "size", "count", "max", "min", "limit", "id", "type", "name", "file", "path", "url", "uri", "hint", "expiry", "expires", "ttl", "public", "field", "label", "policy", "version", "tokenizer", "tokens"}
PLACEHOLDER = re.compile(r"(?i)^(?:changeme|change_me|example|sample|dummy|test|none|null|nil|true|false|undefined|todo|redacted|x{3,}|\*+|\.+|-+|your[_-].*|<.*>|\$\{.*\}|\$\w+|%\w+%|\{\{.*\}\})$")

# A quote after a backslash opens nothing: an opening that fails then has none behind it on its line, and lexing stays linear.
LEXEME = re.compile(
    r"""(?P<string>\"\"\"[\s\S]*?\"\"\"|\'\'\'[\s\S]*?\'\'\'|(?<!\\)"(?:[^"\\\n]|\\.)*"|(?<!\\)'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)|(?P<name>[A-Za-z_$@][\w$]*(?:[.-][A-Za-z_][\w$]*)*)|(?P<join>(?:\+|\.\.)(?=["'`\s]))|(?P<bare>[A-Za-z0-9+/_~!@#$%^&*?.-]+)|(?P<give>:=|=>|[=:])|(?P<line>\n)|(?P<more>\\(?=\n))|(?P<close>[\])])|(?P<open>\()|(?P<end>[;,{}\[<>])|(?P<other>[^\s])""",
    re.ASCII,
)
GIVES = re.compile(r"[^\n]*[:=][^\n]*")
RUN = re.compile(r"[^\s,;\"'`<>(){}\[\]]+")
#: A type between a name's colon and its sign, and the head of a block scalar.
TYPE = re.compile(r"[\x20\t]*[A-Za-z_][\w.]*(?:\[(?:[^\[\]\n=]|\[[^\[\]\n=]*\])*\])?(?:[\x20\t]*\|[\x20\t]*[A-Za-z_][\w.]*)*[\x20\t]*=(?![=>])", re.ASCII)
BLOCK = re.compile(r"[\x20\t]*[|>][+-]?[0-9]?[\x20\t]*\n")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, leftmost and non-overlapping for each kind; short matches are dropped."""
    out = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text):
            if len(m[m.lastindex or 0]) >= LEAST[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def name_weight(name: str) -> float:
    """How likely the target of that name holds a secret, from 0 to 1, by its words."""
    words = [w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", name)]
    if not words or words[-1] in NAME_OTHER:
        return 0.0
    joined = {a + b for a, b in pairwise(words)}
    return min(1.0, sum(NAME_WORDS.get(w, 0.0) for w in {*words, *joined}))


#: Characters of a folded literal's two ends that are kept as they are; the rest is known by its counts.
ENDS = 32


class Literal:
    """A folded literal: a span of the text, or literals joined in order. Nothing is copied when one is folded into
    another, so that constants built from constants stay as small as the text that says so."""

    __slots__ = ("known", "parts", "span", "told")

    def __init__(self, span: tuple[int, int] | None = None, parts: tuple[Literal, ...] = ()):
        self.span, self.parts, self.known, self.told = span, parts, None, False

    def summary(self, text: str) -> tuple[int, Counter, str, str]:
        """(length, count of each character, first and last ENDS characters), from the parts' own; no recursion."""
        todo = [self]
        while todo:
            node = todo[-1]
            if node.known is None and node.span:
                own = text[node.span[0] : node.span[1]]
                node.known = len(own), Counter(own), own[:ENDS], own[-ENDS:]
            if node.known is None:
                open_parts = [x for x in node.parts if x.known is None]
                todo += open_parts
                if not open_parts:
                    size, counts, first, last = 0, Counter(), "", ""
                    for n, c, head, tail in (x.known for x in node.parts):
                        size, first, last = size + n, (first + head)[:ENDS] if len(first) == size else first, (last + tail)[-ENDS:]
                        counts += c
                    node.known = size, counts, first, last
            else:
                todo.pop()
        return self.known

    def spans(self) -> Iterator[tuple[int, int]]:
        """The spans it is made of, each part of the text's literals once however often it is asked for."""
        todo = [self]
        while todo:
            node = todo.pop()
            if not node.told:
                node.told = True
                todo += node.parts
                if node.span and node.span[0] < node.span[1]:
                    yield node.span


def strength(size: int, counts: Counter, first: str, last: str) -> float:
    """How much a literal looks like key material, from 0 to 1: its length, its entropy and its kinds of characters.

    A placeholder is told by its ends and by which characters are between them."""
    if size < 6 or any(map(str.isspace, counts)):
        return 0.0
    if size <= ENDS:
        shape = first
    else:
        last = last[max(0, 2 * ENDS - size) :]
        shape = first + "".join(sorted(counts - Counter(first + last))) + last
    if PLACEHOLDER.match(shape):
        return 0.0
    entropy = -sum(c / size * math.log2(c / size) for c in counts.values())
    kinds = sum(any(map(f, counts)) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return min(1.0, 0.3 * min(1, size / 16) + 0.4 * min(1, entropy / 3.5) + 0.1 * kinds)


def literal_strength(text: str) -> float:
    return strength(len(text), Counter(text), text[:ENDS], text[-ENDS:])


class Lexed:
    """The lexemes of a text from a place on, read as they are asked for: (kind, word, start, end); None at the end."""

    def __init__(self, text: str, start: int):
        self.read, self.held = LEXEME.finditer(text, start), []

    def __call__(self, k: int) -> tuple[str, str, int, int] | None:
        while len(self.held) <= k:
            m = next(self.read, None)
            self.held.append(m and (m.lastgroup, m.group(), m.start(), m.end()))
            if m is None:
                break
        return self.held[k] if k < len(self.held) else None

    def kind(self, k: int) -> str:
        found = self(k)
        return found[0] if found else ""

    def after(self, k: int, place: int) -> int:
        """The first lexeme from ``k`` on that starts at ``place`` or behind it."""
        while (found := self(k)) and found[2] < place:
            k += 1
        return k


def _quoted(lexeme: tuple[str, str, int, int]) -> Literal:
    n = 3 if lexeme[1][:3] in ('"""', "'''") and len(lexeme[1]) >= 6 else 1
    return Literal((lexeme[2] + n, lexeme[3] - n))


def _target(lexed: Lexed, k: int) -> int | None:
    """The place of the sign if a target stands at ``k``: a name, a quoted key, or a quoted key in brackets."""
    if lexed.kind(k) not in ("name", "string"):
        return None
    k += 1 + (lexed.kind(k) == "string" and lexed.kind(k + 1) == "close")
    return k if lexed.kind(k) == "give" else None


def _block(text: str, line: int, start: int) -> tuple[list[Literal], int]:
    """(the lines of a block scalar, one literal each; where it ends): lines that are indented further than its key's."""
    own = len(text[line:start]) - len(text[line:start].lstrip(" \t-"))
    out = []
    while start < len(text):
        end = text.find("\n", start)
        end = len(text) if end < 0 else end
        row = text[start:end]
        bare = row.strip()
        if bare and len(row) - len(row.lstrip()) <= own:
            break
        if bare:
            at = start + row.index(bare)
            out.append(Literal((at, at + len(bare))))
        start = end + 1
    return out, min(start, len(text))


def _value(text: str, lexed: Lexed, k: int, known: dict[str, Literal]) -> tuple[Literal | None, int]:
    """(the folded literal that starts at ``k``, the lexeme behind it).

    It may start on the next line; inside brackets, behind a join and behind a closing backslash it goes on over line
    ends. Strings side by side fold too."""
    depth, parts, joined = 0, [], True
    while lexed.kind(k) == "line":
        k += 1
    while True:
        found = lexed(k)
        kind = found[0] if found else ""
        if kind == "open" and not parts:
            depth, k = depth + 1, k + 1
        elif kind == "line" and (depth or joined and parts) or kind == "more":
            k += 1 + (kind == "more" and lexed.kind(k + 1) == "line")
        elif kind == "string" and (joined or parts) and _target(lexed, k) is None:
            parts.append(_quoted(found))
            joined, k = False, k + 1
        elif kind == "name" and joined and found[1] in known and _target(lexed, k) is None:
            parts.append(known[found[1]])
            joined, k = False, k + 1
        elif kind == "join" and parts and not joined:
            joined, k = True, k + 1
        elif kind in ("name", "bare", "other", "join") and not parts and not depth and _target(lexed, k) is None:
            run = RUN.match(text, found[2])
            if run is None:
                return None, k
            return Literal(run.span()), lexed.after(k, run.end())
        else:
            break
    if not parts:
        return None, k
    return parts[0] if len(parts) == 1 else Literal(parts=tuple(parts)), k


def pairs(text: str) -> Iterator[tuple[str, Literal]]:
    """(target name, folded literal) of each assignment.

    The lexer reads from each line that has a sign: strings (also of three quotes), names, bare words, the assigning
    signs = : := => and joins. A name before a sign is a target, also with a type between; a quoted key is one too,
    also in brackets. Literals that are joined fold into one; a name on the right stands for the literal that was last
    assigned to it (constants are propagated through any number of names). Each line of a block scalar is a literal.
    A value that goes on over line ends is read once.
    """
    known: dict[str, Literal] = {}
    at = 0
    while line := GIVES.search(text, at):
        lexed, k, at = Lexed(text, max(at, line.start())), 0, line.end()
        while (found := lexed(k)) and found[2] < at:
            sign = _target(lexed, k)
            if sign is None:
                k += 1
                continue
            target, place = found[1].strip("\"'`"), lexed(sign)[3]
            if lexed(sign)[1] == ":" and (block := BLOCK.match(text, place)):
                literals, at = _block(text, line.start(), block.end())
                for literal in literals:
                    yield target, literal
                break
            if lexed(sign)[1] == ":" and found[0] == "name" and (typed := TYPE.match(text, place)):
                literal, k = _value(text, lexed, lexed.after(sign + 1, typed.end()), known)
            else:
                literal, k = _value(text, lexed, sign + 1, known)
            if literal:
                at = max(at, lexed(k - 1)[3])
                known[target] = literal
                yield target, literal


def lexed_spans(text: str, least: float = 0.6) -> list[tuple[str, int, int]]:
    """Spans of the literals whose target's weight times their own strength is at least ``least``."""
    out: list[tuple[str, int, int]] = []
    weights: dict[str, float] = {}
    for target, literal in pairs(text):
        weight = weights[target] if target in weights else weights.setdefault(target, name_weight(target))
        if weight >= least and weight * strength(*literal.summary(text)) >= least:
            out += [("literal", a, b) for a, b in literal.spans()]
    return out


def secret_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), by start, then kind. A lexed literal inside a base span adds nothing and is left out."""
    order = {k: n for n, k in enumerate(KINDS)}
    base = sorted(base_spans(text), key=lambda x: (x[1], order[x[0]]))
    more = lexed_spans(text) if ":" in text or "=" in text else []
    starts, ends = [a for _, a, _ in base], list(accumulate((b for _, _, b in base), max))
    more = [x for x in more if not (n := bisect_right(starts, x[1])) or ends[n - 1] < x[2]]
    return base, sorted(base + more, key=lambda x: (x[1], order[x[0]], x[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """The text with every maximal run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        rows = []
        for text in part.column("text").to_pylist():
            base, spans = secret_spans(text)
            n = Counter(k for k, _, _ in base)
            rows.append((n["assign"], n["access"], n["hex"], hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
        cols = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string())],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row; offsets are code points, ends exclusive.

    Map only, whole texts, a null text counts as empty (no spans, the digest of nothing). Each row stands by itself, so
    rows that repeat, or have no id, get a row each; a very long text costs time and memory in proportion to its length.
    Only the id and the text are read, whatever other columns there are.
    """
    return keyed_texts(docs, id_col, text_col).mapInArrow(_scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def _redact(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            at = part.schema.get_field_index(text_col)
            texts = [x if x is None else redacted(x, secret_spans(x)[1]) for x in part.column(at).to_pylist()]
            columns = part.columns
            columns[at] = pa.array(texts, part.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return run


def redact_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the spans of ``secret_spans`` replaced by a mark; all rows and columns stay, null texts too."""
    return docs.mapInArrow(_redact(text_col), docs.schema)
