"""Secret scan by assignment-aware lexing.

Three fixed patterns (the base) are always reported. On top of them, source and configuration syntax is lexed into
name-literal pairs (`name = "x"`, `name: x`, `"name": "x"`, `name := x`, `name => x`, `export NAME=x`, `const a = "x"`,
`map["name"] = "x"`). A literal is a string in one of three quotes or in triple quotes, a bare value, the indented block
behind a YAML `name: |`, or a here-document; adjacent and added string literals count as one. Comments are lexed like
code, since a key that was commented out is still a key. Names that are assigned another name take over its literal, also
one that is assigned further down, so a constant that reaches a sensitive name is found where it was written. A literal
is reported with kind `named` if the score of the names that it reaches and of its own looks is high enough and no base
span covers it.

Null and empty texts have no spans. Whole texts are scanned: names, blanks and literals of any length, in time linear in
the text's length but for a sort of the spans and blocks nested in blocks.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import pick

# The base patterns of the contract, least lengths and the kinds' order.
ASSIGN = re.compile(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGN = 8
KINDS = ("assign", "access", "hex", "named")
WORDS_OF_ASSIGN = ("password", "passwd", "secret", "token", "api")

# Parts of names that hold secrets, by weight, and parts that tell they don't.
SENSITIVE = {"password": 3, "passwd": 3, "passphrase": 3, "pwd": 3, "pass": 2, "secret": 3, "token": 3, "apikey": 3, "credential": 3, "credentials": 3, "auth": 2, "authorization": 2, "bearer": 2, "private": 1, "access": 1, "signing": 1, "encryption": 1, "client": 1, "api": 1, "key": 2, "salt": 2, "dsn": 2, "cookie": 1, "session": 1}
HARMLESS = {"public": -3, "name": -2, "url": -2, "uri": -2, "path": -2, "file": -2, "type": -2, "length": -3, "size": -3, "count": -3, "field": -2, "label": -2, "hint": -2, "id": -1, "header": -2, "primary": -2, "foreign": -2, "keyboard": -3}
PLACEHOLDER = re.compile(r"(?i)change.?me|example|placeholder|your[_-]|<[^<>]*>|\$\{|\{\{|%\(|x{4,}|\*{3,}|\.{3,}|^(?:true|false|none|null|undefined|todo)$")

NAME = r"(?<![\w.$\-])(?P<name>[A-Za-z_$][\w$.\-]*+)(?P<close>[\"'\]]{0,2})[\x20\t]*+(?::=|=>|=(?!=)|:(?![:/]))[\x20\t]*+"
PAIR = re.compile(NAME + r"""(?:(?P<literal>\"{3}|'{3}|["'`])|(?P<block>[|>][+\-]?\n)|(?:\$\(cat[\x20]++)?<<[~\-]?["']?(?P<here>\w++)|(?P<bare>[\w+/.=$\-]++))""")
STRING = {q: re.compile(rf"{q}((?:[^{q}\\\n]|\\.)*+){q}") for q in "\"'`"}
MORE = re.compile(r"[\x20\t]*+\+?[\x20\t]*+(?=[\"'`])")
BLOCK_LINE = re.compile(r"([\x20\t]*+)([^\n]*+)(?:\n|\Z)")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
LEAST_SCORE = 6.0
LEAST_NAMED = 8


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, by start, then kind."""
    found = []
    low = text.lower()
    if any(w in low for w in WORDS_OF_ASSIGN):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


Found = tuple[str, str, int, int, bool]


class Lexer:
    """Name-literal pairs of one text. What closes no literal behind one place closes none behind a later one, so the
    search for it is given up once; inside a literal of several lines no other one begins."""

    def __init__(self, text: str):
        self.text = text
        self.missing: set[str] = set()
        self.inside = 0  # the end of the last literal of several lines

    def end_of(self, mark: str, start: int) -> int:
        end = -1 if mark in self.missing else self.text.find(mark, start)
        if end < 0:
            self.missing.add(mark)
        return end

    def quoted(self, quote: str, start: int) -> tuple[str, int, int] | None:
        """Value, start and end of a string, adjacent or added ones included."""
        if len(quote) == 3:
            end = self.end_of(quote, start + 3) if start >= self.inside else -1
            self.inside = max(self.inside, end)
            return (self.text[start + 3 : end], start + 3, end) if end >= 0 else None
        s = STRING[quote].match(self.text, start)
        if not s:
            return None
        parts, end = [s[1]], s.end(1)
        while (more := MORE.match(self.text, s.end())) and (s := STRING[self.text[more.end()]].match(self.text, more.end())):
            parts.append(s[1])
            end = s.end(1)
        return "".join(parts), start + 1, end

    def block(self, name_at: int, start: int) -> tuple[str, int, int] | None:
        """The lines behind a YAML block mark that are indented more than the name's line."""
        line = self.text.rfind("\n", 0, name_at) + 1
        least, lines, at, end, first = len(BLOCK_LINE.match(self.text, line)[1]), [], start, start, start
        while at < len(self.text) and (m := BLOCK_LINE.match(self.text, at)):
            if m[2] and len(m[1]) <= least:
                break
            if m[2]:
                first = first if lines else m.start(2)
                end = m.end(2)
                lines.append(m[2])
            at = m.end()
        return ("".join(lines), first, end) if lines else None

    def here(self, word: str, start: int) -> tuple[str, int, int] | None:
        """The lines of a here-document up to its word."""
        line = self.text.find("\n", start) + 1 if start >= self.inside else 0
        end = self.end_of(f"\n{word}", line - 1) if line else -1
        if end <= line:
            return None
        self.inside = end
        return self.text[line:end], line, end

    def pairs(self) -> Iterator[Found]:
        """Name, value, the value's start and end, and whether it's quoted."""
        if "=" not in self.text and ":" not in self.text:
            return
        for m in PAIR.finditer(self.text):
            if m["literal"]:
                found = self.quoted(m["literal"], m.start("literal"))
            elif m["block"]:
                found = self.block(m.start(), m.end())
            elif m["here"]:
                found = self.here(m["here"], m.end())
            else:
                value = m["bare"].rstrip(".")
                yield m["name"], value, m.start("bare"), m.start("bare") + len(value), False
                continue
            if found:
                yield m["name"], *found, True


def name_score(name: str) -> int:
    parts = [p.lower() for p in PART.findall(name)]
    parts = [p for p in parts if p not in ("my", "the", "default")]
    return sum(SENSITIVE.get(p, 0) + HARMLESS.get(p, 0) for p in parts)


def literal_score(value: str) -> float:
    """How much it looks like a random key: length, entropy, mixed classes; placeholders and prose lose."""
    if len(value) < LEAST_NAMED or PLACEHOLDER.search(value):
        return -9.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit)) + any(not c.isalnum() for c in value)
    return min(n, 32) / 16 + entropy / 2 + 0.5 * (classes - 1) - 2.0 * (value.count(" ") > 1) - 1.5 * value.isalpha() * value.islower()


def roots(source: list[int]) -> list[int]:
    """Where each chain of references ends; one that runs in a circle ends at the place where it is entered."""
    root = [-1] * len(source)
    for k in range(len(source)):
        path, met, x = [], set(), k
        while root[x] < 0 and x not in met:
            met.add(x)
            path.append(x)
            x = source[x]
        end = root[x] if root[x] >= 0 else x
        for p in path:
            root[p] = end
    return root


def named_spans(text: str) -> list[tuple[int, int]]:
    """Literals that reach a sensitive name, directly or by way of other names."""
    key = lambda name: name.rsplit(".", 1)[-1]
    holds: dict[str, int] = {}  # by name, the pair that it was last assigned
    waiting: dict[str, list[int]] = {}  # pairs whose value is a name that isn't assigned yet
    literals: list[tuple[str, int, int]] = []
    source: list[int] = []  # by pair, the pair whose literal it takes over, or itself
    weights: list[int] = []
    for k, (name, value, start, end, quoted) in enumerate(Lexer(text).pairs()):
        literals.append((value, start, end))
        weights.append(name_score(name))
        source.append(k if quoted else holds.get(key(value), k))
        if not quoted and source[k] == k:
            waiting.setdefault(key(value), []).append(k)
        for w in waiting.pop(key(name), ()):
            source[w] = k
        holds[key(name)] = k
    reached: dict[int, int] = {}
    for root, weight in zip(roots(source), weights):
        reached[root] = max(reached.get(root, weight), weight)
    return sorted({literals[k][1:] for k, weight in reached.items() if weight >= 2 and weight + literal_score(literals[k][0]) >= LEAST_SCORE})


def spans(text: str | None) -> list[tuple[int, int, int]]:
    """All spans: (start, kind, end) by start, then kind."""
    if not text:
        return []
    base = base_spans(text)
    named = named_spans(text)
    if named and base:
        starts, ends = [s for s, _, _ in base], list(accumulate((e for _, _, e in base), max))
        named = [(a, b) for a, b in named if not ((k := bisect_right(starts, a)) and b <= ends[k - 1])]
    return sorted(base + [(a, 3, b) for a, b in named])


def shown(found: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for a, k, b in found])


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Null and empty texts: no spans, the digest of the empty string. Repeated rows and null ids are kept; ties don't
    arise; an empty table gives none; other columns are ignored.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans(t.as_py()) for t in batch.column(1)]
            counts = [pa.array([sum(1 for s in f if s[1] == k) for f in found], pa.int64()) for k in range(3)]
            base = [hashlib.sha256(shown([s for s in f if s[1] < 3]).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(base, pa.string()), pa.array(map(shown, found), pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return pick(df, doc_id=id_col, text=text_col).mapInArrow(run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every secret replaced; of an assignment only the value. None stays None."""
    if not text:
        return text
    cuts: list[list[int]] = []
    for start, kind, end in spans(text):
        start = ASSIGN.match(text, start).start(2) if kind == 0 else start
        if cuts and start < cuts[-1][1]:
            cuts[-1][1] = max(cuts[-1][1], end)
        else:
            cuts.append([start, end])
    out, last = [], 0
    for a, b in sorted(cuts):
        out += [text[last:a], mark]
        last = b
    return "".join([*out, text[last:]])


def redact(df: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns, with secrets in the text replaced and, if there, its length column made to fit."""
    at, size = df.columns.index(text_col), df.columns.index(length_col) if length_col in df.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, columns = [redacted(t.as_py(), mark) for t in batch.column(at)], list(batch.columns)
            if size is not None:
                was = batch.column(at).to_pylist()
                columns[size] = pa.array([n if a == b else len(b) for n, a, b in zip(batch.column(size).to_pylist(), was, texts)], batch.schema.field(size).type)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return df.mapInArrow(run, df.schema)
