"""BPE encoding and decoding by forced-boundary splitting.

A pair of adjacent characters that occurs inside no vocabulary token can never be merged, so it marks a certain cut.
Pre-tokens are cut there, the fragments are encoded independently of each other and the ids concatenated; whole words'
ids are kept in a bounded memo. The vocabulary's end-of-word marker is folded into the last character of a
pre-token, so a fragment needs no knowledge of its neighbours.

Short fragments are merged side by side in numpy, a pair a round in each; a long one is merged with a heap of its pairs
and links between neighbours, in n log n steps.

Null and empty texts have no ids and decode to the empty string. Texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._common import pick

TOKENIZER = "word_bpe_49k.json"
#: Entries of a worker's memos; the older half is dropped when they are full, so memory stays bounded.
MEMO = 400_000
#: Longer words aren't remembered.
MEMO_WORD = 64
#: Characters of a fragment beyond which it is merged with a heap.
LONG = 256
_END = 0x10000  # of a private plane: the character that stands for "this one, at a word's end"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PairTable:
    """Rank and product of each mergeable pair of ids, as two hash tables without collisions: the second has the few pairs
    whose place in the first is taken."""

    BITS = 19
    NONE = np.int64(1) << 40

    def __init__(self, merges: list[tuple[int, int, int]]):
        a, b, made = (np.array(x, dtype=np.uint64) for x in zip(*merges))
        keys, ranks = a << np.uint64(32) | b, np.arange(len(made))
        self.tables = []
        self.merges = merges
        factor = 0x9E3779B97F4A7C15
        while len(keys):
            slot = self._slot(keys, factor)
            _, first = np.unique(slot, return_index=True)
            key, value = np.full(1 << self.BITS, (1 << 64) - 1, dtype=np.uint64), np.full(1 << self.BITS, self.NONE << 20)
            key[slot[first]], value[slot[first]] = keys[first], ranks[first] << 20 | made[first].astype(np.int64)
            self.tables.append((np.uint64(factor), key, value))
            rest = np.ones(len(keys), dtype=bool)
            rest[first] = False
            keys, ranks, made = keys[rest], ranks[rest], made[rest]
            factor = (factor * 0xD1342543DE82EF95 + 2) & (1 << 64) - 1 | 1

    @cached_property
    def pairs(self) -> dict[int, tuple[int, int]]:
        """Rank and product by pair, for one look-up at a time."""
        return {a << 32 | b: (rank, made) for rank, (a, b, made) in reversed(list(enumerate(self.merges)))}

    def _slot(self, keys: np.ndarray, factor: int) -> np.ndarray:
        return (keys * np.uint64(factor) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank and product in one number, rank above; NONE's for pairs that don't merge."""
        keys = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        out = np.full(len(keys), self.NONE << 20)
        for factor, key, value in self.tables:
            slot = self._slot(keys, factor)
            hit = key[slot] == keys
            out[hit] = value[slot[hit]]
        return out


def merge_long(symbols: list[int], table: PairTable) -> tuple[list[int], list[int]]:
    """One fragment: the pair of least rank, leftmost first, off a heap; (ids, the place of each one's first character)."""
    pairs, n = table.pairs, len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(p[0], k, a, b) for k, (a, b) in enumerate(zip(symbols, symbols[1:])) if (p := pairs.get(a << 32 | b))]
    heapq.heapify(heap)
    while heap:
        _, k, a, b = heapq.heappop(heap)
        j = after[k]
        if symbols[k] != a or j >= n or symbols[j] != b:  # one of the two has been merged since
            continue
        symbols[k], symbols[j] = pairs[a << 32 | b][1], -1
        after[k] = i = after[j]
        if i < n:
            before[i] = k
            if p := pairs.get(symbols[k] << 32 | symbols[i]):
                heapq.heappush(heap, (p[0], k, symbols[k], symbols[i]))
        if (h := before[k]) >= 0 and (p := pairs.get(symbols[h] << 32 | symbols[k])):
            heapq.heappush(heap, (p[0], h, symbols[h], symbols[k]))
    at = [k for k, x in enumerate(symbols) if x >= 0]
    return [symbols[k] for k in at], at


def merge(symbols: np.ndarray, fragment: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all fragments and the place of each one's first character."""
    starts = np.flatnonzero(np.append(True, fragment[1:] != fragment[:-1])) if len(symbols) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(symbols)))
    long = sizes > LONG
    if not long.any():
        return merge_short(symbols, fragment, table)
    short = np.repeat(~long, sizes)
    ids, at = merge_short(symbols[short], fragment[short], table)
    parts = [(ids, np.flatnonzero(short)[at])]
    for i, n in zip(starts[long].tolist(), sizes[long].tolist()):
        ids, at = merge_long(symbols[i : i + n].tolist(), table)
        parts.append((np.array(ids, dtype=np.int64), np.array(at, dtype=np.int64) + i))
    ids, at = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(at)
    return ids[order], at[order]


def merge_short(symbols: np.ndarray, fragment: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge each fragment's pair of least rank, leftmost first, one a round in every fragment that has any; (ids, the
    place of each one's first character)."""
    at = np.arange(len(symbols))
    done: list[tuple[np.ndarray, np.ndarray]] = []
    none = table.NONE << 20
    value = np.full(len(symbols), none)  # of the pair that begins here
    if len(symbols) > 1:
        near = fragment[1:] == fragment[:-1]
        value[:-1][near] = table.look_up(symbols[:-1][near], symbols[1:][near])
    while len(symbols):
        starts = np.flatnonzero(np.append(True, fragment[1:] != fragment[:-1]))
        sizes = np.diff(np.append(starts, len(symbols)))
        least = np.minimum.reduceat(value, starts)
        busy = least < none
        if not busy.all():
            rest = np.repeat(~busy, sizes)
            done.append((symbols[rest], at[rest]))
            go = ~rest
            symbols, fragment, at, value = symbols[go], fragment[go], at[go], value[go]
            sizes, least = sizes[busy], least[busy]
            if not len(symbols):
                break
        hit = np.flatnonzero(value == np.repeat(least, sizes))
        hit = hit[np.append(True, fragment[hit][1:] != fragment[hit][:-1])]
        symbols[hit] = value[hit] & (1 << 20) - 1
        keep = np.ones(len(symbols), dtype=bool)
        keep[hit + 1] = False
        place = hit - np.arange(len(hit))
        symbols, fragment, at, value = symbols[keep], fragment[keep], at[keep], value[keep]
        n = len(symbols)
        value[place] = none
        for k in (place, place - 1):  # the pairs that the new symbol is in
            k = k[(k >= 0) & (k < n - 1)]
            k = k[fragment[k] == fragment[k + 1]]
            value[k] = table.look_up(symbols[k], symbols[k + 1])
    if not done:
        return symbols, at
    symbols, at = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
    order = np.argsort(at)
    return symbols[order], at[order]


class ForcedBoundaryBPE:
    """Encoder for a word-end BPE file of the tokenizers library (lower-casing, blanks dropped)."""

    def __init__(self, path: str, full: bool = True):
        """full: keep the ids' decimal and decoded text too; else runs are encoded to the ids' bytes alone."""
        self.full = full
        spec = json.load(open(path, encoding="utf-8"))
        model, self.suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        if [n["type"] for n in spec["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"] or spec["decoder"] or not self.suffix:
            raise ValueError("only word-end BPE files with NFC, blanks, lower case and without a decoder")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_at = regex.compile("|".join(map(regex.escape, self.added))) if self.added else None
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] + r"|\n")
        self.tokens = {i: t for t, i in (model["vocab"] | self.added).items()}
        folded = {t: self._fold(t) for t in model["vocab"]}
        part = lambda t: folded[t] if t in folded else self._fold(t)
        ids = {folded[t]: i for t, i in model["vocab"].items()}
        pairs = [(part(a), part(b)) for a, b in model["merges"]]
        self.tables = PairTable([(ids[a], ids[b], ids[a + b]) for a, b in pairs if a in ids and b in ids])
        self.glyphs = np.array([ord(g) for g in self._byte_glyphs()], dtype=np.uint32)
        self.inside = np.zeros(1 << 20, dtype=bool)  # of pairs that some token has inside
        self.first_ids = np.zeros(1 << 10, dtype=np.int64)
        for t in folded.values():
            c = self._small(np.array([ord(g) for g in t], dtype=np.uint32))
            self.inside[c[:-1] << 10 | c[1:]] = True
            if len(t) == 1:
                self.first_ids[c[0]] = ids[t]
        self.words: dict[str, tuple[bytes, str, str]] = {}
        self.older: dict[str, tuple[bytes, str, str]] = {}

    def _fold(self, token: str) -> str:
        if token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[: -len(self.suffix)]
            return body[:-1] + chr(_END + ord(body[-1]))
        return token

    @staticmethod
    def _byte_glyphs() -> list[str]:
        """The printable character that byte-level BPE files write for each byte: itself where printable, else the next from U+0100."""
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = iter(range(0x100, 0x200))
        return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]

    @staticmethod
    def _small(codes: np.ndarray) -> np.ndarray:
        """Glyphs lie below 0x200, at a word's end 0x10000 higher: ten bits."""
        return codes & 0x1FF | codes >> 16 << 9

    def split_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of runs without blanks: the characters' ids, the fragment between forced boundaries and the run that each is in."""
        joined = "\n".join(words)
        if not joined.isascii():
            joined = unicodedata.normalize("NFC", joined).replace("Σ", "σ")  # str.lower() knows a final sigma, the library doesn't
        raw = np.frombuffer((" ".join(self.pieces.findall(joined.lower())) + " ").encode(), dtype=np.uint8)
        line = raw == 10
        gap = line | (raw == 32)
        codes = self.glyphs[raw]
        codes[:-1][gap[1:] & ~gap[:-1]] += _END
        small = self._small(codes)
        begin = ~gap
        begin[1:] &= gap[:-1] | ~self.inside[small[:-1] << 10 | small[1:]]
        there = ~gap
        return self.first_ids[small[there]], np.cumsum(begin)[there] - 1, np.cumsum(line)[there]

    def learn(self, words: list[str]) -> Iterator[tuple[bytes, str, str]] | list[bytes]:
        """Encode distinct words, all their fragments side by side."""
        symbols, fragment, word = self.split_words(words)
        symbols, at = merge(symbols, fragment, self.tables)
        ends = np.searchsorted(word[at], np.arange(len(words) + 1)).tolist()
        raw = symbols.astype(np.uint32).tobytes()
        if not self.full:
            return [raw[4 * i : 4 * j] for i, j in zip(ends, ends[1:])]
        ids = symbols.tolist()
        decimal, shown = list(map(str, ids)), list(map(self.tokens.__getitem__, ids))
        return ((raw[4 * i : 4 * j], " ".join(decimal[i:j]), " ".join(shown[i:j])) for i, j in zip(ends, ends[1:]))

    def look_up(self, words: list[list[str]]) -> list[list[tuple[bytes, str, str]]]:
        """For each word of each list its ids as bytes, as decimal text, and decoded."""
        memo = self.words
        missing = {w for w in set().union(*words) if w not in memo}
        long = []
        if missing:
            old = self.older
            found = {w: old[w] for w in missing if w in old}
            missing.difference_update(found)
            memo.update(found)
            if missing:
                new = list(missing)
                memo.update(zip(new, self.learn(new)))
                long = [w for w in new if len(w) > MEMO_WORD]
        out = [list(map(memo.__getitem__, ws)) for ws in words]
        for w in long:
            del memo[w]
        if len(memo) > MEMO // 2:  # words not met again in this generation are forgotten
            self.older, self.words = memo, {}
        return out

    def encode_many(self, texts: list[str | None]) -> list[list[tuple[bytes, str, str]]]:
        """Encoded runs of each text, in order."""
        plain = [t or "" for t in texts]
        marked = [k for k, t in enumerate(plain) if self.added_at and "<|" in t and self.added_at.search(t)]
        if not marked:
            return self.look_up([_blank_split(t) for t in plain])
        for k in marked:
            plain[k] = ""
        out = self.look_up([_blank_split(t) for t in plain])
        for k in marked:
            out[k], last, text = [], 0, texts[k]
            for m in [*self.added_at.finditer(text), None]:
                out[k] += self.look_up([_blank_split(text[last : m.start() if m else None])])[0]
                if m:
                    i = self.added[m[0]]
                    raw = array("I", [i]).tobytes()
                    out[k].append((raw, str(i), m[0]) if self.full else raw)
                    last = m.end()
        return out

    def encode(self, text: str | None) -> list[tuple[bytes, str, str]]:
        return self.encode_many([text])[0]

    def ids(self, text: str | None) -> list[int]:
        joined = b"".join([e[0] if self.full else e for e in self.encode(text)])
        return list(memoryview(joined).cast("I")) if joined else []

    def decode(self, ids: list[int]) -> str:
        """As the library does without a decoder: the tokens joined by one space."""
        return " ".join([self.tokens[i] for i in ids])


_CONTROL = regex.compile(r"[\x1c-\x1f]")
_BLANK = regex.compile(r"\s+")


def _blank_split(text: str) -> list[str]:
    # str.split() takes U+001C..U+001F for blanks; the tokenizer doesn't
    return [w for w in _BLANK.split(text) if w] if _CONTROL.search(text) else text.split()


@lru_cache(maxsize=2)
def encoder(path: str, full: bool = True) -> ForcedBoundaryBPE:
    return ForcedBoundaryBPE(path, full)


def encoded(bpe: ForcedBoundaryBPE, texts: pa.Array, chars: int = 1 << 17) -> Iterator[list[tuple[bytes, str, str]]]:
    """Encode a column, about so many bytes of text at a time."""
    chunk, size = [], 0
    for text in texts:
        chunk.append(text.as_py())
        size += len(chunk[-1] or "")
        if size >= chars:
            yield from bpe.encode_many(chunk)
            chunk, size = [], 0
    yield from bpe.encode_many(chunk)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, with_ids: bool = True) -> DataFrame:
    """Encode every whole text. Returns per row: doc_id, n_tokens, ids array (with_ids), ids_sha256, decoded_sha256.

    Null and empty texts: no ids, digests of the empty string. Repeated rows and null ids are kept as they are; no order
    is used, so ties don't matter; an empty table gives none; other columns are ignored.
    """
    path = tokenizer
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path or tokenizer_path())
        for batch in batches:
            n, ids, a, b = [], [], [], []
            for got in encoded(bpe, batch.column(1)):
                size = sum([len(e[0]) for e in got]) // 4
                n.append(size)
                a.append(hashlib.sha256(" ".join([e[1] for e in got]).encode()).hexdigest())
                b.append(hashlib.sha256(" ".join([e[2] for e in got]).encode()).hexdigest())
                if with_ids:
                    ids.append(np.frombuffer(b"".join([e[0] for e in got]), dtype=np.int32))
            columns = [batch.column(0), pa.array(n, pa.int64()), *([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []), pa.array(a, pa.string()), pa.array(b, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", *(["ids"] if with_ids else []), "ids_sha256", "decoded_sha256"])

    return pick(df, doc_id=id_col, text=text_col).mapInArrow(run, f"doc_id {kind}, n_tokens long, {'ids array<int>, ' if with_ids else ''}ids_sha256 string, decoded_sha256 string")


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", tokenizer: str | None = None) -> DataFrame:
    """Decode id arrays: doc_id, decoded. A null array decodes to the empty string; an unknown id is an error."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer or tokenizer_path())
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bpe.decode(x.as_py() or []) for x in batch.column(1)], pa.string())], names=["doc_id", "decoded"])

    return pick(df, doc_id=id_col, ids=ids_col).mapInArrow(run, f"doc_id {kind}, decoded string")
