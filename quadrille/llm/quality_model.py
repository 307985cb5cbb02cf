"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

Features of a text are its words, its words' shapes (letters' case, digits, other characters as they are, runs once) and
the pairs of neighbours of both, each hashed to one of 2^18 weights; a pair of equal words has a feature of its own. A
feature's value is its count over the square root of the sum of squares. The weights are one fixed-size vector, which is
broadcast; a text's score is a sparse dot product and the logistic function.

Training sees at most `max_labelled` labelled rows (those with the least hash of their id), so it is one bounded task;
scoring covers every row and whole texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import pick, words_of

BITS = 18
MAX_LABELLED = 6000
EPOCHS = 3
# Fixed values of the updates: learning rate, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
#: Words that a worker's memo holds; a full memo is emptied. Longer words than MEMO_WORD go with their batch.
MEMO, MEMO_WORD = 300_000, 64
#: Words hashed at once.
CHUNK_WORDS = 200_000

_RUNS = [(re.compile(r"[^\W\d_]+"), None), (re.compile(r"\d+"), "0")]


def shape(word: str) -> str:
    """Unicode letters to x, X or Xx by case, digits to 0, other characters as they are but runs of one character once."""
    case = lambda m: "X" if len(m[0]) > 1 and m[0].isupper() else "Xx" if m[0][0].isupper() else "x"
    out = _RUNS[1][0].sub("0", _RUNS[0][0].sub(case, word))
    return re.sub(r"([^\w])\1+", r"\1", out)


class Hasher:
    def __init__(self) -> None:
        self.memo: dict[str, int] = {}

    def _of(self, words: set[str]) -> dict[str, int]:
        return {w: zlib.crc32(w.encode()) | zlib.crc32(b"\x01" + shape(w).encode()) << 32 for w in words}

    def features(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, bucket) and their values, ordered by text."""
        words = [words_of(t) for t in texts]
        flat = [w for ws in words for w in ws]
        memo = self.memo
        missing = {w for w in flat if w not in memo}
        if len(memo) + len(missing) > MEMO:
            memo.clear()
            missing = set(flat)
        memo.update(self._of(missing))
        long = [w for w in missing if len(w) > MEMO_WORD]
        both = np.fromiter(map(memo.__getitem__, flat), np.uint64, len(flat))
        for w in long:
            del memo[w]
        of = np.repeat(np.arange(len(texts)), [len(w) for w in words])
        a, b = both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)
        m = np.uint64(0x9E3779B97F4A7C15)
        near = of[1:] == of[:-1]
        same = (both[1:] == both[:-1]).astype(np.uint64)
        pair = lambda x, k: ((x[:-1] * m + x[1:] + np.uint64(k)) * m)[near]
        hashes = np.concatenate([a * m, (b + np.uint64(1 << 33)) * m, pair(a, 7), (((b[:-1] * m + b[1:]) * np.uint64(2) + same) * m)[near]])
        owner = np.concatenate([of, of, of[1:][near], of[1:][near]])
        key, count = np.unique(owner.astype(np.uint64) << np.uint64(BITS) | hashes >> np.uint64(64 - BITS), return_counts=True)
        owner, bucket = (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64((1 << BITS) - 1)).astype(np.int64)
        value = np.sqrt(count)
        return owner, bucket, value / np.sqrt(np.bincount(owner, weights=value**2, minlength=len(texts)))[owner]


def chunks(texts: pa.Array, chars: int = 1 << 20) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t.as_py() or "")
        size += len(part[-1])
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


class Leader:
    """Follow-the-regularised-leader, per coordinate; the last weight is the bias."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def update(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", only: Column | None = None, max_labelled: int = MAX_LABELLED) -> np.ndarray:
    """The weight vector; all zero if there is no labelled row. `only` restricts the labels' rows, as a condition on doc_id.

    Ids with both labels and rows without an id or label teach nothing.
    """
    ids = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label")).dropna()
    if only is not None:
        ids = ids.where(only)
    ids = ids.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_most")).where("label = _most").drop("_most")
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    rows = pick(df, doc_id=id_col, text=text_col).join(F.broadcast(ids), "doc_id")  # at most max_labelled pairs
    size = (1 << BITS) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, model, seen = Hasher(), Leader(size), []
        for batch in batches:
            labels, at = batch.column(1).to_pylist(), 0
            for part in chunks(batch.column(2)):
                owner, bucket, value = hasher.features(part)
                cuts = np.searchsorted(owner, np.arange(len(part) + 1))
                for k in range(len(part)):
                    i, j = cuts[k], cuts[k + 1]
                    seen.append((np.append(bucket[i:j], size - 1).astype(np.int32), np.append(value[i:j], 1.0).astype(np.float32), labels[at + k]))
                at += len(part)
        for epoch in range(EPOCHS):
            for k in np.random.default_rng(epoch).permutation(len(seen)):
                model.update(*seen[k])
        w = model.weights()
        some = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(w[some], pa.float64())], names=["at", "w"])

    # one bounded task; the sort makes the updates' order a matter of the rows alone
    ordered = rows.select("doc_id", "label", "text").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(2 * max_labelled).coalesce(1)
    table = ordered.mapInArrow(run, "at int, w double").toArrow()  # at most 2^BITS + 1 rows
    w = np.zeros(size, dtype=np.float32)
    w[table.column("at").to_numpy()] = table.column("w").to_numpy()
    return w


def score(df: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text", *keep: Column) -> DataFrame:
    """Per row: doc_id, `keep`, score (0 to 1), predicted (1 if score >= 0.5).

    Null and empty texts get the bias's score. Repeated rows and null ids are kept; an empty table gives none.
    """
    shared = df.sparkSession.sparkContext.broadcast(weights)
    given = df.select(df[f"`{text_col}`"].alias("_text"), df[f"`{id_col}`"].alias("doc_id"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, hasher = shared.value, Hasher()
        for batch in batches:
            scores = []
            for part in chunks(batch.column(0)):
                owner, bucket, value = hasher.features(part)
                total = np.bincount(owner, weights=w[bucket] * value, minlength=len(part)) + w[-1]
                scores.append(1 / (1 + np.exp(-np.clip(total, -500, 500))))
            s = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], names=[*batch.schema.names[1:], "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema if f.name != "_text")
    return given.mapInArrow(run, f"{schema}, score double, predicted int")
