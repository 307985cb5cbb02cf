"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes a space (runs of them one), and the grams of one to three
characters are hashed with numpy to a fixed number of buckets. Training counts buckets per language in parallel, on at
most `per_language` texts of each language, those with the least hash of their id; priors come from all training rows.
The matrix of log probabilities has buckets x languages numbers, at most MOST_NUMBERS however many languages there are
(more languages than that bound allows take fewer buckets); it is broadcast, and a batch of texts is scored by gathering
rows and adding them up text by text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import pick

BUCKETS = 1 << 16
#: Training texts of a language, at most.
PER_LANGUAGE = 3000
#: Numbers of the matrix, at most (256 MB): up to 1024 languages have all buckets, twice as many have half of them.
MOST_NUMBERS = 1 << 26
#: Chosen texts' ids that are broadcast, at most.
MOST_BROADCAST = 1_000_000
SMOOTH = 0.5
#: Characters scored at once.
CHUNK = 1 << 20
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all grams, the text each belongs to, and whether each text has a letter."""
    codes = np.frombuffer("\n".join(["", *texts, ""]).lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    # lower() may lengthen a text, but it never makes or takes a line feed; those inside texts were replaced
    ends = codes == 10
    owner = np.cumsum(ends) - 1
    letter = _letters()[codes]
    codes = np.where(letter, codes, np.uint32(32)).astype(np.uint64)
    keep = letter | ends
    keep[1:] |= letter[:-1]  # one gap after each word
    codes, owner, letter, ends = codes[keep], owner[keep], letter[keep], ends[keep]
    some = np.zeros(len(texts) + 1, dtype=bool)
    some[owner[letter]] = True
    a, b, c = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
    shift = np.uint64(48)
    one = codes * a
    two = one[:-1] * b + codes[1:] * a + c
    three = two[:-1] * b + codes[2:] * a
    same2 = ~ends[1:]  # a gram may begin at the feed before its text, which stands for a gap
    same3 = same2[:-1] & same2[1:]
    bucket = np.concatenate([(one >> shift)[letter], (two >> shift)[same2], (three >> shift)[same3]]).astype(np.int64)
    of = np.concatenate([owner[letter], owner[1:][same2], owner[2:][same3]])
    return bucket, of, some[: len(texts)]


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[list[str]]:
    part, chars = [], 0
    for t in texts:
        part.append((t.as_py() or "").replace("\n", " "))
        chars += len(part[-1])
        if chars >= size:
            yield part
            part, chars = [], 0
    if part:
        yield part


def fold(id_col: str | Column, parts: int, held: int) -> Column:
    """Whether crc32 of the id's text modulo `parts` is `held`; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == held, F.lit(False))


Model = tuple[list[str], np.ndarray, np.ndarray]


def buckets_for(languages: int) -> int:
    return min(BUCKETS, 1 << (MOST_NUMBERS // max(languages, 1)).bit_length() - 1)


def chosen_ids(rows: DataFrame, sizes: dict[str, int], per_language: int) -> DataFrame:
    """(doc_id, lang) of the rows with the least hash of the id, `per_language` of each language at most.

    A language has its rows cut to some more than needed by the hash alone, before anything is shuffled, so that the
    window that picks them sees a bounded number of a language's rows.
    """
    share = lambda n: min(1.0, (per_language + 8 * per_language**0.5 + 50) / n)
    spread = F.shiftrightunsigned(F.xxhash64("doc_id"), 11).cast("double") * 2.0**-53
    limits = F.create_map(*[F.lit(v) for lang, n in sizes.items() for v in (lang, share(n))])
    some = rows.where(spread <= limits[F.col("lang")]).distinct()
    least = Window.partitionBy("lang").orderBy(spread, "doc_id")
    return some.withColumn("_k", F.row_number().over(least)).where(F.col("_k") <= per_language).select("doc_id", "lang")


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_language: int = PER_LANGUAGE) -> Model:
    """Languages, the matrix log p(bucket | language), float32, buckets x languages, and the languages' log priors.

    No rows: no languages. Rows without a language or id are left out; of rows with one id all count, and of ids with
    equal hashes the least comes first.
    """
    rows = pick(df, doc_id=id_col, lang=lang_col).dropna()
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # a row a language
    if not sizes:
        return [], np.zeros((BUCKETS, 0), dtype=np.float32), np.zeros(0)
    buckets = buckets_for(len(sizes))
    chosen = chosen_ids(rows, sizes, per_language)
    if len(sizes) * per_language <= MOST_BROADCAST:
        chosen = F.broadcast(chosen)
    texts = pick(df, doc_id=id_col, lang=lang_col, text=text_col).join(chosen, ["doc_id", "lang"], "left_semi").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, at = batch.column(0).to_pylist(), 0
            for part in chunks(batch.column(1)):
                bucket, of, _ = grams(part)
                names = np.array(langs[at : at + len(part)])
                at += len(part)
                for lang in set(names):
                    totals.setdefault(lang, np.zeros(buckets, np.int64))
                    totals[lang] += np.bincount(bucket[(names == lang)[of]] & buckets - 1, minlength=buckets)
        for lang, n in totals.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([str(lang)] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(n[some], pa.int64())], names=["lang", "bucket", "n"])

    counts = texts.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    langs = sorted(sizes)
    matrix = np.full((buckets, len(langs)), SMOOTH)
    table = counts.toArrow()  # at most MOST_NUMBERS rows
    names = np.searchsorted(langs, np.array(table.column("lang").to_pylist(), dtype=object)) if table.num_rows else np.zeros(0, int)
    matrix[table.column("bucket").to_numpy(), names] += table.column("n").to_numpy()
    n = np.array([sizes[lang] for lang in langs], dtype=float)
    return langs, np.log(matrix / matrix.sum(axis=0)).astype(np.float32), np.log(n / n.sum())


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *keep: Column) -> DataFrame:
    """Per row: doc_id, `keep`, lang_pred, score (the posterior).

    `und` with score 0 for null texts, texts without a letter, and where nothing was learned. Of equally likely
    languages the first by name wins. Repeated rows and null ids are kept; an empty table gives none.
    """
    langs, matrix, prior = model
    last = np.int64(len(matrix) - 1)
    shared = df.sparkSession.sparkContext.broadcast(matrix)
    given = df.select(df[f"`{text_col}`"].alias("_text"), df[f"`{id_col}`"].alias("doc_id"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logp = shared.value
        for batch in batches:
            found, scores = [], []
            for part in chunks(batch.column(0)):
                bucket, of, some = grams(part)
                bucket &= last
                if not langs:
                    some[:] = False
                total = np.stack([np.bincount(of, weights=logp[bucket, k], minlength=len(part))[: len(part)] for k in range(len(langs))], axis=1) + prior if langs else np.zeros((len(part), 1))
                best = total.argmax(axis=1)
                share = 1 / np.exp(np.minimum(total - total.max(axis=1, keepdims=True), 0)).sum(axis=1)
                found += [langs[k] if ok else UNKNOWN for k, ok in zip(best, some)]
                scores.append(np.where(some, share, 0.0))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=[*batch.schema.names[1:], "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema if f.name != "_text")
    return given.mapInArrow(run, f"{schema}, lang_pred string, score double")
