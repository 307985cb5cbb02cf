"""Removal of repeated passages by prefix-partitioned suffix trees.

A passage matters here from `window` words on, so trees are cut off at that depth. 1. Texts with the same words are settled
by their digest: all but the smallest id's lose everything. 2. Suffixes are sampled: the gram of half a window that is least
by hash in a window is the window's anchor, and equal windows have equal anchors at equal places, so the suffixes that
begin at anchors, each with the few words before it, stand for all windows. 3. Suffixes are split by a prefix of variable
length. It has half a window's words at first; a prefix that one document has alone can't repeat and goes (which leaves a
few percent of the suffixes), one that up to `most` documents have is a group that fits a task's memory, and one that more
have is lengthened, to three quarters of a window and then to all of it, at which depth a subtree is a single node. A
lengthened prefix doesn't reach every window around its anchor, so further suffixes that begin before the anchor are
sampled for those (`split`). 4. A task builds the subtrees of its groups: sorted suffixes and the lengths of their common
prefixes, whose intervals are the internal nodes, and the same leftwards. Where a node that is deep enough and the words to
the left agree in as many words as a window has, its suffixes repeat there, and the smallest document keeps the passage.
5. The nodes of whole windows, which a third of all documents may have, need their smallest document only: it is combined
before the shuffle and joined back with hot nodes broadcast. 6. Covered words are removed from the documents that have any.

Words are runs of characters other than space and \\t\\n\\v\\f\\r, compared as they are, by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import join_hot, materialise
from .hashing import chunks, mix, rolling, word_hashes

WINDOW = 50
#: Documents that share a prefix, beyond which it is lengthened.
MOST_DOCUMENTS = 1000
#: Words that a task orders at once; a prefix group is never split over two batches.
BATCH_WORDS = 300_000
#: Bytes of suffixes that leave a task at once.
BATCH_BYTES = 1 << 23


def lengths(window: int) -> list[int]:
    """The prefixes' lengths, one for each level."""
    gram = window // 2
    return sorted({gram, (gram + window) // 2, window})


def anchors(h: np.ndarray, window: int) -> np.ndarray:
    """The least gram hash of each window of a document's word hashes."""
    gram = window // 2
    low, width, want = rolling(h, gram), 1, window - gram + 1
    while 2 * width <= want:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = want - width
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def anchor_runs(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the anchors, leftmost where several are least, and how far before them (least, most) their windows begin."""
    gram = window // 2
    grams = rolling(h, gram)
    place, width, want = np.arange(len(grams)), 1, window - gram + 1

    def lower(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(grams[b] < grams[a], b, a)

    while 2 * width <= want:
        place = lower(place[:-width], place[width:])
        width *= 2
    if rest := want - width:
        place = lower(place[: len(place) - rest], place[rest:])
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    last = np.append(first[1:], len(place)) - 1
    return place[first], place[first] - last, place[first] - first


def split(runs: tuple[np.ndarray, np.ndarray, np.ndarray], length: int, window: int) -> tuple[np.ndarray, ...]:
    """Sampled suffixes for a prefix of that length: begin, least and most words before it that a window begins at, and the
    anchor and range that they come from. A prefix of `length` lies in windows that begin up to window - length words
    before it, so every so many words before the anchor there is another suffix."""
    step = window - length + 1
    place, least, most = runs
    count = most // step - least // step + 1
    of = np.repeat(np.arange(len(place)), count)
    before = (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + (least // step)[of]) * step
    low, high = np.maximum(least[of], before), np.minimum(most[of], before + step - 1)
    return place[of] - before, low - before, high - before, place[of], low, high


def suffixes(h: np.ndarray, window: int, level: int, hot: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """The suffixes of a level whose prefixes on all levels above are hot: begin, least, most, and the prefix's hash."""
    runs = anchor_runs(h, window)
    for k, length in enumerate(lengths(window)[: level + 1]):
        begin, least, most, *runs = split(runs, length, window)
        key = rolling(h, length)[begin]
        if k < level:
            keep = np.isin(key, hot[k])
            runs = [x[keep] for x in runs]
    return begin, least, most, key


def per_document(texts: list[bytes]) -> Iterator[np.ndarray]:
    h, owner, _, _ = word_hashes(texts)
    first = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
    return (h[i:j] for i, j in zip(first, first[1:]))


def profile(df: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Per row: doc_id, key (a hash of the text), n_words, words_sha256, anchors (distinct; none below a window's length)."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for part in chunks(batch.column(2)):
                sizes, digests, found = [], [], []
                for text, h in zip(part, per_document(part)):
                    sizes.append(len(h))
                    digests.append(hashlib.sha256(b" ".join(text.split())).hexdigest())
                    found.append(np.unique(anchors(h, window)).view(np.int64) if len(h) >= window else [])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(part)), batch.column(1).slice(row, len(part)), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "key", "n_words", "words_sha256", "anchors"])
                row += len(part)

    return _keyed(df, id_col, text_col).mapInArrow(run, f"doc_id {kind}, key long, n_words long, words_sha256 string, anchors array<long>")


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(df[f"`{id_col}`"].alias("doc_id"), F.xxhash64(df[f"`{text_col}`"]).alias("key"), df[f"`{text_col}`"].alias("text"))


def _unsigned(values: pa.Scalar) -> np.ndarray:
    return np.array(values.as_py(), dtype=np.int64).view(np.uint64)


def _hot(values: pa.Scalar) -> list[np.ndarray]:
    return [np.array(level, dtype=np.int64).view(np.uint64) for level in values.as_py()]


def contents(h: np.ndarray, begin: np.ndarray, least: np.ndarray, most: np.ndarray, window: int) -> np.ndarray:
    """A number for each suffix that is equal where the words around it, up to the ends of its windows, are."""
    m = 0xD1342543DE82EF95
    powers = np.full(len(h) + 1, m, dtype=np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    back = np.full(len(h) + 1, pow(m, -1, 1 << 64), dtype=np.uint64)
    back[0] = 1
    back = np.multiply.accumulate(back)
    total = np.append(np.uint64(0), np.cumsum(h * powers[:-1]))
    i, j = begin - most, begin + window - least
    return mix((total[j] - total[i]) * back[i] + least.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + most.astype(np.uint64))


def segments(texts: DataFrame, kind: str, window: int, level: int) -> DataFrame:
    """Suffixes with shared prefixes of the level that aren't hot: prefix, doc_id, key, begins, least, most, words (hashes
    from the first window's begin to the last one's end). A document's suffixes with the same words travel as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, held, size = 0, [], 0

            def done() -> pa.RecordBatch:
                columns = list(zip(*held)) or [[]] * 6
                take = pa.array(columns[1], pa.int64())
                named = {"prefix": pa.array(columns[0], pa.int64()), "doc_id": batch.column(0).take(take), "key": batch.column(1).take(take), "begins": pa.array(columns[2], pa.list_(pa.int64())), "least": pa.array(columns[3], pa.int32()), "most": pa.array(columns[4], pa.int32()), "words": pa.array(columns[5], pa.binary())}
                return pa.RecordBatch.from_arrays(list(named.values()), names=list(named))

            for part in chunks(batch.column(2)):
                for h in per_document(part):
                    begin, least, most, key = suffixes(h, window, level, _hot(batch.column(4)[row]))
                    some = np.flatnonzero(np.isin(key, _unsigned(batch.column(3)[row])))
                    same = contents(h, begin[some], least[some], most[some], window)
                    order = np.argsort(same, kind="stable")
                    cuts = np.flatnonzero(np.append(True, np.diff(same[order]) != 0)) if len(some) else []
                    for at in np.split(some[order], cuts[1:]) if len(some) else ():
                        k = at[0]
                        held.append((int(key[k : k + 1].view(np.int64)[0]), row, begin[at], int(least[k]), int(most[k]), h[begin[k] - most[k] : begin[k] + window - least[k]].tobytes()))
                        size += len(held[-1][5]) + 8 * len(at)
                        if size > BATCH_BYTES:
                            yield done()
                            held, size = [], 0
                    row += 1
            yield done()

    return texts.select("doc_id", "key", "text", "cold", "hot").where(F.size("cold") > 0).mapInArrow(run, f"prefix long, doc_id {kind}, key long, begins array<long>, least int, most int, words binary")


def longer(texts: DataFrame, kind: str, window: int, level: int) -> DataFrame:
    """Prefixes of a level below hot ones: prefix, more (its hashes), doc_id, key, start. Distinct ones for each document
    with start null, but on the last level, where they are windows, all of them with their starts."""
    last = level == len(lengths(window)) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for part in chunks(batch.column(2)):
                take, start, a, b = [], [], [], []
                for h in per_document(part):
                    begin, _, _, key = suffixes(h, window, level, _hot(batch.column(3)[row]))
                    if not last:
                        key, k = np.unique(key, return_index=True)
                        begin = begin[k]
                    a.append(key)
                    b.append(rolling(mix(h), lengths(window)[level])[begin])
                    start.append(begin)
                    take.append(np.full(len(begin), row))
                    row += 1
                join = lambda x: pa.array(np.concatenate(x).view(np.int64), pa.int64())
                at = join(take)
                yield pa.RecordBatch.from_arrays([join(a), join(b), batch.column(0).take(at), batch.column(1).take(at), join(start)], names=["prefix", "more", "doc_id", "key", "start"])

    return texts.select("doc_id", "key", "text", "hot").where("size(hot[size(hot) - 1]) > 0").mapInArrow(run, f"prefix long, more long, doc_id {kind}, key long, start long")


def common(rows: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of words within each lead, and how many words each has in common with the one before it."""
    order = np.lexsort((*rows.T[::-1], lead))
    equal = np.ones((len(rows), rows.shape[1] + 1), dtype=bool)
    equal[1:, :-1] = rows[order][1:] == rows[order][:-1]
    equal[:, -1] = False
    shared = equal.argmin(axis=1)
    shared[0] = 0
    shared[1:][lead[order][1:] != lead[order][:-1]] = -1
    return order, shared


def cut_at(order: np.ndarray, shared: np.ndarray, depth: int) -> np.ndarray:
    """For each row the highest node of the tree that is at least so deep: equal numbers for rows below one node."""
    node = np.empty(len(order), dtype=np.int64)
    node[order] = np.cumsum(shared < depth)
    return node


def repeats(ids: np.ndarray, prefixes: np.ndarray, least: np.ndarray, most: np.ndarray, words: list[np.ndarray], window: int) -> list[tuple[int, int, int]]:
    """(suffix, least, most words before it) of the windows that a smaller id has too, over the subtrees of whole prefixes."""
    n, reach = len(words), int(most.max())
    lone = np.arange(n, dtype=np.uint64)[:, None]  # words that a suffix lacks are like no other's
    right, left = np.repeat(lone, window, axis=1), np.repeat(lone, max(reach, 1), axis=1)
    for k, (w, m) in enumerate(zip(words, most.tolist())):
        right[k, : len(w) - m] = w[m:]
        left[k, :m] = w[:m][::-1]
    rightwards, leftwards = common(right, prefixes), common(left, np.zeros(n, dtype=np.int64))
    rank = np.unique(ids, return_inverse=True)[1]
    first, last = np.full(n, window), np.full(n, -1)
    for before in range(int(least.min()), reach + 1):
        some = np.flatnonzero((least <= before) & (before <= most))
        node = cut_at(*rightwards, window - before)[some] * (n + 1) + cut_at(*leftwards, before)[some]
        node = np.unique(node, return_inverse=True)[1]
        low = np.full(len(some), n, dtype=np.int64)
        np.minimum.at(low, node, rank[some])
        hit = some[rank[some] > low[node]]
        first[hit] = np.minimum(first[hit], before)
        last[hit] = before
    return [(k, int(first[k]), int(last[k])) for k in np.flatnonzero(last >= 0)]


def merged(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of equal length as few ranges."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    cuts = np.flatnonzero(np.append(True, starts[1:] > ends[:-1]))
    return zip(starts[cuts].tolist(), ends[np.append(cuts[1:], len(starts)) - 1].tolist())


def tree_ranges(table: DataFrame, kind: str, window: int) -> DataFrame:
    """Word ranges to remove: doc_id, key, start, end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def done(rows: list[tuple]) -> pa.RecordBatch:
            prefixes, docs, keys, begins, least, most, words = zip(*rows)
            found = repeats(np.array(docs), np.array(prefixes), np.array(least), np.array(most), [np.frombuffer(w, np.uint64) for w in words], window)
            out = [(docs[k], keys[k], a, b) for k, near, far in found for at in [np.array(begins[k])] for a, b in merged(at - far, at - near + window)]
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out) if out else [[]] * 4, schema)], schema=schema)

        rows, held = [], 0
        for batch in batches:
            schema = schema or pa.schema([batch.schema.field(1), batch.schema.field(2), ("start", pa.int64()), ("end", pa.int64())])
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held >= BATCH_WORDS and row[0] != rows[-1][0]:
                    yield done(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[6]) // 8
        if rows:
            yield done(rows)

    return table.repartition("prefix").sortWithinPartitions("prefix").select("prefix", "doc_id", "key", "begins", "least", "most", "words").mapInArrow(run, f"doc_id {kind}, key long, start long, end long")


def cut(texts: DataFrame, ranges: DataFrame, kind: str) -> DataFrame:
    """Per document with ranges: doc_id, key, n_removed, kept_sha256, kept (its words joined by one space)."""
    by_doc = ranges.groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))  # at most a document's words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, digests, kept = [], [], []
            for text, ranges in zip(batch.column(2), batch.column(3)):
                words = text.as_py().encode().split()
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for r in ranges.as_py():
                    gone[r["start"]] += 1
                    gone[r["end"]] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                left = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.string())], names=["doc_id", "key", "n_removed", "kept_sha256", "kept"])

    return texts.select("doc_id", "key", "text").dropDuplicates(["doc_id", "key"]).join(by_doc, ["doc_id", "key"]).mapInArrow(run, f"doc_id {kind}, key long, n_removed long, kept_sha256 string, kept string")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, most_documents: int = MOST_DOCUMENTS, with_text: bool = False) -> DataFrame:
    """One row per row: doc_id, n_words, n_removed, kept_sha256; with_text also kept_text, null where nothing was removed.

    A word goes if a window of `window` consecutive words (2 or more) that covers it also starts in a document with a
    smaller id. Null and empty texts have no words. Rows without an id lose nothing and take nothing; rows that share an id
    don't take from each other; an empty table gives none; other columns are ignored.
    """
    if window < 2:
        raise ValueError("a window has 2 words or more")
    kind = df.schema[id_col].dataType.simpleString()
    rows = materialise(profile(df, id_col, text_col, window), "substring-rows")
    long = rows.where(f"n_words >= {window} and doc_id is not null")
    first = materialise(long.groupBy("words_sha256").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "substring-first")
    known = join_hot(long, first, ["words_sha256"], "n")
    keys = known.where("doc_id = least").select("doc_id", "key", F.explode("anchors").alias("prefix"))
    texts, ranges = None, []
    for level in range(len(lengths(window))):
        last = level == len(lengths(window)) - 1
        on = ["prefix", "more"] if last else ["prefix"]
        shared = materialise(keys.groupBy(*on).agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n")).where("a < b").select(*on, F.col("a").alias("least"), "n"), "substring-shared")
        found = join_hot(keys, shared, on, "n")
        if last:
            ranges.append(found.where("doc_id > least").select("doc_id", "key", "start", (F.col("start") + window).alias("end")))
            break
        hot = F.col("n") > most_documents
        wanted = found.groupBy("doc_id", "key").agg(F.collect_set(F.when(~hot, F.col("prefix"))).alias("cold"), F.collect_set(F.when(hot, F.col("prefix"))).alias("_hot"))  # at most a document's windows
        given = _keyed(df, id_col, text_col).withColumn("hot", F.array().cast("array<array<bigint>>")) if texts is None else texts.drop("cold")
        texts = materialise(given.join(wanted, ["doc_id", "key"]).withColumn("hot", F.array_append("hot", F.col("_hot"))).drop("_hot"), "substring-texts")
        ranges.append(tree_ranges(segments(texts, kind, window, level), kind, window))
        if shared.where(hot).isEmpty():
            break
        keys = materialise(longer(texts, kind, window, level + 1), "substring-keys")
    texts = _keyed(df, id_col, text_col)
    done = cut(texts, reduce(DataFrame.unionByName, ranges), kind)
    copies = known.where("doc_id > least").select("doc_id", "key", F.lit(True).alias("copy")).distinct()
    out = rows.join(done if with_text else done.drop("kept"), ["doc_id", "key"], "left").join(copies, ["doc_id", "key"], "left")
    copy = F.coalesce("copy", F.lit(False))
    columns = [
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "words_sha256")).alias("kept_sha256"),
    ]
    return out.select(*columns, *([F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept_text")] if with_text else []))
