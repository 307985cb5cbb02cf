"""Best-fit packing of token sequences by exact-complement hashing.

Only the histogram of piece lengths reaches the driver: at most `capacity` numbers, however many rows there are. The plan
is made on it. For each length, longest first, sums of one, two and three other lengths that fill its gap exactly are
looked up among the lengths still available, and as many of these combinations are used as their counts allow. What is
left goes best-fit, longest first, into the open sequence with the least gap that it fits.

The plan is a list of runs: "pieces of this length with ranks from a to b lie k to a sequence from this sequence on, at
this offset". Each combination uses up a length, so there are fewer runs than some multiple of `capacity`, which bounds
what is sent to the tasks. Ranks among pieces of one length come from counts per (length, salt), salts being dealt out
evenly, so a length that a third of all pieces share is still spread over many tasks.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialise, pick
from .bpe import encoded, encoder, tokenizer_path

CAPACITY = 2048
END_ID = 0
#: Pieces that share a length and a salt, about.
PER_SALT = 20_000


@dataclass
class Run:
    length: int
    first_rank: int
    first_sequence: int
    per_sequence: int
    offset: int


def combinations(have: np.ndarray, first: int, gap: int) -> Iterator[tuple[int, ...]]:
    """One, two or three available lengths that sum to the gap, none over `first`; `have` may change between steps."""
    if 0 < gap <= first and have[gap]:
        yield (gap,)
    for c in np.flatnonzero(have[1 : gap // 2 + 1]) + 1:
        if have[c] and gap - c <= first and have[gap - c]:
            yield (gap - c, int(c))
    for b in (np.flatnonzero(have[1 : min(first, gap - 2) + 1]) + 1)[::-1] if gap > 2 else ():
        rest = gap - b
        if not have[b] or rest > 2 * b:
            continue
        low = np.arange(max(1, rest - b), rest // 2 + 1)
        for c in low[(have[low] > 0) & (have[rest - low] > 0)]:
            yield (int(b), int(rest - c), int(c))


def plan(counts: np.ndarray, capacity: int) -> tuple[list[Run], int]:
    """Runs for counts[length], and the number of sequences."""
    have = np.zeros(capacity + 1, dtype=np.int64)
    have[: len(counts)] = counts
    used = np.zeros_like(have)
    runs: list[Run] = []
    sequences = 0

    def lay(parts: list[tuple[int, int]], times: int) -> None:
        nonlocal sequences
        offset = 0
        for length, k in parts:
            runs.append(Run(length, int(used[length]), sequences, k, offset))
            used[length] += k * times
            offset += length * k
        sequences += times

    def grouped(lengths: tuple[int, ...]) -> list[tuple[int, int]]:
        return [(x, lengths.count(x)) for x in sorted(set(lengths), reverse=True)]

    if have[capacity]:
        lay([(capacity, 1)], int(have[capacity]))
        have[capacity] = 0
    for a in range(capacity - 1, 0, -1):
        if not have[a]:
            continue
        for others in combinations(have, a, capacity - a):
            parts = grouped((a, *others))
            times = min(int(have[x]) // k for x, k in parts)
            if times:
                for x, k in parts:
                    have[x] -= k * times
                lay(parts, times)
            if not have[a]:
                break
    open_at: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}  # by gap: what lies in them, how many such
    gaps: list[int] = []

    def put(gap: int, parts: list[tuple[int, int]], times: int) -> None:
        if times and not gap:
            lay(parts, times)
        elif times:
            if gap not in open_at:
                bisect.insort(gaps, gap)
            open_at.setdefault(gap, []).append((parts, times))

    for a in range(capacity - 1, 0, -1):
        n = int(have[a])
        while n:
            k = bisect.bisect_left(gaps, a)
            if k < len(gaps):
                gap = gaps[k]
                parts, times = open_at[gap].pop()
                if not open_at[gap]:
                    del open_at[gap], gaps[k]
            else:
                gap, parts, times = capacity, [], n
            fit = min(gap // a, n)
            filled = min(times, n // fit)
            n -= filled * fit
            put(gap, parts, times - filled if parts else 0)
            put(gap - fit * a, [*parts, (a, fit)], filled)
    for gap in gaps:
        for parts, times in open_at[gap]:
            lay(parts, times)
    return runs, sequences


def pack_lengths(pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length", salt_col: str = "salt") -> DataFrame:
    """Adds sequence_id and offset to rows that have a length of 1 to `capacity` and an evenly dealt integer salt.

    Give it a written table: it is read twice and must not change. Ties are broken by salt, so any order will do.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in pieces.groupBy(length_col).count().collect():  # at most `capacity` rows
        counts[length] = n
    runs, _ = plan(counts, capacity)
    salts = max(1, int(counts.max()) // PER_SALT)
    salted = pieces.withColumn("_salt", F.pmod(F.col(salt_col), F.lit(salts)))
    by_salt = salted.groupBy(length_col, "_salt").agg(F.count("*").alias("_n"))
    before = by_salt.withColumn("_before", F.sum("_n").over(Window.partitionBy(length_col).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1))).drop("_n")
    ordered = Window.partitionBy(length_col, "_salt").orderBy(salt_col, *[c for c in pieces.columns if c not in (length_col, salt_col)])
    ranked = salted.withColumn("_rank", F.row_number().over(ordered) - 1).join(before, [length_col, "_salt"]).withColumn("_rank", F.col("_rank") + F.coalesce("_before", F.lit(0)))
    table = {}
    for r in runs:
        table.setdefault(r.length, []).append((r.first_rank, r.first_sequence, r.per_sequence, r.offset))
    table = {k: np.array(v, dtype=np.int64).T for k, v in table.items()}
    keep = [c for c in pieces.columns if c != salt_col]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in (length_col, "_rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                first, base, per, at = table[int(length[group[0]])]
                k = np.searchsorted(first, rank[group], side="right") - 1
                step = rank[group] - first[k]
                sequence[group] = base[k] + step // per[k]
                offset[group] = at[k] + step % per[k] * length[group]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in keep], pa.array(sequence), pa.array(offset)], names=[*keep, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name != salt_col)
    return ranked.select(*keep, "_rank").mapInArrow(place, f"{schema}, sequence_id long, offset long")


def token_pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, salt (the piece's number within its task)."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end, done = encoder(tokenizer or tokenizer_path(), False), end_id.to_bytes(4, "little"), 0
        for batch in batches:
            take, piece, start, length, crc = [], [], [], [], []
            for row, got in enumerate(encoded(bpe, batch.column(1))):
                got.append(end)
                ids = b"".join(got)
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    take.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            salt = np.arange(done, done + len(take))
            done += len(take)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(take, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(salt, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32", "salt"])

    return pick(df, doc_id=id_col, text=text_col).mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, salt long")


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pack every document's ids, each document ended by `end_id`, into sequences of at most `capacity` ids.

    Only documents longer than `capacity` are cut, into pieces of that length; the last may be shorter. Null and empty
    texts are one `end_id`. Repeated rows and rows without an id are packed once each; which of several equal pieces
    takes which place is arbitrary but every place is taken once; an empty table gives none; other columns are ignored.
    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    return pack_lengths(materialise(token_pieces(df, id_col, text_col, capacity, tokenizer, end_id), "pieces"), capacity)
