"""Numpy hashing of words and word shingles, over chunks of UTF-8 texts at once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at once; longer texts go alone, whole.
CHUNK = 1 << 20
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(maxsize=1)
def _powers(size: int) -> np.ndarray:
    out = np.ones(size, dtype=np.uint64)
    out[1:] = 0x9E3779B97F4A7C15
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[list[bytes]]:
    """The column's texts in UTF-8, null as empty, about `size` bytes at a time."""
    part, held = [], 0
    for t in texts:
        raw = t.as_py()
        part.append(raw.encode() if raw else b"")
        held += len(part[-1])
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text, first byte and end in the joined texts (by line feeds) of each word, in order."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    blank = _BLANK[raw]
    before = np.ones(len(raw), dtype=bool)
    before[1:] = blank[:-1]
    starts = np.flatnonzero(~blank & before)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    after = np.ones(len(raw), dtype=bool)
    after[:-1] = blank[1:]
    ends = np.flatnonzero(~blank & after) + 1
    spans = np.diff(np.append(starts, len(raw)))
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, spans)
    powers = _powers(1 << max(10, int(place.max()).bit_length()))
    value = np.where(blank, 0, raw.astype(np.uint64) + np.uint64(1))[starts[0] :].astype(np.uint64)
    h = mix(np.add.reduceat(value * powers[place], starts - starts[0]) + (ends - starts).astype(np.uint64))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return h, np.searchsorted(bounds, starts, side="right"), starts, ends


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` words (there are len(h) - width + 1)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out = mix(out + h[k : k + n]) if width <= 8 else out * np.uint64(0xD1342543DE82EF95) + h[k : k + n]
    return out if width <= 8 else mix(out)


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """Each text's distinct shingles, sorted: the whole sequence of a text with fewer words; none without words."""
    h, owner, _, _ = word_hashes(texts)
    runs = rolling(h, width)
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for i, j in zip(first[:-1].tolist(), first[1:].tolist()):
        if j - i >= width:
            out.append(np.unique(runs[i : j - width + 1]))
        elif j > i:
            short = np.uint64(j - i)
            for x in h[i:j]:
                short = mix(np.array([x], dtype=np.uint64) + short)[0]
            out.append(np.array([short], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
