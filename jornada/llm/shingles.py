"""Sets of word shingles as sorted 64-bit hashes, for whole Arrow batches at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SHINGLE = 5

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_random = np.random.default_rng(5)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _random.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text that are hashed at once; a longer text is hashed by itself.
PIECE_BYTES = 2 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z lower-cased) of texts that lie end to end, and the number of words before each text."""
    solid = ~_BLANK[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | first[1:-1]
    starts = np.flatnonzero(begins)
    counts = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(len(data), dtype=np.int64)
    place[starts[0] :] -= np.repeat(starts, lengths)
    longest = int(lengths.max())
    powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(longest, _STEP)]))
    parts = _BYTE[_LOWER[data]] * powers[np.minimum(place, longest)]
    parts[~solid] = 0
    return mixed(np.add.reduceat(parts, starts)), counts


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, length: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle, one without words has none."""
    words, counts = word_hashes(data, offsets)
    many = len(words) - length + 1
    rolled = np.zeros(max(0, many), np.uint64)
    for k in range(length):
        rolled += words[k : k + len(rolled)] * _PLACE[k % 64] if k < 64 else mixed(words[k : k + len(rolled)] + np.uint64(k))
    rolled = mixed(rolled)
    out = []
    for i in range(len(offsets) - 1):
        a, b = counts[i], counts[i + 1]
        if b - a >= length:
            out.append(np.unique(rolled[a : b - length + 1]))
        elif b > a:
            own = np.uint64(b - a) * _PLACE[63]
            for k in range(b - a):
                own = mixed(own + words[a + k] * _PLACE[k % 64])
            out.append(np.array([own], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sets_of(column: pa.Array):
    """The shingle set of each string of an Arrow column, nulls as empty texts; pieces of the column at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    n = len(column)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    with np.errstate(over="ignore"):
        while i < n:
            j = max(i + 1, int(np.searchsorted(at, at[i] + PIECE_BYTES)) - 1)
            j = min(j, n)
            yield from shingle_hashes(raw[at[i] : at[j]], at[i : j + 1] - at[i])
            i = j
