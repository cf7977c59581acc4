"""Hashes of the words and word shingles of whole texts, computed for many texts at once.

A word is a run of bytes other than space and 0x09 to 0x0D; A-Z count as a-z. The hash of a
word is a polynomial of its bytes modulo 2^64, taken from prefix sums and then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that are hashed at once; a longer text is taken in segments that end at white space.
SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, from 0 to n."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the offset of each text; null is an empty text."""
    column = pc.fill_null(column, "") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, kind)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets.astype(np.int64)


def _hashed(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts ``data[cuts[i]:cuts[i + 1]]`` and each text's first word."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(cuts), np.int64)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = cuts[:-1][cuts[:-1] < len(data)]
    first[at] = inside[at]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    words = (sums[ends] - sums[starts]) * down[starts]
    return mix(words ^ (ends - starts).astype(np.uint64)), np.searchsorted(starts, cuts)


def word_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: number of the first one, word hashes, and where each text's begin."""
    data, offsets = text_bytes(column)
    at = 0
    while at < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[at] + SEGMENT, "right")) - 1
        if end > at:
            part = data[offsets[at] : offsets[end]]
            yield at, *_hashed(part, offsets[at : end + 1] - offsets[at])
            at = end
            continue
        parts, low, high = [], int(offsets[at]), int(offsets[at + 1])
        while low < high:
            cut = min(low + SEGMENT, high)
            while cut < high and not _SPACE[data[cut]]:
                cut += 1
            part = data[low:cut]
            parts.append(_hashed(part, np.array([0, len(part)]))[0])
            low = cut
        found = np.concatenate(parts)
        yield at, found, np.array([0, len(found)])
        at += 1


def shingles(words: np.ndarray, length: int) -> np.ndarray:
    """Distinct hashes of the shingles of one text; a shorter text is one shingle as a whole."""
    if not len(words):
        return words
    length = min(length, len(words))
    n = len(words) - length + 1
    total = np.full(n, length, np.uint64)
    for i in range(length):
        total = mix(total * np.uint64(_BASE) + words[i : i + n])
    return np.unique(total)


def shingle_sets(column: pa.Array, length: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text in turn, in ascending order."""
    for _, words, begins in word_hashes(column):
        for low, high in zip(begins[:-1], begins[1:], strict=True):
            yield shingles(words[low:high], length)
