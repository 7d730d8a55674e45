"""Words and word shingles of Arrow text columns as 64-bit hashes, by whole arrays.

Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return,
after lower-casing A-Z. A word's hash is a polynomial over its bytes, taken from running sums, then
mixed; equal words have equal hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
SHINGLE = 5

_LOW = np.arange(256, dtype=np.uint64)
_LOW[65:91] += 32
_LOW += 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_STEPS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                   0x589965CC75374CC3], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (one-to-one)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Powers:
    """Powers of an odd base modulo 2^64 and their inverses, kept as long as the longest chunk."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up, self.down


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each row starts (one more than rows); null is empty."""
    column = column.cast(pa.large_string())
    starts = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[starts[0]:starts[-1]], starts - starts[0]


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row starts) of runs of rows of about `most` bytes; a longer row stands alone."""
    raw, starts = text_bytes(column)
    first, rows = 0, len(starts) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + most, side="right")) - 1)
        yield first, raw[starts[first]:starts[last]], starts[first:last + 1] - starts[first]
        first = last


def word_spans(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each row (one more than rows)."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
    space = _SPACE[raw]
    cut = np.zeros(len(raw) + 1, dtype=bool)
    cut[starts] = True
    begin, end = ~space, np.empty(len(raw), dtype=bool)
    end[:-1] = begin[:-1] & (space[1:] | cut[1:-1])
    end[-1] = begin[-1]
    begin[1:] &= space[:-1] | cut[1:-1]
    first = np.flatnonzero(begin)
    return first, np.flatnonzero(end) + 1, np.searchsorted(first, starts)


def word_hashes(raw: np.ndarray, starts: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words before each row (one more than rows)."""
    begin, end, before = word_spans(raw, starts)
    return span_hashes(raw, begin, end, powers), before


def span_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """Hashes of words given by where they begin and end."""
    up, down = powers.to(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_LOW[raw] * up[:len(raw)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def long_hash(raw: np.ndarray, powers: Powers, most: int = CHUNK_BYTES) -> np.uint64:
    """The hash that `span_hashes` gives a word, summed block by block, for words too long for whole arrays."""
    total = 0
    for lo in range(0, len(raw), most):
        part = raw[lo:lo + most]
        own = int((_LOW[part] * powers.to(len(part))[0][:len(part)]).sum(dtype=np.uint64))
        total += own * pow(_BASE, lo, 1 << 64)
    return mix(np.array([(total + len(raw)) % (1 << 64)], dtype=np.uint64))[0]


def word_ends(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, kinds: int) -> np.ndarray:
    """A number below `kinds` for each word, by its last two bytes."""
    last = _LOW[raw[end - 1]]
    other = np.where(end - begin > 1, _LOW[raw[np.maximum(end - 2, 0)]], 0) if len(end) else last
    return ((last * 31 + other) % kinds).astype(np.int64)


def shingle_sets(raw: np.ndarray, starts: np.ndarray, powers: Powers) -> list[np.ndarray]:
    """Sorted distinct hashes of each row's 5-word shingles.

    Fewer words are one shingle of the whole sequence; no words are the empty set.
    """
    words, before = word_hashes(raw, starts, powers)
    sums = np.zeros(max(0, len(words) - SHINGLE + 1), dtype=np.uint64)
    for j in range(SHINGLE):
        sums += words[j:j + len(sums)] * _STEPS[j]
    sums = mix(sums)
    sets = []
    for first, last in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        n = last - first
        if n >= SHINGLE:
            part = np.sort(sums[first:last - SHINGLE + 1])
            keep = np.empty(len(part), dtype=bool)
            keep[0] = True
            np.not_equal(part[1:], part[:-1], out=keep[1:])
            sets.append(part[keep])
        elif n:
            one = (words[first:last] * _STEPS[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n)
            sets.append(mix(one))
        else:
            sets.append(sums[:0])
    return sets
