"""Words and word shingles of many texts at once, as 64-bit hashes in numpy."""

from __future__ import annotations

import numpy as np

U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes between words that are runs of letters, digits and non-ASCII characters.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_tables: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def randoms(name: str, n: int) -> np.ndarray:
    """At least n odd 64-bit numbers, the same in every process: mixed counters."""
    have = _tables.get(name)
    if have is None or len(have) < n:
        seed = np.frombuffer(name.encode().ljust(8, b"\0")[:8], np.uint64)[0]
        size = 1 << max(10, int(n - 1).bit_length())
        have = _tables[name] = mix(np.arange(1, size + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15) + seed) | U(1)
    return have


def word_hashes(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, A-Z lower-cased, and each text's bounds in them.

    ``between`` marks the bytes outside words, by default \\x20 and \\x09-\\x0D.
    """
    if not len(data):
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    inside = ~between[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    lengths = np.diff(np.append(starts, len(data)))
    at = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    values = randoms("bytes", 256)[_LOWER[data[starts[0] :]]] * randoms("places", int(lengths.max()))[at]
    values[~inside[starts[0] :]] = 0
    return mix(np.add.reduceat(values, starts - starts[0])), np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words; a text of fewer words, but not none, has one of them all."""
    n = np.diff(bounds)
    counts = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    ends = np.concatenate(([0], np.cumsum(counts)))
    if not ends[-1]:
        return np.zeros(0, U), ends
    at = np.arange(ends[-1]) - np.repeat(ends[:-1], counts) + np.repeat(bounds[:-1], counts)
    last = np.repeat(bounds[1:], counts)
    total, factors = np.zeros(ends[-1], U), randoms("shingle", k)
    for j in range(k):
        total += np.where(at + j < last, words[np.minimum(at + j, len(words) - 1)] * factors[j], U(0))
    return mix(total), ends
