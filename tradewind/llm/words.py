"""Words and their hashes with numpy: what the operators' Python tasks share.

Texts are handled as UTF-8 bytes. A word is a maximal run of bytes that a table of 256 flags calls word
bytes; bytes from 0x80 on belong to words in both tables, so runs of characters and of bytes agree.
"""

from __future__ import annotations

import numpy as np

#: Word bytes of `[^\\x20\\x09-\\x0D]+`: everything but white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Word bytes of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` in lower-cased text: digits, a to z, and all beyond ASCII.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_ODD = 0x9E3779B97F4A7C15
#: Places of a word whose powers are kept; those of longer words are products of two.
_PLACES = 1 << 12
_powers = np.cumprod(np.full(_PLACES, _ODD, dtype=np.uint64), dtype=np.uint64)


def _weighted(value: np.ndarray, place: np.ndarray, longest: int) -> np.ndarray:
    """Each value times the power of its place in its word."""
    if longest <= _PLACES:
        return value * _powers[place]
    steps = np.cumprod(np.append(np.uint64(1), np.full((longest - 1) // _PLACES, _powers[-1], dtype=np.uint64)), dtype=np.uint64)
    return value * _powers[place & (_PLACES - 1)] * steps[place // _PLACES]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_spans(data: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every word, and the byte after its last."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = word_bytes[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, word_bytes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, given where the words start."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    first = int(starts[0])
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(first, len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
    # Bytes between words count as 0 and so add nothing.
    value = np.where(word_bytes, np.arange(1, 257), 0).astype(np.uint64)[data[first:]]
    return mixed(np.add.reduceat(_weighted(value, place, int(lengths.max())), starts - first))


def hashed_words(text: bytes | None, word_bytes: np.ndarray = NOT_SPACE) -> np.ndarray:
    """Hashes of the words of a text in which A to Z count as a to z. None has no words."""
    if not text:
        return np.zeros(0, dtype=np.uint64)
    data = np.frombuffer(text.lower(), dtype=np.uint8)
    return word_hashes(data, word_spans(data, word_bytes)[0], word_bytes)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words; a text of fewer words has one run, of all it has (if any)."""
    n = len(hashes)
    if not n:
        return hashes
    size = min(size, n)
    out = np.zeros(n - size + 1, dtype=np.uint64)
    for i in range(size):
        out = (out ^ hashes[i : n - size + 1 + i]) * np.uint64(_ODD)
        out ^= out >> np.uint64(29)
    return mixed(out)


def occurrences(values: np.ndarray) -> np.ndarray:
    """How often each value stood before."""
    if not len(values):
        return np.zeros(0, dtype=np.uint64)
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    fresh = np.append(True, ranked[1:] != ranked[:-1])
    begin = np.maximum.accumulate(np.where(fresh, np.arange(len(ranked)), 0))
    times = np.empty(len(values), dtype=np.uint64)
    times[order] = (np.arange(len(ranked)) - begin).astype(np.uint64)
    return times


def occurrence_labelled(values: np.ndarray) -> np.ndarray:
    """Each value with how often it stood before: equal values become different ones, alike in every text."""
    times = occurrences(values)
    return np.where(times > 0, mixed(values + times * np.uint64(_ODD)), values)
