"""Words of UTF-8 texts as 64-bit hashes, many texts at once, inside a task.

A text is a run of bytes; separators are single ASCII bytes, so cutting bytes cuts characters rightly.
Hashes depend on nothing but the bytes of a word: equal on every worker and in every run.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SPACES = bytes([0x20, *range(0x09, 0x0E)])
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Texts are worked on in blocks of about so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 1 << 18
_FACTOR = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_FACTOR))
    for lower in range(ord("a"), ord("z") + 1):
        values[lower - 32] = values[lower]
    return values


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_FACTOR, -1, 1 << 64)
    found = []
    for base in (_FACTOR, inverse):
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        found.append(np.cumprod(steps, dtype=np.uint64))
    return found[0], found[1]


@lru_cache(maxsize=8)
def _letters(separators: bytes) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


class Words:
    """Words of a block of texts: ``hash``, byte ``start`` and ``end``, and ``bounds`` of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: bytes = SPACES):
        size = len(data)
        inside = _letters(separators)[data]
        before = np.zeros(size + 1, dtype=bool)
        before[1:] = inside
        before[offsets] = False
        after = np.zeros(size + 1, dtype=bool)
        after[:size] = inside
        after[offsets] = False
        self.start = np.flatnonzero(inside & ~before[:size])
        self.end = np.flatnonzero(inside & ~after[1:]) + 1
        self.bounds = np.searchsorted(self.start, offsets)
        up, self._down = _powers(max(BLOCK_BYTES, 1 << (size + 1).bit_length()))
        self._sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_byte_values()[data] * up[:size], out=self._sums[1:])
        self.hash = self._span(self.start, self.end)

    def _span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._down[start])

    def heads(self, n_bytes: int) -> np.ndarray:
        """Hash of the first ``n_bytes`` bytes of each word (of all of a shorter one)."""
        return self._span(self.start, np.minimum(self.start + n_bytes, self.end))


def blocks(texts: pa.Array, separators: bytes = SPACES) -> Iterator[tuple[int, int, Words]]:
    """(first row, one past the last row, words) for consecutive blocks; a null text counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    _, raw_offsets, raw_data = texts.buffers()
    offsets = np.frombuffer(raw_offsets, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(raw_data, dtype=np.uint8) if raw_data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, side="right")) - 1
        last = min(n, max(last, first + 1))
        own = offsets[first : last + 1]
        yield first, last, Words(data[own[0] : own[-1]], own - own[0], separators)
        first = last


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and their bounds by text.

    A text of fewer words, but some, has one: all of them in order. A text without words has none.
    """
    n_words = np.diff(words.bounds)
    value = np.zeros(len(words.hash), dtype=np.uint64)
    for k in range(size):
        moved = np.zeros_like(value)
        if k < len(value):
            moved[: len(value) - k] = words.hash[k:]
        value = value * np.uint64(_FACTOR) + moved
    counts = np.maximum(n_words - size + 1, np.minimum(n_words, 1))
    bounds = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=bounds[1:])
    where = np.repeat(words.bounds[:-1] - bounds[:-1], counts) + np.arange(bounds[-1])
    found = mix(value[where])
    for row in np.flatnonzero((n_words > 0) & (n_words < size)):
        whole = 0
        for one in words.hash[words.bounds[row] : words.bounds[row + 1]].tolist():
            whole = (whole * _FACTOR + one) & 0xFFFFFFFFFFFFFFFF
        found[bounds[row]] = mix(np.array([whole ^ int(n_words[row])], dtype=np.uint64))[0]
    return found, bounds
