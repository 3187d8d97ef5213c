"""Vectorised word and byte hashing of text batches.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``. A batch of texts
is one byte array (texts separated by a newline, which is no part of a word),
so words, word hashes and word n-gram hashes are a few array operations.
"""

from __future__ import annotations

import ctypes
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; bounds the arrays of a Python worker.
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_pow: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix64(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow[0]) < n:
        m = max(n, SLICE_BYTES * 5 // 4)
        for k, base in enumerate((_BASE, _BASE_INV)):
            steps = np.full(m, base, np.uint64)
            steps[0] = 1
            _pow[k] = np.cumprod(steps)
    return _pow[0], _pow[1]


@dataclass
class Words:
    """Words of a slice of texts: byte spans in ``data`` and the text's index."""

    data: np.ndarray          # uint8, all texts
    start: np.ndarray         # of each word
    end: np.ndarray
    doc: np.ndarray           # index of the text of each word
    first: np.ndarray         # index of the first word of each text, and the total

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def position(self) -> np.ndarray:
        """Position of each word in its text."""
        return np.arange(len(self.start)) - self.first[self.doc]

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        up, down = _powers(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], out=sums[1:])
        h = (sums[self.end] - sums[self.start]) * down[self.start]
        return mix64(h + (self.end - self.start).astype(np.uint64))


def words_of(texts: list[bytes], lower: bool = False) -> Words:
    """Split texts into words; ``lower`` maps A-Z to a-z first."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    if lower:
        data = _LOWER[data]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    first = np.searchsorted(start, begins)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(data, start, end, doc, first)


def grams(h: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``n`` consecutive items (``len(h) - n + 1`` of them)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = mix64(h, salt) if salt else h
    acc = h[:m].copy()
    for k in range(1, n):
        acc *= _GRAM
        acc += h[k:k + m]
    return mix64(acc)


def lowered(words: Words) -> Words:
    """The same words with A-Z mapped to a-z."""
    return Words(_LOWER[words.data], words.start, words.end, words.doc, words.first)


def gram_starts(words: Words, n: int) -> np.ndarray:
    """Word indexes at which a run of ``n`` words inside one text starts."""
    room = words.first[words.doc + 1] - np.arange(len(words.doc)) if len(words.doc) else np.zeros(0, int)
    return np.flatnonzero(room >= n)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
_released = 0.0


def release_memory(every: float = 0.5) -> None:
    """Give memory of arrays that are no longer used back to the system: a
    worker lives through many tasks, and what the allocator keeps adds up."""
    global _released
    if time.monotonic() - _released > every:
        pa.default_memory_pool().release_unused()
        if _trim:
            _trim(0)
        _released = time.monotonic()


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; NULL is empty. Each batch begins with it,
    so memory of the batch before is released here."""
    release_memory()
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of at most ``limit`` bytes (or one text)."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(t) + 1
    if texts:
        yield begin, len(texts)


def first_of_each(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of the key tuples, and a mask of each tuple's first in it."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
        for k in keys:
            s = k[order]
            new[1:] |= s[1:] != s[:-1]
    return order, new


def contains(sorted_keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of ``x`` are among ``sorted_keys``."""
    if not len(sorted_keys):
        return np.zeros(len(x), bool)
    at = np.searchsorted(sorted_keys, x)
    at[at == len(sorted_keys)] = 0
    return sorted_keys[at] == x
