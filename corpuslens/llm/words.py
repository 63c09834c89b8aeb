"""Whole texts as numpy arrays of words and shingles, used inside Arrow tasks.

Texts are handled as UTF-8 bytes: the separators `[\\x20\\x09-\\x0D]` are ASCII, so a word is a run of
other bytes. Everything works on slices of a few MB, so memory follows the slice, not the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1_000_000
SHINGLE_WORDS = 5

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_rng = np.random.default_rng(0x5EED)
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES)
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = [
            np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, b, np.uint64)]), dtype=np.uint64)
            for b in (_BASE, inverse)
        ]
    return _POWERS[0], _POWERS[1]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL counts as the empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes, one row at least."""
    i, rows = 0, len(offsets) - 1
    while i < rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, rows)
        i = min(j, rows)


class Words:
    """The words of several texts: byte positions `start`/`stop`, and `first`, where each text's words begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = LOWER[data] if lower else data
        solid = ~SPACE[data]
        begin, end = solid.copy(), solid.copy()
        begin[1:] &= ~solid[:-1]
        end[:-1] &= ~solid[1:]
        full = offsets[1:] > offsets[:-1]
        heads, tails = offsets[:-1][full], offsets[1:][full] - 1
        begin[heads] |= solid[heads]
        end[tails] |= solid[tails]
        self.start, self.stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.start, offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def texts(self) -> np.ndarray:
        """For each word, the row of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.stop)


def span_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every span, in steps of a few MB; spans follow each other without overlap."""
    out, n, a = np.empty(len(start), np.uint64), len(start), 0
    while a < n:
        origin = start[a]
        b = max(a + 1, int(np.searchsorted(stop, origin + SLICE_BYTES, "right")))
        part = _BYTE_CODE[data[origin : stop[b - 1]]]
        power, inverse = _powers(len(part))
        part *= power[: len(part)]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)])
        i, j = start[a:b] - origin, stop[a:b] - origin
        out[a:b] = mix((total[j] - total[i]) * inverse[i] + (j - i).astype(np.uint64))
        a = b
    return out


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words; runs may span texts, the caller leaves those out."""
    n = max(0, len(words) - size + 1)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n]
    return mix(total)


def shingles(words: Words, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text row) of all shingles in text order; a text of fewer words is one shingle of all it has."""
    hashed, counts = words.hashes(), words.counts()
    runs = window_hashes(hashed, size)
    text = words.texts()
    inside = text[: len(runs)] == text[size - 1 :] if len(runs) else np.zeros(0, bool)
    value, owner = runs[inside], text[: len(runs)][inside]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = np.array([_fold(hashed[words.first[t] : words.first[t + 1]]) for t in short], np.uint64)
        value, owner = np.concatenate([value, whole]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        value, owner = value[order], owner[order]
    return value, owner


def _fold(words: np.ndarray) -> np.uint64:
    total = np.uint64(len(words))
    with np.errstate(over="ignore"):
        for w in words:
            total = total * np.uint64(0xD6E8FEB86659FD93) + w
    return mix(np.array([total], np.uint64))[0]
