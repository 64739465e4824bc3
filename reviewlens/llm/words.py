"""Words of UTF-8 texts in numpy: positions and 64-bit hashes, without a Python object for each word.

A word is a run of bytes other than space and \\x09-\\x0D.  A word's hash is a
polynomial over its bytes (each mapped to a random 64-bit value) modulo 2**64,
mixed at the end.  Two given words share it with a chance of about 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True
_TABLE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TABLE[IS_SPACE] = 0
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 18
GROUP_BYTES = 1 << 20
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        m = max(n, _BLOCK) + 1
        tables = []
        for r in (_BASE, pow(_BASE, -1, 1 << 64)):
            t = np.full(m, r, np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t))
        if m > 2 * _BLOCK:
            return tables
        _powers[:] = tables
    return _powers


def split(data: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte after the last, hash) of every word of ``data`` (uint8); ``lower`` lower-cases A-Z first."""
    firsts, ends, hashes, at, n = [], [], [], 0, len(data)
    table = _LOWER if lower else _TABLE
    while at < n:
        to = min(at + _BLOCK, n)
        if to < n:  # a block ends after a space
            cut = np.flatnonzero(IS_SPACE[data[at:to]])
            while not len(cut) and to < n:
                more = min(to + _BLOCK, n)
                cut = np.flatnonzero(IS_SPACE[data[to:more]]) + (to - at)
                cut, to = cut[:1], more
            if len(cut):
                to = at + int(cut[-1]) + 1
        b = data[at:to]
        space = np.ones(len(b) + 2, np.int8)
        space[1:-1] = IS_SPACE[b]
        edge = np.diff(space)
        first, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if len(first):
            power, inverse = _power_tables(len(b))
            total = np.zeros(len(b) + 1, np.uint64)
            np.cumsum(table[b] * power[:len(b)], out=total[1:])
            h = (total[end] - total[first]) * inverse[first]
            hashes.append(mix(h + (end - first).astype(np.uint64)))
            firsts.append(first + at)
            ends.append(end + at)
        at = to
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(firsts), np.concatenate(ends), np.concatenate(hashes)


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows: what a task holds at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def give_back() -> None:
    """Return freed memory to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # no glibc
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, giving back its memory when it ends: worker processes live on beside the executor's heap."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


class Group:
    """Some neighbouring texts, joined by \\n: ``data`` (uint8); text i is data[at[i]:at[i + 1] - 1]."""

    def __init__(self, first: int, texts: list[bytes]):
        self.first, self.texts = first, texts
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(x) + 1 for x in texts], out=self.at[1:])

    def words(self, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """first byte, byte after the last, hash, and (len(texts) + 1) where each text's words begin."""
        first, end, h = split(self.data, lower)
        return first, end, h, np.searchsorted(first, self.at)

    def counts(self, mask: np.ndarray) -> np.ndarray:
        """How often ``mask`` (a flag for each byte) holds in each text."""
        total = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return np.diff(total[self.at])


def groups(texts: list[bytes], size: int = GROUP_BYTES) -> Iterator[Group]:
    """All texts in order, in groups of about ``size`` bytes (a longer text is a group of its own)."""
    lo, held = 0, 0
    for i, x in enumerate(texts):
        if held and held + len(x) > size:
            yield Group(lo, texts[lo:i])
            lo, held = i, 0
        held += len(x)
    if lo < len(texts):
        yield Group(lo, texts[lo:])


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """The distinct hashes of ``width``-word shingles of one text, sorted; with fewer words the whole sequence is one."""
    n = len(h)
    if not n:
        return h
    w = min(width, n)
    s = np.full(n - w + 1, w if w < width else 0, np.uint64)
    for k in range(w):
        s = mix(s * np.uint64(_BASE) + h[k:n - w + 1 + k])
    return np.unique(s)
