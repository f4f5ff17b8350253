"""Vectorised words and shingles of many texts at once, for use inside tasks.

A word is ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. Its 64-bit name is a polynomial over random byte
values, taken from prefix sums, so cutting and naming cost a few array operations for each byte. Words of over
LONG bytes are named by a keyed digest, as long texts can be built on which such polynomials agree.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64)[_LOWER] | U(1)
_powers = np.ones(1, U), np.ones(1, U)
SLICE_BYTES = 1 << 20
LONG = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + SLICE_BYTES // 4)
        tables = []
        for b in (_BASE, _INVERSE):
            x = np.full(size, U(b))
            x[0] = 1
            tables.append(np.cumprod(x, dtype=U))
        _powers = tables[0], tables[1]
    return _powers


def runs(texts: Iterable[bytes], size: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts) of runs of about ``size`` bytes."""
    first, held, n = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t)
        n += len(t)
        if n >= size:
            yield first, held
            first, held, n = i + 1, [], 0
    if held:
        yield first, held


class Words:
    """Words of a run of texts: ``names`` (uint64), ``start``/``end`` in ``buffer``, and ``first``: text i has words first[i]:first[i + 1]."""

    def __init__(self, texts: list[bytes]):
        raw = b"\n".join(texts) + b"\n"
        self.buffer = np.frombuffer(raw, np.uint8)
        space = _SPACE[self.buffer]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[::2], edge[1::2]
        up, down = _power_tables(len(raw))
        total = np.zeros(len(raw) + 1, U)
        np.cumsum(_VALUE[self.buffer] * up[: len(raw)], out=total[1:])
        self.names = mix((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(U))
        for i in np.flatnonzero(self.end - self.start > LONG):
            self.names[i] = U(int.from_bytes(hashlib.blake2b(self.word(i), digest_size=8, key=b"word").digest(), "little"))
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.first = np.concatenate(([0], np.searchsorted(self.start, ends)))

    def word(self, i: int) -> bytes:
        return _LOWER[self.buffer[self.start[i] : self.end[i]]].tobytes()

    def shingles(self, k: int) -> list[np.ndarray]:
        """The distinct k-word shingles of each text, ascending; of fewer words the whole sequence as one; of none nothing."""
        names, n = self.names, len(self.names)
        rolled = np.zeros(max(n - k + 1, 0), U)
        for j in range(k):
            rolled = mix(rolled * U(3) + names[j : n - k + 1 + j]) if n >= k else rolled
        out = []
        for a, b in zip(self.first[:-1], self.first[1:], strict=True):
            if b - a >= k:
                out.append(np.unique(rolled[a : b - k + 1]))
            elif b > a:
                x = np.zeros(1, U)
                for name in names[a:b]:
                    x = mix(x * U(3) + name)
                out.append(mix(x + U(b - a)))
            else:
                out.append(np.zeros(0, U))
        return out


def as_bytes(texts) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [t.encode() if isinstance(t, str) else b"" for t in texts]


def give_back() -> None:
    """Return what a Python worker holds without using it: objects, Arrow's pool, the C library's heap. For the end of a task, as workers live on beside the next stage's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
