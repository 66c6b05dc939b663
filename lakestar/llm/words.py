"""Words and word hashes of whole texts, as numpy work on Arrow buffers.

A word is ``[^\\x20\\x09-\\x0D]+``; A-Z is lower-cased, nothing else is changed.
A word's hash is a 64-bit polynomial over randomly tabled bytes, so two
different words agree with a chance of about 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_LOWER = np.arange(256)
_LOWER[ord("A"):ord("Z") + 1] += 32
_TABLE = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64)
_BYTE = _TABLE[_LOWER]
_BYTE_CASED = _TABLE
_BASE = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xFF51AFD7ED558CCD)
_S = np.uint64(33)
_powers = np.ones(1, np.uint64)
_LIBC = ctypes.CDLL(None)


def give_back() -> None:
    """Hand freed memory back to the system: a worker lives on, and later stages share its executor."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _S)
    x = x * _M
    return x ^ (x >> _S)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 64), _BASE)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers


def slices(texts: pa.Array, max_bytes: int = 4 << 20) -> Iterator[tuple[int, pa.LargeStringArray]]:
    """(first row, rows) of runs of texts of about max_bytes; a longer text comes alone. Null: empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(off, off[at] + max_bytes, "right")) - 1)
        yield at, texts.slice(at, to - at)
        at = to


def raw(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes in a row, and where each begins (one more for the end)."""
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


@dataclass
class Words:
    buf: np.ndarray      # bytes of all texts
    text_off: np.ndarray  # where each text begins, in bytes
    start: np.ndarray    # of each word, in bytes
    end: np.ndarray
    off: np.ndarray      # of each text, in words

    def counts(self) -> np.ndarray:
        return np.diff(self.off)

    def hashes(self, cased: bool = False) -> np.ndarray:
        n = self.end - self.start
        if not len(n):
            return np.zeros(0, np.uint64)
        first = np.cumsum(n) - n
        within = np.arange(int(n.sum())) - np.repeat(first, n)
        at = within + np.repeat(self.start, n)
        value = (_BYTE_CASED if cased else _BYTE)[self.buf[at]] * powers(int(n.max()))[within]
        return mix(np.add.reduceat(value, first) + n.astype(np.uint64))

    def text_of(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.off) - 1), self.counts())


def words(texts: pa.LargeStringArray) -> Words:
    buf, off = raw(texts)
    inside = ~SPACE[buf]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(inside):
        before[0] = after[-1] = False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        full = off[:-1][np.diff(off) > 0]
        before[full] = False
        after[full[1:] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(buf, off, start, end, np.searchsorted(start, off))


def shingles(w: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each run of ``size`` words; a text of fewer words gives its whole sequence."""
    h, of, counts = w.hashes(), w.text_of(), w.counts()
    n = len(h)
    if n >= size:
        run = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            run = mix(run * _BASE + h[k:n - size + 1 + k] + np.uint64(1))
        whole = of[size - 1:] == of[:n - size + 1]
        run, at = run[whole], of[:n - size + 1][whole]
    else:
        run, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = counts[short] > k
            step = mix(extra[has] * _BASE + h[w.off[short[has]] + k] + np.uint64(1))
            extra[has] = step
        extra = mix(extra + counts[short].astype(np.uint64) + np.uint64(7))
        run, at = np.concatenate([run, extra]), np.concatenate([at, short])
    return at, run
