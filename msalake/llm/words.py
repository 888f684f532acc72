"""Words of whole texts as numpy arrays, a batch of documents at a time.

A word is ``[^\\x20\\x09-\\x0D]+``. Each word, and each run of words, has a 64-bit polynomial value modulo 2**64 over
random byte values, mixed at the end, so that equal word sequences have equal values wherever they stand.
Memory is bounded by ``BLOCK`` bytes of text at a time, or one document where it is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
STEM = 5
_RANDOM = np.random.RandomState(20240607)
_BYTE = _RANDOM.randint(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,;:!?\"'()"]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _inverse(p: np.uint64) -> np.uint64:
    return np.uint64(pow(int(p), -1, 1 << 64))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = np.cumprod(steps, dtype=np.uint64)
        if n <= 4 * BLOCK:
            _POWERS[int(base)] = known
    return known[:n]


def ranges(values: np.ndarray, base: np.uint64 = _Q) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and inverse powers for :func:`of_range`."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, len(values)), dtype=np.uint64, out=sums[1:])
    return sums, _powers(_inverse(base), max(len(values), 1))


def of_range(pre: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed value of the items ``start`` to ``end``, end exclusive, whatever stands before them."""
    sums, back = pre
    return mix((sums[end] - sums[start]) * back[np.minimum(start, len(back) - 1)] + mix((end - start).astype(np.uint64)))


class Block:
    """Words of some documents: ``value`` per word, ``first[i]:first[i + 1]`` the words of document ``i``.

    ``trim`` takes punctuation off both ends and adds ``stem``, the value of a word's first ``STEM`` bytes.
    """

    def __init__(self, data: np.ndarray, borders: np.ndarray, lower: bool, trim: bool = False):
        if lower:
            data = _LOWER[data]
        space = _SPACE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[borders[:-1]] = True
        inside = ~space
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | cut[:-1]))
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        cut[borders[1:]] = True
        ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        pre = ranges(_BYTE[data], _P)
        if trim:  # up to four marks at the end and two at the start, never the whole word
            for _ in range(4):
                ends = ends - (_MARK[data[ends - 1]] & (ends - starts > 1))
            for _ in range(2):
                starts = starts + (_MARK[data[starts]] & (ends - starts > 1))
            self.stem = of_range(pre, starts, np.minimum(starts + STEM, ends))
        self.data, self.starts, self.ends = data, starts, ends
        self.value = of_range(pre, starts, ends)
        self.first = np.searchsorted(starts, borders)
        self.n = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        self._pre: tuple | None = None

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Start words of all ``k``-word windows inside one document, and their values."""
        last = np.maximum(self.n - k + 1, 0)
        start = np.arange(len(self.value))
        start = start[start - self.first[:-1][self.doc] < last[self.doc]] if len(start) else start
        return start, self.span(start, start + k)

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if self._pre is None:
            self._pre = ranges(self.value)
        return of_range(self._pre, start, end)


def blocks(texts: pa.Array, lower: bool = False, trim: bool = False) -> Iterator[tuple[int, int, Block]]:
    """``(from, to, Block)`` over an Arrow string column; NULL counts as no words."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks)
    big = texts.cast(pa.large_string())
    if big.null_count:
        big = big.fill_null("")
    n = len(big)
    _, offsets, body = big.buffers()
    off = np.frombuffer(offsets, np.int64, n + 1 + big.offset)[big.offset:] if offsets else np.zeros(1, np.int64)
    data = np.frombuffer(body, np.uint8) if body else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + BLOCK, "right")) - 1)
        to = min(to, n)
        yield at, to, Block(data[off[at]:off[to]], off[at:to + 1] - off[at], lower, trim)
        at = to


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
