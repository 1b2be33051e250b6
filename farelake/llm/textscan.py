"""Vectorised word scanning of Arrow text batches.

The operators that read whole texts work on the UTF-8 bytes of an Arrow string
column at once: words, lines and their 64-bit hashes come out of numpy passes
over the buffer, not out of per-word Python code. A batch is cut into slices of
at most ``SLICE_BYTES`` (one row at least), which bounds the memory of a task.

A word is a maximal run of bytes outside ``0x20`` and ``0x09..0x0D``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_R = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_R_INV = pow(_R, -1, 1 << 64)
_MASK = (1 << 64) - 1

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept and extended per process."""
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        row = np.full(size, base, np.uint64)
        row[0] = 1
        have = _powers[str(base)] = np.multiply.accumulate(row)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser; spreads a hash over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of codes[start:end] for every span, from one prefix sum."""
    n = len(codes)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _power(_R, n), out=total[1:])
    h = (total[ends] - total[starts]) * _power(_R_INV, n + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Order-sensitive hash of every n consecutive hashes (len(h) - n + 1 of them)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(m, n, np.uint64)
    for j in range(n):
        out = (out ^ h[j:j + m]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(29)
    return mix(out)


class Scan:
    """Bytes of some texts, one behind the other, with their word boundaries."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.n = data, offsets, len(offsets) - 1
        word = ~SPACE[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        last = word.copy()
        last[:-1] &= ~word[1:]
        inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
        first[inner] = word[inner]
        last[inner - 1] = word[inner - 1]
        self.is_word = word
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        #: words of text i are ptr[i] .. ptr[i + 1]
        self.ptr = np.searchsorted(self.starts, offsets)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Number of set bytes of each text."""
        total = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def word_hashes(self, lower: bool = False) -> np.ndarray:
        return span_hashes(LOWER[self.data] if lower else self.data, self.starts, self.ends)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    o = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    o = o.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[o[0]:o[-1]] if len(o) else raw, o - (o[0] if len(o) else 0)


def cuts(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, one row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def scans(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Scan]]:
    """(first row, end row, Scan) over a text column, in slices of bounded size."""
    data, offsets = text_buffers(column)
    for a, b in cuts(offsets, limit):
        yield a, b, Scan(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
