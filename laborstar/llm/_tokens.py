"""Words of a batch of texts as numpy arrays (no loop over words).

Words are runs of bytes that are not ASCII white space (``[^\\x20\\x09-\\x0D]+``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PIECE = 1 << 20
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base modulo 2^64, and of its inverse."""
    global _powers
    if len(_powers[0]) < n:
        _powers = tuple(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]).cumprod(dtype=np.uint64)
                        for b in (_BASE, _INVERSE))
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 bounds of its texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, bounds, data = column.buffers()
    at = np.frombuffer(bounds, np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    body = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, at - at[0]


@dataclass
class Words:
    """Words of several texts: byte bounds, a 64-bit hash each, and the first word of every text."""
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray      # n_texts + 1

    @property
    def doc(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans in ascending, disjoint order, from running sums of powers."""
    out = np.zeros(len(start), np.uint64)
    i = 0
    while i < len(start):
        lo = start[i]
        j = max(i + 1, int(np.searchsorted(end, lo + _PIECE, "right")))
        hi = end[j - 1]
        up, down = powers(int(hi - lo) + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:hi - lo], out=sums[1:])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def words(column: pa.Array, lower: bool = False) -> Words:
    data, at = text_bytes(column)
    if lower:
        data = LOWER[data]
    inside = ~SPACE[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cut = at[(at > 0) & (at < len(data))]          # a word never crosses from one text into the next
    opens[cut] |= inside[cut]
    closes[cut - 1] |= inside[cut - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, start, end, span_hashes(data, start, end), np.searchsorted(start, at))
