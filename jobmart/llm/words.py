"""Words of Arrow text columns as NumPy arrays: positions, document numbers and 64-bit hashes.

Texts stay UTF-8 bytes.  All separators are ASCII, so a byte test finds the same words as a test of
code points.  Memory is bounded: the per-byte work runs over slices of about ``SLICE`` bytes, cut
between words, and only per-word arrays are kept.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 20

_BYTES = np.arange(256, dtype=np.uint8)
#: Words are runs of anything but space and the controls 9 to 13.
SPACED = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Words are runs of digits, letters and everything outside ASCII.
ALNUM = (
    ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
    | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
)
_LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
_RANDOM = np.random.default_rng(20240611)
_CODES = _RANDOM.integers(1, 2**63, size=(2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Words:
    """``start``/``end``: byte positions in ``data``; ``doc``: row of each word; ``first``: for each
    row, the number of its first word (one entry more than rows)."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.first) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.counts())

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()

    def hashes(self, lane: int = 0, upto: int | None = None) -> np.ndarray:
        """One hash for each word, of its first ``upto`` bytes if given."""
        ends = self.end if upto is None else np.minimum(self.end, self.start + upto)
        out = np.empty(len(self.start), dtype=np.uint64)
        codes, base = _CODES[lane], _BASE[lane]
        lo = 0
        while lo < len(out):
            hi = max(lo + 1, int(np.searchsorted(self.start, self.start[lo] + SLICE)))
            lens = ends[lo:hi] - self.start[lo:hi]
            heads = np.concatenate(([0], np.cumsum(lens)[:-1]))
            rel = np.arange(int(lens.sum())) - np.repeat(heads, lens)
            chars = self.data[np.repeat(self.start[lo:hi], lens) + rel]
            terms = codes[chars] * _powers(int(lens.max()), base)[rel]
            out[lo:hi] = np.add.reduceat(terms, heads)
            lo = hi
        return mix(out)


def latin(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to the letters A-Z, a-z and U+00C0 to U+00FF (two bytes, the first of them C3)."""
    pairs = data == 0xC3
    out = (((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)) | pairs
    out[1:] |= pairs[:-1]
    return out


Kind = np.ndarray | Callable[[np.ndarray], np.ndarray]


def words_of(column: pa.Array | pa.ChunkedArray, kind: Kind = SPACED, lower: bool = False) -> Words:
    """Words of each row; a null row has none.  ``kind``: which bytes are in words, by value or as a function of all."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.array([], pa.large_string())
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    raw = column.buffers()[2] if len(column) else None
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.empty(0, dtype=np.uint8)
    offsets = offsets - offsets[0]
    if column.null_count and len(data):  # a null row may own bytes
        nulls = column.is_null().to_numpy(zero_copy_only=False)
        if (np.diff(offsets)[nulls] > 0).any():
            return words_of(pa.array(column.to_pylist(), pa.large_string()), kind, lower)
    if lower:
        data = _LOWER[data]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = kind(data) if callable(kind) else kind[data]
    start, end = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    start[cuts[inside[cuts + 1]]] = True  # a word ends where its row ends
    end[cuts[inside[cuts]] - 1] = True
    starts = np.flatnonzero(start)
    return Words(data, starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets))


def rolling(h: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
    """Hashes of each ``k`` consecutive values (not mixed over the ends: ``len(h) - k + 1`` values)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    base, out, done = _BASE[lane], None, 0
    power, span, step = h, 1, base
    while True:  # joins the spans 1, 2, 4, … that make up k
        if k & span:
            out = power[done:done + n] if out is None else out * step + power[done:done + n]
            done += span
        if 2 * span > k:
            break
        power = power[:-span] * step + power[span:]
        step, span = np.uint64(int(step) ** 2 % 2**64), 2 * span
    return mix(out + np.uint64(k))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[:n], values[width - span:width - span + n])
