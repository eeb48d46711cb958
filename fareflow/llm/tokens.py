"""Vectorised words of a chunk of texts: byte ranges and 64-bit hashes.

All texts of a chunk are one byte array; words are runs of bytes other than
ASCII white space, A-Z lower-cased.  A range's hash comes from prefix sums of
a polynomial over random byte values (mod 2**64, odd base), so the hash of any
range costs a subtraction and a product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes of a word's core: ASCII letters and digits, and all of other scripts.
CORE = np.zeros(256, dtype=bool)
CORE[48:58] = CORE[65:91] = CORE[97:123] = CORE[128:] = True

_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    key = str(base)
    if key not in _powers or len(_powers[key]) < n:
        p = np.full(n, np.uint64(base), dtype=np.uint64)
        p[0] = 1
        _powers[key] = np.cumprod(p, dtype=np.uint64)
    return _powers[key][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Final mixing of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Tokens:
    """Words of ``texts`` (nulls are empty): ``start``/``end`` in ``data``,
    ``doc`` (number of the text), ``hash`` per word; ``raw`` keeps the case."""

    def __init__(self, texts: pa.Array):
        parts = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
        self.rows = len(parts)
        self.raw = np.frombuffer(b"".join(p + b"\n" for p in parts), dtype=np.uint8)
        self.data = _LOWER[self.raw]
        sizes = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
        self.doc_end = np.cumsum(sizes)
        self.doc_start = self.doc_end - sizes
        space = _SPACE[self.data]
        edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
        self.start = np.flatnonzero(edge == -1)
        self.end = np.flatnonzero(edge == 1)
        self.doc = np.searchsorted(self.doc_end, self.start, side="right")
        n = len(self.data) + 1
        self._inv = _power(_BASE_INV, n)
        self._sum = np.zeros(n, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[self.data] * _power(_BASE, n)[:-1], dtype=np.uint64, out=self._sum[1:])
        self.hash = self.range_hash(self.start, self.end)
        self.words = np.bincount(self.doc, minlength=self.rows)

    def range_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sum[end] - self._sum[start]) * self._inv[start]
                   + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def cores(self) -> tuple[np.ndarray, np.ndarray]:
        """Words without leading and trailing ASCII punctuation (whole words
        if nothing would stay)."""
        at = np.flatnonzero(CORE[self.data])
        if not len(at):
            return self.start, self.end
        first = at[np.minimum(np.searchsorted(at, self.start), len(at) - 1)]
        last = at[np.maximum(np.searchsorted(at, self.end) - 1, 0)] + 1
        ok = (first >= self.start) & (last <= self.end) & (first < last)
        return np.where(ok, first, self.start), np.where(ok, last, self.end)

    def code_points(self) -> np.ndarray:
        """Code points before each byte, counted over the whole chunk."""
        return np.concatenate([[0], np.cumsum((self.raw & 0xC0) != 0x80)])

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Bytes per text for which ``flags`` holds."""
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[self.doc_end] - total[self.doc_start]
