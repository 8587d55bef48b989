"""Vectorised scans over the UTF-8 bytes of Arrow string columns.

Used inside ``mapInArrow`` tasks: words, word hashes and shingle hashes are
numpy arrays over a slice of a batch, never Python strings. Slices are cut at
document borders and hold at most ``SLICE_BYTES`` (a single longer document
makes its own slice), so a task's memory does not follow the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


#: One random-looking 64-bit value per byte.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for i, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, _U)
            p[0] = 1
            with np.errstate(over="ignore"):
                _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets) of slices of a string column, of at most
    ``size`` bytes or one row; null counts as empty."""
    col = pc.fill_null(column, "").cast(pa.large_string())
    n = len(col)
    if n == 0:
        return
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64, n + 1, col.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + size, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


class Words:
    """Words of a slice, split at ASCII white space (0x20, 0x09-0x0D).

    ``start``/``end`` are byte positions, ``row`` the document of each word,
    ``first`` (length rows + 1) the index of each document's first word and
    ``hash`` a 64-bit hash of each word's bytes.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool) -> None:
        data = _LOWER[data] if lower else data
        word = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.ones(len(data), bool)
        before[1:] = ~word[:-1]
        self.start = np.flatnonzero(word & (before | edge[:-1]))
        after = np.ones(len(data), bool)
        after[:-1] = ~word[1:]
        self.end = np.flatnonzero(word & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        up, down = _powers_to(len(data) + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(len(data) + 1, _U)
            np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
            h = (total[self.end] - total[self.start]) * down[self.start]
            self.hash = mix(h + (self.end - self.start).astype(_U) * _U(0xA24BAED4963EE407))

    def windows(self, length: int, salt: int = 0) -> np.ndarray:
        """Hash of the ``length`` consecutive words from each word on, whatever
        document they lie in; see ``whole`` for which of them are whole."""
        h = self.hash
        n = len(h) - length + 1
        if n <= 0:
            return np.zeros(0, _U)
        base = pow(_BASE + 2 * salt, 3, 1 << 64)
        with np.errstate(over="ignore"):
            out = np.zeros(n, _U)
            for j in range(length):
                out = out * _U(base) + h[j:j + n]
        return mix(out + _U(salt * 2 + 1))

    def whole(self, length: int) -> np.ndarray:
        """Whether the window of ``length`` words from each word on lies in one document."""
        n = len(self.hash) - length + 1
        if n <= 0:
            return np.zeros(0, bool)
        return self.row[:n] == self.row[length - 1:]


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
