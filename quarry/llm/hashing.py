"""Vectorised 64-bit hashes of words and word sequences, for Arrow batches of texts.

Words are runs of bytes other than ASCII space and \\x09-\\x0D.  A word's hash
is a polynomial over random values of its bytes, a sequence's a polynomial
over its word hashes, all modulo 2**64 and mixed at the end; sequences are
differences of prefix sums, so every window costs the same few operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text that are hashed at once; a longer text is taken whole.
PART_BYTES = 2 << 20

_SPACES = [9, 10, 11, 12, 13, 32]
_VALUES = np.random.default_rng(20_240_601).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_VALUES[_SPACES] = 0
_LOWERED = _VALUES.copy()
_LOWERED[65:91] = _VALUES[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[_SPACES] = True
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


class _Powers:
    """Powers of an odd base modulo 2**64, grown as needed."""

    def __init__(self, base: int):
        self.base, self.values = U(base % (1 << 64)), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            grown = np.full(max(n, 2 * len(self.values)), self.base, np.uint64)
            grown[0] = 1
            self.values = np.multiply.accumulate(grown)
        return self.values[:n]


_BYTE_POWERS, _WORD_POWERS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)
_WORD_INVERSE = _Powers(pow(_WORD_BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@dataclass
class WordHashes:
    """Words of some texts: where each text's words start (one more at the end), and prefix sums over all."""

    first: np.ndarray
    sums: np.ndarray

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.first)

    def sequences(self, start: np.ndarray, length) -> np.ndarray:
        """Hashes of the word sequences of ``length`` from ``start``."""
        raw = (self.sums[start + length] - self.sums[start]) * _WORD_INVERSE.upto(len(self.sums))[start]
        return mix(raw + np.asarray(length).astype(np.uint64) * U(0xA0761D6478BD642F))


def hash_words(data: np.ndarray, offsets: np.ndarray, lower: bool) -> WordHashes:
    """Hash the words of texts that lie one after another in ``data``."""
    n = len(data)
    space = _IS_SPACE[data]
    begins = np.empty(n, bool)
    begins[:1] = True
    begins[1:] = space[:-1]
    begins[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.nonzero(begins & ~space)[0]
    if len(starts):
        sizes = np.diff(np.append(starts, n))
        within = np.arange(starts[0], n) - np.repeat(starts, sizes)
        values = (_LOWERED if lower else _VALUES)[data[starts[0]:]] * _BYTE_POWERS.upto(int(sizes.max()))[within]
        hashes = mix(np.add.reduceat(values, starts - starts[0]))
    else:
        hashes = np.zeros(0, np.uint64)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _WORD_POWERS.upto(len(hashes) + 1)[:len(hashes)], out=sums[1:])
    return WordHashes(np.searchsorted(starts, offsets), sums)


def text_parts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets) of parts of a batch's texts; nulls are empty."""
    col = batch.column(column)
    if len(col) == 0:
        return
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, where, values = col.buffers()
    ends = np.frombuffer(where, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(col):
        upto = max(row + 1, int(np.searchsorted(ends, ends[row] + PART_BYTES, "right")) - 1)
        yield row, upto - row, data[ends[row]:ends[upto]], ends[row:upto + 1] - ends[row]
        row = upto
