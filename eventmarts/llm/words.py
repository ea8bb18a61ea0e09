"""Vectorised words, shingles and their hashes over the bytes of Arrow strings.

Words are runs of bytes other than space and tab to carriage return, i.e.
``[^\\x20\\x09-\\x0D]+`` (those bytes never occur inside a longer UTF-8 sequence).
A word's hash is a polynomial over mixed bytes modulo 2**64, taken from prefix
sums, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
SHINGLE = 5

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=_U) * _U(_BASE) + _U(seed * 0x632BE59BD9B4E019 % (1 << 64)))


_BYTE = stream(1, 256)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLACE = stream(2, SHINGLE) | _U(1)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, grown on demand."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, CHUNK_BYTES + 1)
        for base in (_BASE, _BASE_INV):
            steps = np.full(n, _U(base))
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
        del _powers[:-2]
    return _powers


class Texts:
    """Bytes and words of a run of texts.

    ``start``/``end``: byte bounds of each word; ``first``: index of each text's
    first word, with one more entry at the end; ``hash``: of each word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        inside = np.empty(n + 1, bool)
        inside[:n] = ~_IS_SPACE[data]
        inside[n] = False
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        cut = offsets[:-1]
        cut = cut[cut < n]
        starts[cut] = inside[cut]  # a word never runs into the next text
        self.start = np.flatnonzero(starts)
        ends = np.zeros(n + 1, bool)
        ends[1:] = inside[:-1] & ~(inside[1:] & ~starts[1:])
        self.end = np.flatnonzero(ends)
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        """Hash of each word; prefix sums run over about ``CHUNK_BYTES`` at a time, so a
        very long text needs no more memory than many short ones."""
        out = np.empty(len(self.start), _U)
        i = 0
        while i < len(out):
            base = self.start[i]
            j = max(int(np.searchsorted(self.end, base + CHUNK_BYTES, "right")), i + 1)
            part = self.data[base:self.end[j - 1]]
            power, inverse = _power_tables(len(part) + 1)
            sums = np.empty(len(part) + 1, _U)
            sums[0] = 0
            np.cumsum(_BYTE[part] * power[:len(part)], out=sums[1:])
            start, end = self.start[i:j] - base, self.end[i:j] - base
            out[i:j] = mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(_U))
            i = j
        return out

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.count)

    def identity(self) -> np.ndarray:
        """(texts, 2) hashes of the word sequences; 0 for a text without words."""
        out = np.zeros((len(self), 2), _U)
        some = np.flatnonzero(self.count)
        if len(some):
            at = (np.arange(len(self.hash)) - np.repeat(self.first[:-1], self.count)).astype(_U)
            for k in range(2):
                terms = mix(self.hash ^ mix(at * _U(2) + _U(k + 11)))
                out[some, k] = mix(np.add.reduceat(terms, self.first[:-1][some])
                                   + self.count[some].astype(_U))
        return out

    def shingles(self, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, first): shingles of ``size`` words, in order, repeats included.

        A text of fewer words has one shingle, all its words; one without words none.
        """
        n = np.where(self.count >= size, self.count - size + 1, np.minimum(self.count, 1))
        first = np.concatenate([[0], np.cumsum(n)])
        total = int(first[-1])
        at = np.arange(total) - np.repeat(first[:-1], n) + np.repeat(self.first[:-1], n)
        left = np.repeat(np.minimum(self.count, size), n)
        out = left.astype(_U)
        last = len(self.hash) - 1
        for k in range(size):
            term = self.hash[np.minimum(at + k, last)] * _PLACE[k] if total else out
            out = out + np.where(left > k, term, _U(0))
        return mix(out), first


def chunks(column: pa.Array | pa.ChunkedArray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, Texts]]:
    """(first row, texts) for runs of rows of about ``most`` bytes; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if not len(column):
        return
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64 if wide else np.int32)
    bounds = bounds[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(bounds, bounds[row] + most, "right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield row, Texts(data[bounds[row]:bounds[stop]], bounds[row:stop + 1] - bounds[row])
        row = stop
