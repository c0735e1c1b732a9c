"""Vectorised word hashing over Arrow string columns.

Words are the maximal runs of bytes outside ``\\x20`` and ``\\x09-\\x0D``; these
separators are ASCII, so cutting UTF-8 bytes cuts code points alike. A word's
hash depends on its bytes alone: not on the batch, the partition or the run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 21
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit integers (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power(which: str, n: int) -> np.ndarray:
    have = _powers.get(which)
    if have is None or len(have) < n:
        size = max(n, CHUNK + 1)
        base = np.full(size, _P if which == "up" else _P_INV, np.uint64)
        base[0] = 1
        have = _powers[which] = np.multiply.accumulate(base)
    return have[:n]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, end to end, and len + 1 offsets; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes of text; a longer text is a range of its own."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(size, dtype=np.int64), 0
    while start < len(size):
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right"))
        stop = max(stop, start + 1)
        yield start, stop
        start = stop


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the index of its first word (len + 1)."""
    w = _IS_WORD[data]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    before = np.empty_like(w)
    before[:1], before[1:] = False, w[:-1]
    before[inner] = False
    after = np.empty_like(w)
    after[-1:], after[:-1] = False, w[1:]
    after[inner - 1] = False
    starts, ends = np.flatnonzero(w & ~before), np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of each word, in pieces of bounded memory."""
    table, out, a = _BYTE_LOWER if lower else _BYTE, np.empty(len(starts), np.uint64), 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + CHUNK, "right")))
        lo, hi = int(starts[a]), int(ends[b - 1])
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(table[data[lo:hi]] * _power("up", hi - lo), out=sums[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        out[a:b] = mix64((sums[e] - sums[s]) * _power("down", hi - lo)[s] + (e - s).astype(np.uint64))
        a = b
    return out


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every k consecutive words (len - k + 1 of them)."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    n, total = len(words) - k + 1, np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        total = (total * _U(_P)) ^ mix64(words[j : j + n] + _U(j + 1))
        total *= _U(0xD6E8FEB86659FD93)
    return mix64(total)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles, A-Z lower-cased.

    A text of fewer words has its whole sequence as one shingle; one without
    words has none.
    """
    starts, ends, first = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends, lower=True)
    windows = window_hashes(hashes, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(windows[a : b - k + 1])
        elif b > a:
            yield window_hashes(hashes[a:b], b - a) ^ _U(b - a)
        else:
            yield hashes[:0]
