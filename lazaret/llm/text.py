"""Words of many texts at once, as arrays over one byte buffer.

A worker gets texts as Arrow strings. Their bytes lie in one buffer, so word borders, lower case and
hashes of words come from a few array operations for a whole slice of rows. A hash is 64 bits of a
polynomial over random byte values; two given spans that differ share it with a chance of about 2^-60.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20
_BLOCK = 1 << 18

_rng = np.random.default_rng(20240607)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S29, _S32 = np.uint64(29), np.uint64(32)

#: White space of the word rule [^\x20\x09-\x0D]+.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: All ASCII that is neither letter nor digit parts words here.
NOT_ALNUM = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
#: A-Z to a-z, all else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(base: int) -> np.ndarray:
    out = np.full(_BLOCK + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE), _powers(_INVERSE)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> _S29)) * _M1
    return h ^ (h >> _S32)


class Texts(NamedTuple):
    """Bytes of some rows; row i has data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def texts_of(column: pa.Array) -> Texts:
    """The bytes of an Arrow string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Parts of a batch with about SLICE_BYTES of text each, rows kept whole."""
    whole = texts_of(batch.column(text))
    first = 0
    while first < len(whole):
        last = int(np.searchsorted(whole.offsets, whole.offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(whole))
        a, b = whole.offsets[first], whole.offsets[last]
        yield batch.slice(first, last - first), Texts(whole.data[a:b], whole.offsets[first : last + 1] - a)
        first = last


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash for each data[start:end]; starts and ends ascend."""
    at_start, at_end = np.empty(len(start), np.uint64), np.empty(len(end), np.uint64)
    undo = np.empty(len(start), np.uint64)
    before, up, down = 0, 1, 1
    for block in range(0, max(len(data), 1), _BLOCK):
        part = data[block : block + _BLOCK]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_VALUE[part] * _UP[: len(part)], out=sums[1:])
        stop = block + len(part) + (block + _BLOCK >= len(data))
        for places, out in ((start, at_start), (end, at_end)):
            a, b = np.searchsorted(places, (block, stop))
            out[a:b] = np.uint64(before) + np.uint64(up) * sums[places[a:b] - block]
            if out is at_start:
                undo[a:b] = np.uint64(down) * _DOWN[places[a:b] - block]
        before = (before + up * int(sums[-1])) % 2**64
        up, down = up * int(_UP[-1]) % 2**64, down * int(_DOWN[-1]) % 2**64
    return mix((at_end - at_start) * undo)


class Words(NamedTuple):
    """Words in order: places in the bytes, row and hash; row i has words first[i]:first[i + 1]."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def words_of(texts: Texts, breaks: np.ndarray = SPACE, lower: bool = True) -> Words:
    """Words are runs of bytes that are not in ``breaks``; ``lower`` folds A-Z for the hash."""
    inner = ~breaks[texts.data]
    edge = np.zeros(len(texts.data) + 1, bool)
    edge[texts.offsets] = True
    left = np.ones(len(inner), bool)
    left[1:] = ~inner[:-1]
    start = np.flatnonzero(inner & (left | edge[:-1]))
    right = np.ones(len(inner), bool)
    right[:-1] = ~inner[1:]
    end = np.flatnonzero(inner & (right | edge[1:])) + 1
    row = np.searchsorted(texts.offsets, start, side="right") - 1
    data = LOWER[texts.data] if lower else texts.data
    first = np.searchsorted(row, np.arange(len(texts) + 1))
    return Words(start, end, row, span_hashes(data, start, end), first)


def window_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``size`` words inside a row: the index of its first word, and its hash."""
    n = len(words.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = h * _M2 + words.hash[k : n + k]
    at = np.flatnonzero(words.row[:n] == words.row[size - 1 :])
    return at, mix(h[at])
