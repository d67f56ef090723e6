"""Words and window hashes of whole Arrow text columns, a few megabytes at a time.

A word is a run of bytes other than space and U+0009 to U+000D. Everything works on UTF-8
bytes with prefix sums, so that a batch costs a fixed number of passes over its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 21

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, _U), _INVERSE: np.ones(1, _U)}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted without repeats; a plain sort is much the fastest way for numbers."""
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    return values[keep]


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted without repeats, and how often each occurred."""
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate((np.ones(min(len(values), 1), bool), values[1:] != values[:-1])))
    return values[first], np.diff(np.append(first, len(values)))


#: One random value for each byte, so that regular texts meet no regular hashes.
_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    if len(_powers[base]) < n:
        size = 1 << max(n - 1, CHUNK_BYTES).bit_length()
        steps = np.full(size, base, _U)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums of bytes; ``window`` turns two of them into a hash."""
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=sums[1:])
    return sums


def window(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes [start, end), alike wherever these bytes stand."""
    inverse = powers(_INVERSE, len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(_U))


@dataclass
class Chunk:
    """Some whole texts: their bytes, where each begins, and which rows of the batch they are."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of an Arrow column (null as empty), cut between texts at about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.string()), "")
    n = len(column)
    if n == 0:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int32, n + 1, column.offset * 4).astype(np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.zeros(0, np.uint8)
    begin = 0
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), n)
        low, high = offsets[begin], offsets[end]
        yield Chunk(data[low:high], offsets[begin : end + 1] - low, begin)
        begin = end


_NO_ID = np.iinfo(np.int64).min


def ids(column: pa.Array) -> np.ndarray:
    """Ids as numbers; the smallest long stands for null."""
    return pc.fill_null(column.cast(pa.int64()), int(_NO_ID)).to_numpy(zero_copy_only=False)


def id_array(values: np.ndarray) -> pa.Array:
    """The opposite of ``ids``."""
    return pa.array(values, pa.int64(), mask=values == _NO_ID)


@dataclass
class Words:
    """Word i of a chunk is data[start[i]:end[i]]; text d has the words [of[d], of[d + 1])."""

    start: np.ndarray
    end: np.ndarray
    of: np.ndarray
    hash: np.ndarray


def words(chunk: Chunk, lower: bool) -> Words:
    """All words of a chunk in order, hashed; ``lower`` folds A to Z only."""
    data = _LOWER[chunk.data] if lower else chunk.data
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(chunk) + 1, np.int64), none.astype(_U))
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[chunk.offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    of = np.searchsorted(start, chunk.offsets)
    return Words(start, end, of, window(prefix_hashes(data), start, end))


def grams(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k words in a row, and where each text's begin (as ``Words.of``).

    A window that reaches into the next text is left out; a text of fewer words has none.
    """
    n = len(found.hash)
    counts = np.maximum(np.diff(found.of) - k + 1, 0)
    of = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=of[1:])
    if of[-1] == 0:
        return np.zeros(0, _U), of
    total = np.zeros(n - k + 1, _U)
    for j in range(k):
        total = mix(total * _U(0x9E3779B97F4A7C15) + found.hash[j : n - k + 1 + j])
    begin = np.repeat(found.of[:-1] - of[:-1], counts) + np.arange(of[-1])
    return total[begin], of
