"""Words of a whole Arrow column at once, as numpy arrays.

A word is a run of bytes other than space and ``\\t``..``\\r``; in UTF-8 that is the same as a run of such
characters. Python never sees a single word here, so a pass over a corpus costs about ten nanoseconds a byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1 << 22  # text handled at once; a longer document is a slice of its own
_BLOCK = 1 << 18  # bytes hashed at once
_LONG_WORD = 4096  # longer words are hashed one by one

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all output bits."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_BASE = 0x9E3779B97F4A7C15
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_LOWER_VALUE = _VALUE.copy()
_LOWER_VALUE[65:91] = _VALUE[97:123]
_POW = _powers(_BASE, 2 * _BLOCK + 1)
_INV = _powers(pow(_BASE, -1, 1 << 64), 2 * _BLOCK + 1)


def lower_ascii(word: bytes) -> bytes:
    return word.lower()  # bytes.lower changes A-Z only


@dataclass
class Words:
    """Words of a column of texts; ``first[i]:first[i + 1]`` are those of text ``i``."""

    data: np.ndarray  # bytes of all texts, one after another
    offsets: np.ndarray  # where each text starts in them
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(offsets):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text (or one row), empty batches left out."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = column_bytes(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def _hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, value: np.ndarray, lower: bool) -> np.ndarray:
    out = np.zeros(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + 2 * _BLOCK, side="right")))
        high = ends[to - 1]
        if high - low <= 2 * _BLOCK:
            sums = np.zeros(high - low + 1, dtype=np.uint64)
            np.cumsum(value[data[low:high]] * _POW[: high - low], out=sums[1:])
            a, b = starts[at:to] - low, ends[at:to] - low
            out[at:to] = (sums[b] - sums[a]) * _INV[a]
        at = to
    out = mix(out)
    for i in np.flatnonzero(ends - starts > _LONG_WORD):
        word = data[starts[i] : ends[i]].tobytes()
        out[i] = xxhash.xxh64_intdigest(lower_ascii(word) if lower else word)
    return out


def words_of(column: pa.Array, lower: bool = False) -> Words:
    """Words of each text with a 64-bit hash of each; ``lower`` hashes A-Z as a-z."""
    data, offsets = column_bytes(column)
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[1:] = solid[:-1]
    before[:1] = False
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[:-1] = solid[1:]
    after[-1:] = False
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    first = np.searchsorted(starts, offsets)
    hashes = _hash(data, starts, ends, _LOWER_VALUE if lower else _VALUE, lower)
    return Words(data, offsets, starts, ends, hashes, first)


def grams(hashes: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Hash of every ``k`` consecutive words (also across texts: mask those); empty if there are fewer."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    factor = mix(np.array([seed]))[0] | np.uint64(1)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out = out * factor + hashes[j : j + n]
    return mix(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    out, span = values, 1
    while span < width:
        step = min(span, width - span)
        out = np.minimum(out[:-step], out[step:])
        span += step
    return out
