"""Words of an Arrow text column as numpy spans and 64-bit hashes, without a Python object per word.

A slice of documents is one flat byte buffer. Words are runs of bytes of a class, found with a
table of 256 flags; a word never crosses the end of its document. A word's hash is a polynomial
modulo 2**64 over its bytes, taken from running sums, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
#: numbers worked on at once: few enough for the processor's cache, and for memory to be used again
_BLOCK = 1 << 17

#: fixed values: bytes that are white space, and bytes that are word bytes after lower-casing A-Z
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
LETTER_OR_DIGIT = np.zeros(256, bool)
LETTER_OR_DIGIT[0x30:0x3A] = LETTER_OR_DIGIT[0x61:0x7B] = LETTER_OR_DIGIT[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


class Texts(NamedTuple):
    """Whole texts of some rows: bytes of row i are ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Spans of the words, and for each row the range ``first[i]:first[i + 1]`` of its words."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def texts_of(column: pa.Array) -> Texts:
    """The bytes of a text or binary column; null is an empty text."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32, n + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    if data is None:
        return Texts(np.zeros(0, np.uint8), offsets - offsets[0])
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return Texts(data, offsets - offsets[0])


def slices(batches, column: str = "text", size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows with about ``size`` bytes of text; a longer text is one run."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = texts_of(batch.column(column)).offsets[1:]
        at, done = 0, 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(at, to - at)
            at, done = to, int(ends[to - 1])


def lowered(texts: Texts) -> Texts:
    """A-Z lower-cased, other bytes as they are."""
    return Texts(_LOWER[texts.data], texts.offsets)


def words_of(texts: Texts, inside: np.ndarray) -> Words:
    """Maximal runs of bytes of the class ``inside`` within each row."""
    data, offsets = texts
    if not len(data):
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64))
    member = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = member.copy()
    start[1:] &= ~member[:-1] | edge[1:-1]
    end = member
    end[:-1] &= ~member[1:] | edge[1:-1]
    start = np.flatnonzero(start)
    return Words(start, np.flatnonzero(end) + 1, np.searchsorted(start, offsets))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    shape, x = x.shape, x.reshape(-1)
    out = np.empty(len(x), np.uint64)
    for at in range(0, len(x), 1 << 15):
        y = x[at : at + (1 << 15)]
        y = y ^ (y >> np.uint64(30))
        y *= np.uint64(0xBF58476D1CE4E5B9)
        y ^= y >> np.uint64(27)
        y *= np.uint64(0x94D049BB133111EB)
        np.bitwise_xor(y, y >> np.uint64(31), out=out[at : at + (1 << 15)])
    return out.reshape(shape)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: dict[int, np.ndarray] = {}


def _table(base: int, n: int) -> np.ndarray:
    have = _tables.get(base)
    if have is None or len(have) < n:
        have = powers(base, max(n, _BLOCK + 1))
        if n <= 8 * _BLOCK:
            _tables[base] = have
    return have[:n]


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _BASE) -> np.ndarray:
    """64-bit hashes of ascending spans; equal bytes have equal hashes wherever they stand. Another base is another hash."""
    inverse = pow(base, -1, 1 << 64)
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        origin = start[at]
        to = max(at + 1, int(np.searchsorted(end, origin + _BLOCK, "right")))
        n = int(end[to - 1] - origin)
        sums = np.zeros(n + 1, np.uint64)
        terms = data[origin : origin + n].astype(np.uint64)
        terms += np.uint64(1)
        terms *= _table(base, n)
        np.cumsum(terms, out=sums[1:])
        left = start[at:to] - origin
        right = end[at:to] - origin
        out[at:to] = (sums[right] - sums[left]) * _table(inverse, n + 1)[left]
        at = to
    return mixed(out + (end - start).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all strings of ``width`` bytes in ``data``, by where they start."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    inverse, power = _table(pow(_BASE, -1, 1 << 64), _BLOCK + 1), _table(_BASE, _BLOCK + width)
    for at in range(0, n, _BLOCK):
        m = min(_BLOCK, n - at)
        sums = np.zeros(m + width, np.uint64)
        terms = data[at : at + m + width - 1].astype(np.uint64)
        terms += np.uint64(1)
        terms *= power[: len(terms)]
        np.cumsum(terms, out=sums[1:])
        out[at : at + m] = mixed((sums[width : width + m] - sums[:m]) * inverse[:m])
    return out


def word_hashes(texts: Texts, words: Words) -> np.ndarray:
    return hashes(texts.data, words.start, words.end)


def distinct(values: np.ndarray) -> np.ndarray:
    """The different values, ascending."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def ragged_range(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for count[0] numbers, then the same for the next row."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(count)
    return np.arange(total, dtype=np.int64) + np.repeat(start - (ends - count), count)


def run_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[i]:first[i + 1]]``, 0 for an empty range."""
    sums = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]
