"""Word, line and window arithmetic on Arrow text columns with numpy, shared by the operators of this folder.

A word is a maximal run of bytes other than space and 0x09-0x0D, which is the same on UTF-8 bytes as on
characters.  Texts are worked through in slices of about half a megabyte, so memory follows the longest
single text and not the batch.  NULL texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 19
U = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE, STEP = U(0x100000001B3 | 0x9E37 << 40), U(0x9E3779B97F4A7C15)
SECOND = U(0xD6E8FEB86659FD93)
BYTE = np.arange(1, 257, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (bijective)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        factors = np.full(size, base, U)
        factors[0] = 1
        known = np.multiply.accumulate(factors)
        if size <= 1 << 21:
            _POWERS[int(base)] = known
    return known[:n]


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets into the bytes) of runs of rows holding about `limit` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, stop, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop


def spans(data: np.ndarray, rows: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word offsets of the rows): byte positions of all words, none across a row's border."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(rows), np.int64)
    ink = ~space[data]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = ink[:-1]
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = ink[1:]
    inner = rows[(rows > 0) & (rows < len(data))]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(ink & ~before)
    ends = np.flatnonzero(ink & ~after) + 1
    return starts, ends, np.searchsorted(starts, rows)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; spans are in order and do not overlap, empty ones hash to a constant."""
    if not len(starts):
        return np.zeros(0, U)
    lengths = ends - starts
    first = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=first[1:])
    total = int(first[-1])
    if not total:
        return mix(np.zeros(len(starts), U))
    shift = np.repeat((starts - first[:-1]).astype(np.int32), lengths)
    within = np.arange(total, dtype=np.int32)
    letters = BYTE[data[within + shift]]
    within -= np.repeat(first[:-1].astype(np.int32), lengths)
    letters *= powers(BASE, int(lengths.max()))[within]
    sums = np.zeros(len(starts), U)
    full = lengths > 0
    sums[full] = np.add.reduceat(letters, first[:-1][full])
    return mix(sums + lengths.astype(U) * STEP)


def window_hashes(words: np.ndarray, size: int, step: np.uint64 = STEP) -> np.ndarray:
    """Hash of each run of `size` values, as a polynomial over them; len(words) - size + 1 values."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    sums = np.zeros(len(words) + 1, U)
    np.cumsum(words * powers(step, len(words)), out=sums[1:])
    inverse = U(pow(int(step), -1, 1 << 64))
    return mix((sums[size:] - sums[:-size]) * powers(inverse, n))


def row_windows(offsets: np.ndarray, size: int) -> np.ndarray:
    """Positions among the windows over all words of those windows that stay within their row."""
    counts = np.maximum(np.diff(offsets) - size + 1, 0)
    total = int(counts.sum())
    first = np.zeros(len(counts), np.int64)
    np.cumsum(counts[:-1], out=first[1:])
    return np.arange(total) - np.repeat(first - offsets[:-1], counts)


def row_of(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Mask of the n places that lie in some run of `size` places beginning at one of `starts`."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + size, n), -1)
    return np.cumsum(marks[:-1]) > 0


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
