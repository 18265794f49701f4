"""Words and rolling hashes over the text buffers of Arrow batches, without a Python object per word."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text that are worked on at once; a longer text is worked on alone
PIECE_BYTES = 4 << 20

#: blanks as the byte class of space and \t to \r
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _valid, where, data = column.buffers()
    if len(column) == 0 or where is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    offsets = np.frombuffer(where, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


@functools.cache
def _trim():
    """The C library's call that gives freed memory back, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return None


def give_back() -> None:
    """Give freed memory back to the system: a worker that has been through large arrays waits for its next stage
    beside others, and what it keeps they lack."""
    pa.default_memory_pool().release_unused()
    if _trim() is not None:
        _trim()(0)


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES, rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have at most `limit` bytes together and at most `rows` rows, or one row."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), n, n if rows is None else low + rows)
        yield low, high
        low = high
    give_back()


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word, and the number of words before each row (one more at the end)."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    inside = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = True
    np.logical_not(inside[:-1], out=before[1:])
    after = np.empty(len(data), dtype=bool)
    after[-1] = True
    np.logical_not(inside[1:], out=after[:-1])
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """The final mixing of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.cache
def _base(seed: int) -> tuple[int, int, np.ndarray]:
    """An odd base, its inverse modulo 2^64, and a random number for each byte."""
    random = np.random.default_rng(seed)
    base = int(random.integers(0, 1 << 63, dtype=np.int64)) * 8 % (1 << 64) + 3
    return base, pow(base, -1, 1 << 64), random.integers(0, 1 << 64, 256, dtype=np.uint64)


_powers: dict[tuple[int, bool], np.ndarray] = {}


def _powers_of(seed: int, inverse: bool, n: int) -> np.ndarray:
    held = _powers.get((seed, inverse))
    if held is None or len(held) < n:
        size = 1 << max(16, (n - 1).bit_length())
        steps = np.full(size, _base(seed)[inverse], dtype=np.uint64)
        steps[0] = 1
        held = np.multiply.accumulate(steps)
        if size <= 1 << 23:
            _powers[seed, inverse] = held
    return held[:n]


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Polynomial hashes of the ranges [start, end) of `values`, modulo 2^64."""
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * _powers_of(seed, False, n), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _powers_of(seed, True, n + 1)[starts])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of every word, block by block so that memory follows the block."""
    out = np.empty(len(starts), dtype=np.uint64)
    table, low = _base(seed)[2], 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + (1 << 20))))
        at, to = int(starts[low]), int(ends[high - 1])
        out[low:high] = _ranges(table[data[at:to]], starts[low:high] - at, ends[low:high] - at, seed)
        low = high
    return out


def window_hashes(words: np.ndarray, size: int, seed: int = 2) -> np.ndarray:
    """Hashes of `size` consecutive words from every start, over row edges too: see `whole_windows`."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    starts = np.arange(n)
    return _ranges(words, starts, starts + size, seed)


def rows_of_words(first: np.ndarray) -> np.ndarray:
    """The row of every word, from the number of words before each row."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def whole_windows(row: np.ndarray, size: int) -> np.ndarray:
    """Which starts have all their words in one row."""
    if len(row) < size:
        return np.zeros(0, dtype=bool)
    return row[: len(row) - size + 1] == row[size - 1 :]
