"""Vectorised text handling inside Arrow batches.

A batch is worked through in slices of bounded size, so memory in a Python worker follows
``SLICE_BYTES`` (or one document, where that is longer) and not the batch that Spark sends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in row ranges of about ``limit`` bytes of ``column`` each, at least one row."""
    col = batch.column(column)
    n = len(col)
    if not n:
        return
    ends = _offsets(col)[1:] - _offsets(col)[0]
    at = 0
    while at < n:
        done = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(at, upto - at)
        at = upto


def _offsets(col: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    return np.frombuffer(col.buffers()[1], dtype=kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)


def raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows joined, and where each row starts (one more entry than rows). Null is empty."""
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) else "")
    off = _offsets(col)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8)[off[0] : off[-1]] if buf is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def string_array(data: np.ndarray | bytes, off: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(np.ascontiguousarray(off, np.int64)), pa.py_buffer(data))


def ragged_take(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``values[start : start + length]``, joined."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    index = np.arange(total, dtype=np.int64)
    index += np.repeat(starts - (ends - lengths), lengths)
    return values[index]


def binary_array(data: np.ndarray, off: np.ndarray) -> pa.Array:
    """Rows ``data[off[i] : off[i + 1]]`` of bytes as an Arrow binary column."""
    kind = pa.large_binary() if int(off[-1]) >= 2**31 else pa.binary()
    index = np.ascontiguousarray(off, np.int64 if kind == pa.large_binary() else np.int32)
    return pa.Array.from_buffers(kind, len(off) - 1, [None, pa.py_buffer(index), pa.py_buffer(np.ascontiguousarray(data))])


def sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each range of ``off``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


_BASES = (0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, element by element."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASES[0]) -> np.ndarray:
    """64-bit hashes of ``values[start:end]``, by prefix sums of a polynomial modulo 2**64."""
    up, down = _powers(base, len(values)), _powers(pow(base, -1, 2**64), len(values) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def class_words(data: np.ndarray, off: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes in ``letters`` (256 booleans), none over two rows: starts, ends, and each row's first word."""
    inside = letters[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] |= inside[cut]
    last[cut - 1] |= inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, by two polynomials."""
    one, two = (range_hashes(data, starts, ends, b) for b in _BASES)
    return mixed(one ^ (two << np.uint64(1)))


def grams(words: np.ndarray, n: int, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``n`` words from each on, and which of them end within their row (``first``: each row's first word)."""
    count = max(0, len(words) - n + 1)
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + count] + np.uint64(k + 1))
    row_end = np.repeat(first[1:], np.diff(first))[:count]
    return out, np.arange(count) + n <= row_end
