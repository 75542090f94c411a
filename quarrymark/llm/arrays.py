"""Whole-batch text primitives on NumPy arrays.

An Arrow string column is one contiguous byte buffer plus offsets, so words, hashes and
windows are computed for a whole slice of documents at once, without a Python object per word.
Null texts count as empty everywhere.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time; the arrays below need about 100 bytes for each of them.
SLICE_BYTES = 1 << 20

_U = np.uint64
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_MULT = _U(0x9E3779B97F4A7C15)
_INV = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS: dict[str, np.ndarray] = {}


def release() -> None:
    """Give freed memory back to the system: a worker that waits for its next task would keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def tidy(f: Callable) -> Callable:
    """f, a function of batches or of a group's tables, that gives its memory back when it ends."""

    def done(out):
        if isinstance(out, Iterator):
            return _drained(out)
        release()
        return out

    def one(batches):
        return done(f(batches))

    def two(left, right):  # Spark counts the arguments
        return done(f(left, right))

    return two if f.__code__.co_argcount == 2 else one


def _drained(batches: Iterator) -> Iterator:
    yield from batches
    release()


def text_arrays(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and the n + 1 offsets between them."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    bounds = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most so many bytes; a longer text is a run of its own."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, end
        at = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: np.uint64, size: int) -> np.ndarray:
        p = np.full(size, base, np.uint64)
        p[0] = 1
        return np.multiply.accumulate(p)

    if n > SLICE_BYTES + 1:  # a single long text
        return table(_MULT, n), table(_INV, n)
    if not _POWERS:
        _POWERS.update(up=table(_MULT, SLICE_BYTES + 1), down=table(_INV, SLICE_BYTES + 1))
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """n + 1 running sums; range_hash() turns two of them into the hash of the bytes between."""
    up, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end], the same wherever equal bytes stand."""
    _, down = _powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def even_hash(sums: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive bytes, unmixed, from running sums."""
    m = max(0, len(sums) - n)
    return (sums[n : n + m] - sums[:m]) * _powers(len(sums))[1][:m]


def gram_hash(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive values."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(values) - n + 1, np.uint64)
    for k in range(n):
        out = out * _MULT + values[k : len(values) - n + 1 + k]
    return mix(out)


def window_min(values: np.ndarray, w: int) -> np.ndarray:
    """The least of every w consecutive values."""
    if len(values) < w:
        return values[:0]
    out, have = values, 1
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(values) - w + 1], out[w - have : w - have + len(values) - w + 1]) if have < w else out


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Bytes of words [^\x20\x09-\x0D]+.
PLAIN_WORD = ~_table((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ once A-Z are lower-cased; every byte of a non-ASCII character belongs.
FOLDED_WORD = _table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def word_bounds(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = PLAIN_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the n + 1 places where each text's words begin in them."""
    inside = table[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hash(prefix_hash(data), starts, ends)


def eight_bytes(data: np.ndarray, kind: str = "<u8") -> np.ndarray:
    """The eight bytes from each place on as one number, zeros past the end."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray((len(data) + 1,), kind, padded.data, strides=(1,))


def row_of(bounds: np.ndarray) -> np.ndarray:
    """For n + 1 bounds the row of each item."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices of the ranges, one range after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = starts - np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return np.arange(total, dtype=np.int64) + np.repeat(shift, lengths)


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the ranges."""
    d = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(d[:-1]) > 0
