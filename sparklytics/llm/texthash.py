"""Vectorised text primitives used inside tasks: byte views of Arrow strings, words, lines, hashes.

Texts are handled as one flat UTF-8 byte array plus row offsets, so that splitting and hashing are
numpy operations over a few megabytes at a time and never a Python loop over words.  Hashes are
64-bit, depend only on the bytes (not on the process, the row or the partition), and are the same
on every executor.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK_BYTES = 1 << 20  # text bytes worked on at once; one longer text is a chunk of its own

# ASCII white space (tab to carriage return, and space) and the A-Z fold.
_WS = np.zeros(256, bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IDENTITY = np.arange(256, dtype=np.uint8)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit words (xor-shift, multiply)."""
    x = np.asarray(x, U64).copy()
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BYTE = mix64(np.arange(1, 257, dtype=U64) * U64(_BASE))
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, U64), np.ones(1, U64))


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse.  Those for a chunk are kept; a longer text's are not."""
    global _powers
    if len(_powers[0]) >= n:
        return _powers
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        v = np.full(max(n, CHUNK_BYTES + 1), b, U64)
        v[0] = 1
        out.append(np.multiply.accumulate(v))
    if n <= CHUNK_BYTES + 1:
        _powers = (out[0], out[1])
    return out[0], out[1]


def flat(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is the empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    if col.null_count:
        col = pc.fill_null(col, "")
    col = col.cast(pa.large_string())
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, off - off[0]


def chunks(batches, column: str, max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``max_bytes`` of text each (or one longer row)."""
    for b in batches:
        if not b.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        end = np.cumsum(size.astype(np.int64))
        i = 0
        while i < b.num_rows:
            base = end[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(end, base + max_bytes, "right")))
            yield b.slice(i, j - i)
            i = j


def _unused() -> None:
    """Gives memory that is free back to the system (C libraries without malloc_trim keep theirs)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task.  At its end the worker gives back what it has used: Spark keeps workers for later
    tasks, and one that waits held some 60 MB beside its libraries."""
    yield from batches
    _unused()


def lean_group(t: pa.Table) -> pa.Table:
    """The same for a group's result."""
    _unused()
    return t


def _edges(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(inside)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], after[-1] = True, True
    np.logical_not(inside[:-1], out=before[1:])
    np.logical_not(inside[1:], out=after[:-1])
    full = off[1:] > off[:-1]
    before[off[:-1][full]] = True
    after[off[1:][full] - 1] = True
    starts = np.flatnonzero(inside & before)
    ends = np.flatnonzero(inside & after) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of bytes marked in ``inside``, within rows."""
    return _edges(inside, off)


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of non-white-space bytes, within rows."""
    return _edges(~_WS[buf], off)


def lines(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every non-empty line (newline-separated), within rows."""
    return _edges(buf != 10, off)


class Spans:
    """Hashes of byte spans of one text array: a polynomial over random byte values, mixed with the length."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        power, self.inverse = _pow(n + 1)
        self.acc = np.zeros(n + 1, U64)
        np.cumsum(_BYTE[buf] * power[:n], out=self.acc[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.acc[ends] - self.acc[starts]) * self.inverse[starts]
                     + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span."""
    return Spans(buf).hash(starts, ends)


def grams(h: np.ndarray, row: np.ndarray, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every ``k`` consecutive items of a row.

    With ``short``, a row of 1 to k-1 items gives its whole sequence as a single gram.
    """
    n = len(h)
    if not n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    mult = mix64(np.arange(11, 11 + k, dtype=U64)) | U64(1)
    if n >= k:
        g = np.zeros(n - k + 1, U64)
        for j in range(k):
            g += mix64(h[j:n - k + 1 + j] * mult[j]) if j else h[:n - k + 1] * mult[0]
        ok = row[:n - k + 1] == row[k - 1:]
        g, r = mix64(g[ok]), row[:n - k + 1][ok]
    else:
        g, r = np.zeros(0, U64), np.zeros(0, np.int64)
    if not short:
        return g, r
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    size = np.diff(np.r_[first, n])
    few = size < k
    if few.any():
        f, s = first[few], size[few]
        acc = np.zeros(len(f), U64)
        for j in range(k - 1):
            at = j < s
            acc[at] += mix64(h[f[at] + j] * mult[j]) if j else h[f[at]] * mult[0]
        extra = mix64(acc + s.astype(U64) * U64(0xA0761D6478BD642F))
        g, r = np.r_[g, extra], np.r_[r, row[f]]
        order = np.argsort(r, kind="stable")
        g, r = g[order], r[order]
    return g, r


def distinct(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (row, hash) pairs."""
    order = np.lexsort((h, row))
    r, v = row[order], h[order]
    keep = np.ones(len(r), bool)
    keep[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    return r[keep], v[keep]


def bounds(row: np.ndarray, n: int) -> np.ndarray:
    """Offsets of each of ``n`` rows in an array sorted by row."""
    return np.searchsorted(row, np.arange(n + 1), "left")
