"""Word, shingle and line hashing over Arrow text columns, without per-row Python.

A text column is handled as its UTF-8 bytes and row offsets. Words are the
maximal runs of bytes other than 0x20 and 0x09-0x0D (no byte of a multi-byte
character is one of these, so this is the same as on code points). A word's
64-bit hash is a polynomial over random byte values, got for all words at once
from one cumulative sum, then mixed. Two different words or shingles collide
with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_CHUNK_BYTES = 2 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_STEP = 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (in place where possible)."""
    x = np.array(x, dtype=np.uint64, copy=True)
    x ^= x >> _U(33)
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


_EXACT = mix(np.arange(1, 257, dtype=np.uint64) * _U(_STEP))
_LOWER = _EXACT.copy()
_LOWER[65:91] = _EXACT[97:123]
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, MAX_CHUNK_BYTES + 1), base, dtype=np.uint64)
        out[0] = 1
        have = np.cumprod(out, dtype=np.uint64)
        if n <= MAX_CHUNK_BYTES + 1:
            _powers[base] = have
    return have[:n]


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and its n+1 row offsets; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.cast(pc.fill_null(pc.cast(col, pa.large_string()), ""), pa.large_binary())
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    buf = col.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = MAX_CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds at most max_bytes of the column, or one row."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    lo = total = 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > max_bytes:
            yield batch.slice(lo, i - lo)
            lo, total = i, 0
        total += size
    yield batch.slice(lo)


class Words(NamedTuple):
    """start, end: byte positions of each word; split: n+1 word offsets of the rows."""

    start: np.ndarray
    end: np.ndarray
    split: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.split) - 1), np.diff(self.split))


def _runs(inside: np.ndarray, offs: np.ndarray) -> Words:
    before = np.ones(len(inside), dtype=bool)
    before[1:] = ~inside[:-1]
    cuts = offs[:-1][offs[:-1] < len(inside)]
    before[cuts] = True
    after = np.ones(len(inside), dtype=bool)
    after[:-1] = before[1:] | ~inside[1:]
    start = np.flatnonzero(inside & before)
    return Words(start, np.flatnonzero(inside & after) + 1, np.searchsorted(start, offs))


def find_words(data: np.ndarray, offs: np.ndarray) -> Words:
    return _runs(~SPACE[data], offs)


def find_lines(data: np.ndarray, offs: np.ndarray) -> Words:
    """Non-empty lines between newlines."""
    return _runs(data != 10, offs)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each byte span; lower folds A-Z."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_LOWER if lower else _EXACT)[data] * _power(_BASE, len(data)), out=total[1:])
    value = (total[end] - total[start]) * _power(_BASE_INV, len(data))[start]
    return mix(value + (end - start).astype(np.uint64) * _U(_STEP))


def windows(hashes: np.ndarray, split: np.ndarray, k: int, whole_short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first word, row) of each k-word window inside a row.

    whole_short: a row of 1 to k-1 words gives its whole sequence as one window.
    """
    n = np.diff(split)
    count = np.maximum(n - k + 1, 0)
    row = np.repeat(np.arange(len(n)), count)
    first = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + split[:-1][row]
    step = _power(_STEP, k)
    value = np.zeros(len(first), dtype=np.uint64)
    for j in range(k):
        value += hashes[first + j] * step[j]
    value = mix(value + _U(k))
    if whole_short and (short := np.flatnonzero((n > 0) & (n < k))).size:
        more = []
        for r in short:
            h = hashes[split[r] : split[r + 1]]
            more.append(int((h * step[: len(h)]).sum(dtype=np.uint64)) + len(h) & 0xFFFFFFFFFFFFFFFF)
        value = np.concatenate([value, mix(np.array(more, dtype=np.uint64))])
        first = np.concatenate([first, split[:-1][short]])
        row = np.concatenate([row, short])
    return value, first, row


def per_row(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of mask over each row's span."""
    total = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def in_row(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Make hashes of different rows differ, for distinct counts inside rows."""
    return mix(values + (row.astype(np.uint64) + _U(1)) * _U(_STEP))
