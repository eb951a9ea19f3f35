"""Vectorised words over Arrow text columns.

A batch is cut into slices of a few MB of whole texts; inside a slice every step works on
the byte buffer of all its texts at once (no per-row or per-word Python).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 2 << 20
SLICE_ROWS = 4096
LONG_WORD = 256

U = np.uint64
_K1, _K2, _K3 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [2**64 - 1], np.uint64)

#: Bytes 0x20 and 0x09-0x0D separate words in the contracts.
ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: ASCII letters and digits and every byte of a non-ASCII character are part of a term.
NOT_TERM = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (public constants)."""
    h = (h ^ (h >> U(30))) * _K2
    h = (h ^ (h >> U(27))) * _K3
    return h ^ (h >> U(31))


@dataclass
class Slice:
    """Rows ``lo:hi`` of a batch: their bytes and where each text starts."""

    lo: int
    hi: int
    buf: np.ndarray
    off: np.ndarray
    null: np.ndarray

    @property
    def rows(self) -> int:
        return self.hi - self.lo

    def text(self, i: int) -> str:
        return self.buf[self.off[i] : self.off[i + 1]].tobytes().decode("utf-8", "replace")


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES, max_rows: int = SLICE_ROWS) -> Iterator[Slice]:
    """Whole texts of a string column, null as empty, in slices of about ``max_bytes``
    (one longer text makes a slice of its own)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    null = np.asarray(column.is_null())
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), lo + max_rows, n)
        yield Slice(lo, hi, raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], null[lo:hi])
        lo = hi


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, 8 bytes a step; long spans by xxh3."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    view = np.ndarray((buf.size + 1,), "<u8", padded, strides=(1,))
    size = end - start
    h = mix(size.astype(np.uint64) * _K1 + _K2)
    todo, at = np.flatnonzero((size > 0) & (size <= LONG_WORD)), 0
    while todo.size:
        left = size[todo] - at
        part = view[start[todo] + at] & _MASK[np.minimum(left, 8)]
        h[todo] = mix((h[todo] ^ part) * _K1 + U(at))
        at += 8
        todo = todo[left > 8]
    for i in np.flatnonzero(size > LONG_WORD):
        h[i] = xxhash.xxh3_64_intdigest(buf[start[i] : end[i]].tobytes())
    return h


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # rows + 1: the words of row i are first[i]:first[i + 1]


def words(s: Slice, separator: np.ndarray = ASCII_SPACE, lower: bool = False) -> Words:
    buf = LOWER[s.buf] if lower else s.buf
    sep = separator[buf]
    word = ~sep
    begin, stop = word.copy(), word.copy()
    begin[1:] &= sep[:-1]
    stop[:-1] &= sep[1:]
    full = np.flatnonzero(s.off[1:] > s.off[:-1])
    head, tail = s.off[full], s.off[full + 1] - 1
    begin[head], stop[tail] = word[head], word[tail]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    first = np.searchsorted(start, s.off)
    row = np.repeat(np.arange(s.rows), np.diff(first))
    return Words(start, end, row, hash_spans(buf, start, end), first)


def shingles(w: Words, k: int, whole_if_short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, first): the k-word shingles of every text in order. A text of 1 to k-1
    words gives its whole sequence as one shingle if ``whole_if_short``."""
    n = w.hash.size
    count = np.diff(w.first)
    keep = np.maximum(count - k + 1, 0)
    if whole_if_short:
        keep = np.where((count > 0) & (count < k), 1, keep)
    first = np.concatenate([[0], np.cumsum(keep)])
    row = np.repeat(np.arange(count.size), keep)
    at = np.arange(first[-1]) - first[row] + w.first[row]
    span = np.minimum(count[row], k)
    h = mix(span.astype(np.uint64) * _K3 + _K1)
    for j in range(k):
        use = span > j
        if use.all():
            h = mix((h ^ w.hash[at + j]) * _K1 + U(j + 1)) if n else h
        else:
            h[use] = mix((h[use] ^ w.hash[at[use] + j]) * _K1 + U(j + 1))
    return row, h, first


def sorted_unique(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    keep = np.ones(h.size, bool)
    keep[1:] = h[1:] != h[:-1]
    return h[keep]


def distinct_by_row(row: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct hashes of every row, sorted by row and then by hash."""
    bits = max(1, int(rows - 1).bit_length()) if rows else 1
    if rows <= 1:
        u = sorted_unique(h)
        return np.zeros(u.size, np.int64), u
    # the row number takes the place of the highest bits for one flat sort
    order = np.argsort(row.astype(np.uint64) << U(64 - bits) | h >> U(bits), kind="stable")
    r, v = row[order], h[order]
    low = np.flatnonzero((r[1:] == r[:-1]) & (v[1:] >> U(bits) == v[:-1] >> U(bits)) & (v[1:] != v[:-1]))
    if low.size:  # equal high bits only: order those exactly
        order = np.lexsort((h, row))
        r, v = row[order], h[order]
    keep = np.ones(r.size, bool)
    keep[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    return r[keep], v[keep]
