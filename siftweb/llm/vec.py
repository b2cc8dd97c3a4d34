"""Vectorised word splitting and hashing over Arrow text batches.

Tasks see whole documents.  A batch is cut into slices of about ``limit``
bytes (always whole documents), so the working memory of a task is bounded
by the slice size or by its single longest document.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D.  A word's
hash is a polynomial over a random byte table modulo 2**64, finished with a
bit mixer, so equal words hash equally in every task and session.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finishing mixer (in place on a copy)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Poly:
    """Polynomial hashing modulo 2**64 with an odd base; ``seed`` picks one
    of many independent families."""

    def __init__(self, seed: int):
        raw = mix((np.arange(300, dtype=U64) + U64(1)) * U64(0x9E3779B97F4A7C15) + U64(seed))
        self.table = raw[:256]
        self.base = int(raw[256]) | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        def powers(b):
            p = np.full(n, b, dtype=U64)
            p[0] = 1
            return np.multiply.accumulate(p)
        self.pow, self.inv = powers(self.base), powers(self.inverse)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Running sums s with s[j] - s[i] = the polynomial of values[i:j],
        shifted by i."""
        if len(values) + 1 > len(self.pow):
            self._grow(max(len(values) + 1, 2 * len(self.pow)))
        s = np.zeros(len(values) + 1, dtype=U64)
        np.cumsum(values * self.pow[: len(values)], out=s[1:])
        return s

    def spans(self, s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((s[end] - s[start]) * self.inv[start] + (end - start).astype(U64))


FIRST, SECOND = Poly(11), Poly(77)


def text_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(pc.cast(arr, pa.large_string()), "")
    _, off, data = arr.buffers()
    off = np.frombuffer(off, dtype=np.int64)[arr.offset: arr.offset + len(arr) + 1] if off else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return what the allocators hold unused to the system, for workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def cuts(batch: pa.RecordBatch, column: str = "text", limit: int = 1 << 20
         ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """A batch as (rows, text bytes, offsets) of about ``limit`` bytes, whole documents each."""
    if not batch.num_rows:
        return
    data, off = text_buffers(batch.column(column))
    a, n = 0, batch.num_rows
    while a < n:
        b = int(np.searchsorted(off, off[a] + limit, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield batch.slice(a, b - a), data[off[a]: off[b]], off[a: b + 1] - off[a]
        a = b


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 1 << 20
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into (rows, text bytes, offsets) of about ``limit`` bytes."""
    give_back()
    for batch in batches:
        yield from cuts(batch, column, limit)
    batch = None
    give_back()


def numbered(docs):
    """The same rows, columns but doc_id, text and n_chars named by their number, so that
    tasks take columns of any name; ``toDF(*docs.columns)`` goes back."""
    return docs.toDF(*[c if c in ("doc_id", "text", "n_chars") else f"o{i}" for i, c in enumerate(docs.columns)])


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) byte positions of all words, and per-document word
    offsets (document i has words woff[i]:woff[i+1])."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[off] = True
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:-1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, off)


def lower(data: np.ndarray) -> np.ndarray:
    """ASCII A-Z to a-z on UTF-8 bytes."""
    return _LOWER[data]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, poly: Poly = FIRST) -> np.ndarray:
    return poly.spans(poly.prefix(poly.table[data]), start, end)


def runs(h: np.ndarray, woff: np.ndarray, k: int, poly: Poly = FIRST
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all k-word runs that stay inside one document:
    (hash, start word, run offsets per document)."""
    n = np.maximum(np.diff(woff) - k + 1, 0)
    roff = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(roff[-1]) + np.repeat(woff[:-1] - roff[:-1], n)
    return poly.spans(poly.prefix(h), at, at + k), at, roff
