"""Packing along a Hilbert curve.

Each document becomes a hashed bag-of-words vector, projected to ``DIMS``
dimensions: every word hash gives one pseudo-random number per dimension,
which are summed over the words.  Scaled by the square root of the word
count the sums are near normal, so the normal distribution function spreads
them evenly over the grid.  The Hilbert key of the grid cell orders the
documents; a range shuffle on (key, doc_id) puts neighbours into one
partition, and each partition is cut into sequences as one stream of ids.

A sequence is full (2048 ids) except at the end of a partition: there the
rest is cut into powers of two, which need no padding.

Defined cases: null text is empty (only the end id) and has the grid's
middle as key; a null doc_id sorts first; repeated rows are documents of
their own; a document longer than a sequence is cut into pieces; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftweb.llm import tokens, vec
from siftweb.session import scratch_path

LENGTH, DIMS, GRID_BITS = 2048, 4, 12
#: Bytes of text that are projected at once: word hashes take many times the text's bytes.
PROJECTED = 1 << 18
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, hilbert long")
_ERF = np.vectorize(math.erf, otypes=[float])


def project(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Grid cells (documents x DIMS) of a slice."""
    low = vec.lower(data)
    start, end, woff = vec.words(low, off)
    h = vec.word_hashes(low, start, end)
    n = np.diff(woff)
    cells = np.zeros((len(n), DIMS), np.int64)
    for d in range(DIMS):
        x = ((h >> np.uint64(16 * d)) & np.uint64(0xFFFF)).astype(np.float64) / 65535 - 0.5
        s = np.concatenate([[0.0], np.cumsum(x)])
        z = (s[woff[1:]] - s[woff[:-1]]) * math.sqrt(12) / np.sqrt(np.maximum(n, 1))
        cells[:, d] = np.minimum((0.5 + 0.5 * _ERF(z / math.sqrt(2))) * (1 << GRID_BITS), (1 << GRID_BITS) - 1)
    return cells


def keys_of(rows: pa.RecordBatch) -> np.ndarray:
    """Hilbert key of each document of a slice."""
    return np.concatenate([hilbert_key(project(data, off)) for _, data, off in vec.cuts(rows, limit=PROJECTED)])


def hilbert_key(cells: np.ndarray, bits: int = GRID_BITS) -> np.ndarray:
    """Position of each cell on the Hilbert curve through the grid.

    Gray-code walk from the highest bit: at every level the cell's octant
    is read in the curve's current frame (a flip mask and a rotation of the
    axes), its rank is appended to the key, and the frame is updated for
    the sub-cube entered."""
    cells = np.asarray(cells, np.int64)
    n, dims = cells.shape
    full = (1 << dims) - 1
    key = np.zeros(n, np.int64)
    flip, turn = np.zeros(n, np.int64), np.zeros(n, np.int64)

    def rotate_right(x, by):
        return ((x >> by) | (x << (dims - by))) & full

    def rotate_left(x, by):
        return ((x << by) | (x >> (dims - by))) & full

    for level in range(bits - 1, -1, -1):
        octant = np.zeros(n, np.int64)
        for d in range(dims):
            octant |= ((cells[:, d] >> level) & 1) << d
        g = rotate_right(octant ^ flip, (turn + 1) % dims)
        rank = g.copy()  # inverse Gray code
        for s in range(1, dims):
            rank ^= g >> s
        key = (key << dims) | rank
        # Entry corner and main axis of sub-cube number `rank`.
        down = np.where(rank > 0, 2 * ((rank - 1) // 2), 0)
        entry = np.where(rank > 0, down ^ (down >> 1), 0)
        odd = np.where(rank % 2 == 1, rank, rank - 1)
        axis = np.zeros(n, np.int64)
        run = odd.copy()
        for _ in range(dims):  # trailing ones
            live = (run & 1) == 1
            axis += live
            run = np.where(live, run >> 1, 0)
        axis = np.where(rank == 0, 0, axis) % dims
        flip ^= rotate_left(entry, (turn + 1) % dims)
        turn = (turn + axis + 1) % dims
    return key


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = tokens.load("byte", path)
        for rows, _, _ in vec.slices(batches, limit=tokens.SLICE):
            ids = tokens.encode_rows(pieces, rows, end_id)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(keys_of(rows), pa.int64()),
                 pa.array([x.astype("<u2" if pieces.dtype.itemsize == 2 else "<u4").tobytes() for x in ids], pa.binary())],
                names=["doc_id", "hilbert", "ids"])
    return run


def _pack(length: int, itemsize: int):
    def rest(n: int) -> list[int]:
        return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]

    def emit(stream, ids, sizes, first_no, part):
        """Rows of the sequences of the given sizes that ``ids`` fills.
        stream: (doc_id, key, ids already cut, all ids, ids here)."""
        rows, seq, used, at = [], 0, 0, 0
        wide = ids.astype("<u4")
        for doc, key, cut, total, n in stream:
            while n:
                take = min(n, sizes[seq] - used)
                rows.append((doc, cut, take, zlib.crc32(wide[at: at + take].tobytes()), total,
                             (part << 33) + first_no + seq, used, key))
                cut, at, n, used = cut + take, at + take, n - take, used + take
                if used == sizes[seq]:
                    seq, used = seq + 1, 0
        kinds = [pa.int64()] * 8
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "hilbert"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0
        dtype = np.dtype("<u2" if itemsize == 2 else "<u4")
        stream, held, total = [], [], 0
        for batch in batches:
            for doc, key, raw in zip(batch.column("doc_id").to_pylist(), batch.column("hilbert").to_pylist(),
                                     batch.column("ids")):
                x = np.frombuffer(raw.as_buffer(), dtype)
                stream.append((doc, key, 0, len(x), len(x)))
                held.append(x)
                total += len(x)
                if total < 256 * length:
                    continue
                ids = np.concatenate(held)
                keep = total % length  # the tail of the last document(s) waits
                out, left = [], keep
                tail = []
                while left:
                    d, k, cut, every, n = stream.pop()
                    if n <= left:
                        tail.append((d, k, cut, every, n))
                        left -= n
                    else:
                        stream.append((d, k, cut, every, n - left))
                        tail.append((d, k, cut + n - left, every, left))
                        left = 0
                out = stream
                if total - keep:
                    yield emit(out, ids[: total - keep], [length] * (total // length), no, part)
                no += total // length
                stream, held, total = tail[::-1], [ids[len(ids) - keep:]], keep
        if total:
            yield emit(stream, np.concatenate(held), [length] * (total // length) + rest(total % length), no, part)
    return run


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = 1) -> DataFrame:
    """One row per piece of a document (see PIECES)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "pack")
    itemsize = tokens.load("byte", tokenizer).dtype.itemsize  # as the tasks see it
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(_encode(tokenizer, end_id), "doc_id long, hilbert long, ids binary").write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_h", F.xxhash64("ids"))
    along = rows.repartitionByRange("hilbert", "doc_id", "_h").sortWithinPartitions("hilbert", "doc_id", "_h")
    return along.select("doc_id", "hilbert", "ids").mapInArrow(_pack(length, itemsize), PIECES)
