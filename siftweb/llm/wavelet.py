"""Token-id shards as wavelet matrices.

A shard holds the ids of consecutive documents (ascending doc_id).  Per bit
of an id, from the highest, it has one bit-plane; between planes the ids are
stably split into those with 0 and those with 1.  Each plane has a directory
of ones before every 512 bits, so rank and select, and with them access,
counting and occurrence lookup, read only a few words of the planes.

Shards are rows of a Parquet table, one shard per file, zstd-compressed:
``shard`` (sorts in corpus order), ``n_tokens``, ``zeros``, ``planes``,
``directory``, ``doc_ids``, ``doc_tokens``.  The table's writer is Spark's,
so files appear only when their task commits and any Hadoop store serves.

Defined cases: null text is empty (only the end id); a null doc_id sorts
first; rows that repeat a doc_id are documents of their own, ordered by the
text's hash; a document longer than a shard is a shard of its own; an empty
table writes no shard; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftweb.llm import tokens, vec

SHARD_TOKENS, BITS = 4_000_000, 512
#: Bytes of text that are cut and looked up at once: more share more words.
SLICE = 8 << 20
SCHEMA = ("shard long, n_tokens long, zeros array<long>, planes array<binary>, "
          "directory array<binary>, doc_ids array<long>, doc_tokens array<long>")


@dataclass
class WaveletMatrix:
    n: int
    zeros: list[int]
    planes: list[np.ndarray]  # packed bits, big-endian within a byte
    directory: list[np.ndarray]  # ones before each block of BITS bits

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        cur = np.asarray(ids)
        levels = max(1, int(cur.max(initial=0)).bit_length())
        zeros, planes, directory = [], [], []
        for level in range(levels - 1, -1, -1):
            one = ((cur >> cur.dtype.type(level)) & cur.dtype.type(1)).astype(bool)
            packed = np.packbits(one)
            ones = np.bitwise_count(packed)
            ones = np.concatenate([ones, np.zeros(-len(ones) % (BITS // 8), ones.dtype)])
            block = ones.reshape(-1, BITS // 8).sum(1, dtype=np.int64)
            directory.append(np.concatenate([[0], np.cumsum(block)]).astype("<u4"))
            planes.append(packed)
            cur = np.concatenate([cur[~one], cur[one]])
            zeros.append(len(one) - int(directory[-1][-1]))
        return cls(len(ids), zeros, planes, directory)

    def rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        b, bits = divmod(i, BITS)
        part = self.planes[level][b * BITS // 8: (i + 7) // 8]
        if not bits:
            return int(self.directory[level][b])
        count = int(np.bitwise_count(part).sum())
        if i % 8:
            count -= int(part[-1] & ((1 << (8 - i % 8)) - 1)).bit_count()
        return int(self.directory[level][b]) + count

    def select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of a bit in a plane."""
        d = self.directory[level].astype(np.int64)
        before = d if bit else np.minimum(np.arange(len(d)) * BITS, self.n) - d
        b = int(np.searchsorted(before, k, side="right")) - 1
        word = np.unpackbits(self.planes[level][b * BITS // 8: (b + 1) * BITS // 8])[: self.n - b * BITS]
        return b * BITS + int(np.flatnonzero(word == bit)[k - int(before[b])])

    def access(self, i: int) -> int:
        value = 0
        for level, z in enumerate(self.zeros):
            r = self.rank1(level, i)
            bit = self.rank1(level, i + 1) - r
            value = value * 2 + bit
            i = z + r if bit else i - r
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the first i positions' occurrences of a token end up."""
        lo, hi = 0, i
        for level, z in enumerate(self.zeros):
            a, b = self.rank1(level, lo), self.rank1(level, hi)
            bit = (token >> (len(self.zeros) - 1 - level)) & 1
            lo, hi = (z + a, z + b) if bit else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, i: int | None = None) -> int:
        """Occurrences of a token among the first i positions (all by default)."""
        if token >> len(self.zeros):
            return 0
        lo, hi = self._range(token, self.n if i is None else i)
        return hi - lo

    def occurrence(self, token: int, k: int) -> int:
        """Position of a token's k-th (from 0) occurrence."""
        lo, hi = (0, 0) if token >> len(self.zeros) else self._range(token, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = (token >> (len(self.zeros) - 1 - level)) & 1
            i = self.select(level, bit, i - self.zeros[level] if bit else i)
        return i

    def decode(self) -> np.ndarray:
        """All ids: undo the splits from the lowest plane up."""
        cur = np.zeros(self.n, np.uint16 if len(self.zeros) <= 16 else np.uint32)
        for shift, (z, plane) in enumerate(zip(reversed(self.zeros), reversed(self.planes))):
            one = np.unpackbits(plane, count=self.n).astype(bool)
            up = np.empty_like(cur)
            up[~one] = cur[:z]
            up[one] = cur[z:]
            cur = up | (one.astype(cur.dtype) << cur.dtype.type(shift))
        return cur

    def row(self) -> dict:
        return {"n_tokens": self.n, "zeros": self.zeros, "planes": [p.tobytes() for p in self.planes],
                "directory": [d.tobytes() for d in self.directory]}

    @classmethod
    def from_row(cls, row: dict) -> WaveletMatrix:
        return cls(row["n_tokens"], list(row["zeros"]), [np.frombuffer(p, np.uint8) for p in row["planes"]],
                   [np.frombuffer(d, "<u4") for d in row["directory"]])


def _shard(no: int, docs: list[int | None], ids: list[np.ndarray]) -> pa.RecordBatch:
    flat = np.concatenate(ids)
    row = {"shard": no} | WaveletMatrix.build(flat).row() | {"doc_ids": docs, "doc_tokens": [len(x) for x in ids]}
    kinds = {"shard": pa.int64(), "n_tokens": pa.int64(), "zeros": pa.list_(pa.int64()),
             "planes": pa.list_(pa.binary()), "directory": pa.list_(pa.binary()),
             "doc_ids": pa.list_(pa.int64()), "doc_tokens": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays([pa.array([row[k]], t) for k, t in kinds.items()], names=list(kinds))


def _write(path: str, end_id: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = tokens.load("word", path)
        part, no = TaskContext.get().partitionId(), 0
        docs, ids, total = [], [], 0
        for rows, data, off in vec.slices(batches, limit=SLICE):
            for doc, x in zip(rows.column("doc_id").to_pylist(), tokens.encode_rows(pieces, rows, end_id)):
                if ids and total + len(x) > size:
                    yield _shard((part << 32) + no, docs, ids)
                    docs, ids, total, no = [], [], 0, no + 1
                docs.append(doc)
                ids.append(x)
                total += len(x)
        if ids:
            yield _shard((part << 32) + no, docs, ids)
    return run


def write_shards(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode all documents and write the shards under ``path``.

    One range shuffle of (doc_id, text); encoding follows it, so the
    sampling for the ranges reads the input only and encodes nothing."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .withColumn("_h", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h")
    ordered.select("doc_id", "text").mapInArrow(_write(tokenizer, end_id, shard_tokens), SCHEMA) \
        .write.option("compression", "zstd").option("maxRecordsPerFile", 1).parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {k: batch.column(k)[i].as_py() for k in ("shard", "n_tokens", "zeros", "planes", "directory")}
            ids = WaveletMatrix.from_row(row).decode().astype("<u4")
            n = batch.column("doc_tokens")[i].values.to_numpy()
            ends = np.cumsum(n)
            start = ends - n
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(start.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), row["shard"]), pa.int64()), batch.column("doc_ids")[i].values,
                 pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                names=["shard", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) decoded from the shards.

    Starts are sums of the shard sizes: first per writing partition (one
    row each for the global window), then within it."""
    from pyspark.sql import Window

    shards = spark.read.schema(SCHEMA).parquet(path)
    size = shards.select("shard", F.shiftright("shard", 32).alias("part"), "n_tokens")
    parts = size.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.withColumn("base", F.sum("n").over(Window.orderBy("part")) - F.col("n")).drop("n")
    inner = Window.partitionBy("part").orderBy("shard")
    first = size.join(parts, "part").select(
        "shard", (F.col("base") + F.sum("n_tokens").over(inner) - F.col("n_tokens")).alias("first"))
    read = shards.mapInArrow(_read, "shard long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return read.join(first, "shard").select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


FOUND = "shard long, n_tokens long, n_found long, occurrence long, id_at long"


def look_up(spark: SparkSession, path: str, token: int, k: int = 0, at: int = 0) -> DataFrame:
    """For each shard, by rank and select in its planes: how often it holds the
    token, the position of the token's k-th (from 0) occurrence and the id at
    position ``at``; null where the shard has no such occurrence or position.
    Positions count from the shard's start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                w = WaveletMatrix.from_row(row)
                n = w.count(token)
                rows.append((row["shard"], w.n, n, w.occurrence(token, k) if 0 <= k < n else None,
                             w.access(at) if 0 <= at < w.n else None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 names=["shard", "n_tokens", "n_found", "occurrence", "id_at"])
    shards = spark.read.schema(SCHEMA).parquet(path).select("shard", "n_tokens", "zeros", "planes", "directory")
    return shards.mapInArrow(run, FOUND)
