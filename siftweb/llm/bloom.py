"""A Bloom filter of ids, of one fixed size whatever the input.

It cuts a large table down to the rows that may join with an id set, in a
narrow pass before the exact join, so that only those are shuffled.  Its
bits are set by an aggregation over 64-bit words, of which there are at most
``2**(BITS - 6)``; that many (8 MB by default) reach the driver and go out in
a broadcast.  Ids beyond what the bits can tell apart only let more rows
through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftweb.llm.vec import mix

BITS = 26
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _places(ids: np.ndarray, bits: int) -> np.ndarray:
    x = ids.astype(np.int64).view(np.uint64)
    return np.concatenate([mix(x ^ np.uint64(s)) >> np.uint64(64 - bits) for s in _SEEDS])


class Bloom:
    def __init__(self, ids: DataFrame, column: str, bits: int = BITS):
        def words(batches):
            for batch in batches:
                p = _places(batch.column(0).drop_null().to_numpy(zero_copy_only=False), bits)
                w, b = p >> np.uint64(6), np.uint64(1) << (p & np.uint64(63))
                order = np.argsort(w, kind="stable")
                some, first = np.unique(w[order], return_index=True)
                both = np.bitwise_or.reduceat(b[order], first) if len(some) else b
                yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array(both.view(np.int64))], names=["w", "b"])

        from pyspark.sql import functions as F
        got = ids.select(F.col(column).cast("long")).mapInArrow(words, "w long, b long") \
            .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
        table = np.zeros(1 << (bits - 6), np.uint64)
        table[got.column("w").to_numpy()] = got.column("b").to_numpy().view(np.uint64)
        self.bits = bits
        self.table = ids.sparkSession.sparkContext.broadcast(table)

    def may_hold(self, ids: np.ndarray) -> np.ndarray:
        """For use in tasks: False where an id is surely not in the set."""
        p = _places(ids, self.bits)
        hit = (self.table.value[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1)
        return hit.reshape(len(_SEEDS), -1).all(0)
