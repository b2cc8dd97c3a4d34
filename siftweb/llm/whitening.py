"""Whitening of embedding vectors on their principal components.

A component c of a vector becomes the integer ``x = floor(64 c) + 1000000``.
The fit list holds each distinct x vector once: n vectors with sums S.  Their
covariance V (divisor n) is made of exact integers: x is centred at the rounded
mean before multiplying, and what the rounding leaves is taken off exactly, so
each entry of V is rounded once.  ``feast`` finds the largest eigenpairs of V;
a row's whitened value on a component is ``x - S/n`` projected on the unit
eigenvector, over the square root of the eigenvalue.

Spark does everything that grows with the rows: the distinct vectors are written
once; sums, products and the covariance of the whitened vectors (Chan's merge of
centred sums) are taken per task, merged by ``SLOTS`` tasks, and reach the driver
as ``SLOTS`` tables of dim x dim numbers at most; the projection is one narrow
pass.  Only the dim x dim eigenproblem is solved on the driver.

Defined cases: rows whose vector is null, empty or holds null or non-finite
entries are dropped; vectors of each length are whitened by themselves; other
rows keep their vec_id (null too, repeated ones as often as they come);
components whose eigenvalue is at most ``FLAT`` times the largest have no
whitened value and are left out, so equal vectors give no rows; x is cut at the
ends of 64 bits, and a deviation beyond 64 bits is null; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftweb.llm import feast
from siftweb.session import scratch_path

SCALE, SHIFT, COMPONENTS, SLOTS, FLAT = 64, 1_000_000, 16, 64, 1e-10
RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")
_SAFE = 2 ** 62


def sound(x: Column) -> Column:
    """The vector takes part: it has entries, all of them finite numbers."""
    fine = F.forall(x, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a.cast("double")) < float("inf")))
    return F.coalesce(x.isNotNull() & (F.size(x) > 0) & fine, F.lit(False))


def shifted(x: Column) -> Column:
    most = F.lit(2 ** 63 - 1 - SHIFT)
    return F.transform(x, lambda a: F.least(F.floor(a.cast("double") * F.lit(float(SCALE))), most) + F.lit(SHIFT))


# ------------------------------------------------------- exact integer sums

def _wide(a: np.ndarray) -> np.ndarray:
    return a if a.dtype == object else a.astype(object)


def added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact sum: 64-bit numbers while they surely suffice, then Python's."""
    if a.dtype != object and b.dtype != object and _peak(a) + _peak(b) < _SAFE:
        return a + b
    return _wide(a) + _wide(b)


def _peak(a: np.ndarray) -> int:
    return max(abs(int(a.max(initial=0))), abs(int(a.min(initial=0))))


def products(y: np.ndarray) -> np.ndarray:
    """Exact ``y.T @ y``."""
    most = _peak(y) ** 2 * max(len(y), 1)
    if most < 2 ** 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    if most < _SAFE and y.dtype != object:
        return y.T @ y
    return _wide(y).T @ _wide(y)


def centred(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Exact ``x - at``."""
    if x.dtype != object and at.dtype != object and _peak(x) + _peak(at) < _SAFE:
        return x - at
    return _wide(x) - _wide(at)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Exact ``n x - S``."""
    if x.dtype != object and sums.dtype != object and n * _peak(x) + _peak(sums) < _SAFE:
        return n * x - sums
    return n * _wide(x) - _wide(sums)


def _squares(d: np.ndarray) -> pa.Array:
    """Exact sums of squares of each row; null beyond 64 bits."""
    if d.dtype != object and _peak(d) ** 2 * d.shape[1] < _SAFE:
        return pa.array((d * d).sum(1), pa.int64())
    return pa.array([int(s) if s < 2 ** 63 else None for s in (_wide(d) ** 2).sum(1)], pa.int64())


# --------------------------------------------------- merging over all tasks

def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, vectors) of each vector length of a batch."""
    lists = batch.column("x")
    sizes = np.diff(lists.offsets.to_numpy())
    flat, at = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)])
    for d in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == d)
        yield rows, flat[at[rows][:, None] + np.arange(d)]


def merged(rows: DataFrame, part: Callable[[np.ndarray], object | None], merge: Callable) -> dict[int, object]:
    """``merge`` over ``part`` of all vectors, by vector length."""
    kind = "slot int, dim int, state binary"

    def table(slot: int, held: dict[int, object]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([slot] * len(held), pa.int32()), pa.array(list(held), pa.int32()),
             pa.array([pickle.dumps(x) for x in held.values()], pa.binary())], names=["slot", "dim", "state"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, object] = {}
        for batch in batches:
            for _, x in _matrices(batch):
                got, d = part(x), x.shape[1]
                if got is not None:
                    held[d] = merge(held[d], got) if d in held else got
        yield table(TaskContext.get().partitionId() % SLOTS, held)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, object] = {}
        for batch in batches:
            for d, state in zip(batch.column("dim").to_pylist(), batch.column("state")):
                got = pickle.loads(state.as_py())
                held[d] = merge(held[d], got) if d in held else got
        yield table(0, held)

    done: dict[int, object] = {}
    for r in rows.select("x").mapInArrow(first, kind).repartition(SLOTS, "slot").mapInArrow(second, kind).collect():
        got = pickle.loads(r["state"])
        done[r["dim"]] = merge(done[r["dim"]], got) if r["dim"] in done else got
    return done


def _pairwise(a, b):
    return a[0] + b[0], added(a[1], b[1])


def _chan(a, b):
    """Counts, means and centred product sums of two sets of rows as of one."""
    (n, m, s), (k, l, t) = a, b
    step = l - m
    return n + k, m + step * (k / (n + k)), s + t + np.outer(step, step) * (n * k / (n + k))


# ------------------------------------------------------------------- fitting

@dataclass
class Fit:
    """What whitens the vectors of one length."""

    n: int
    sums: np.ndarray  # dim, exact
    components: np.ndarray  # dim x k, unit columns
    values: np.ndarray  # k eigenvalues, falling
    explained: np.ndarray  # k
    identity_error: float = 0.0

    def whitened(self, d: np.ndarray) -> np.ndarray:
        """Of the rows ``d = n x - S``."""
        return (d.astype(np.float64) / self.n) @ self.components / np.sqrt(self.values)


def covariance(n: int, sums: np.ndarray, at: np.ndarray, products: np.ndarray) -> np.ndarray:
    """V from the exact products of ``x - at``: one rounding per entry."""
    rest = _wide(sums) - n * _wide(at)
    top = n * _wide(products) - np.outer(rest, rest)
    return np.array([[float(v) / float(n * n) if abs(v) < 2 ** 1000 else v / (n * n) for v in row] for row in top.tolist()])


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """By vector length; ``vectors`` has the column ``embedding``."""
    spark = vectors.sparkSession
    path = scratch_path(spark, "whitening")
    vectors.filter(sound(F.col("embedding"))).select(shifted(F.col("embedding")).alias("x")) \
        .dropDuplicates(["x"]).write.parquet(path)
    rows = spark.read.parquet(path)

    def sums(x):
        return len(x), x.sum(0) if _peak(x) * len(x) < _SAFE else _wide(x).sum(0)

    total = merged(rows, sums, _pairwise)
    means = {d: np.array([(2 * int(s) + n) // (2 * n) for s in t], object) for d, (n, t) in total.items()}
    means = {d: m.astype(np.int64) if _peak(m) < _SAFE else m for d, m in means.items()}

    def squares(x):
        return len(x), products(centred(x, means[x.shape[1]]))

    gram = merged(rows, squares, _pairwise)
    fits = {}
    for d, (n, t) in total.items():
        v = covariance(n, t, means[d], gram[d][1])
        e, u = feast.largest(v, components)
        keep = e > FLAT * e.max(initial=0)
        trace = float(np.trace(v))
        if keep.any():
            fits[d] = Fit(n, t, u[:, keep], e[keep], e[keep] / trace)

    def spread(x):
        f = fits.get(x.shape[1])
        if f is None:
            return None
        w = f.whitened(deviations(x, f.n, f.sums))
        m = w.mean(0)
        return len(w), m, (w - m).T @ (w - m)

    for d, (n, _, s) in merged(rows, spread, _chan).items():
        fits[d].identity_error = float(np.abs(s / n - np.eye(len(s))).max())
    return fits


def whiten(vectors: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error):
    a row for each usable row of ``vectors`` and each component of its length."""
    shared = vectors.sparkSession.sparkContext.broadcast(fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _matrices(batch):
                f = shared.value.get(x.shape[1])
                if f is None:
                    continue
                d = deviations(x, f.n, f.sums)
                w, k = f.whitened(d), len(f.values)
                each = pa.array(np.repeat(np.arange(len(rows)), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows)).take(each),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                     pa.array(np.full(len(each), f.n)), _squares(d).take(each), pa.array(w.ravel()),
                     pa.array(np.tile(f.explained, len(rows))), pa.array(np.full(len(each), f.identity_error))],
                    names=[c.split()[0] for c in RESULT.split(", ")])

    x = F.col("embedding")
    return vectors.filter(sound(x)).select(F.col("vec_id").cast("long").alias("vec_id"), shifted(x).alias("x")) \
        .mapInArrow(run, RESULT)
