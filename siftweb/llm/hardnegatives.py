"""Hard negatives by segment summary filtering.

Each vector is cut into segments, ``LEVELS`` of them at growing fineness, and
stored with every segment's mean m and standard deviation s.  For two vectors
the products of a segment of length l lie within ``l (m m' +- s s')``, so the
summaries bound an inner product from both sides.  A comparison starts with the
coarsest segments, refines the pairs that are still open, and multiplies exactly
what the finest summaries leave open.

Rows form blocks of about ``CELLS`` numbers by a hash of their label and id,
anchors blocks of about ``ANCHOR_CELLS``; a label that a third of all rows share
is many blocks.  An anchor block and a row block meet by an equi-join on the
block's name.

1. Positives: anchor blocks meet the blocks of their own label's bucket.  A row is
   out once ``positives`` others of the block have lower bounds above its upper
   bound.  The best of each block are cut to the best of each anchor.
2. Negatives: a positive's score p opens the window from ``floor_share`` p to p
   (hundredths, rounded inwards).  Anchor blocks meet all blocks; a row of another
   label is out of a window if its bounds lie beside it, or if ``negatives`` others
   of the block lie in the window for sure and above it.  The best of each block
   are cut to the best of each anchor and positive.

Defined cases: rows with a null vec_id, label or vector, or with null or
non-finite entries take no part; only vectors of equal length meet; rows that
repeat a vec_id count once, with the smallest (label, vector); ties go to the
smaller vec_id; anchors without another row of their label give nothing, nor do
negative positive scores (their window is empty); an empty table gives no rows;
other columns are ignored.  Scores are exact while they fit 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftweb.llm.whitening import sound
from siftweb.session import scratch_path

LEVELS = (4, 16)
CELLS, ANCHOR_CELLS, LABEL_BUCKETS = 1 << 17, 1 << 16, 16
ROW = "vec_id long, label int, dim int, v array<long>, mean array<double>, dev array<double>"


def edges(d: int, level: int) -> np.ndarray:
    """Ends of the segments of a level; each level's cut those of the one before."""
    return np.unique(np.arange(level + 1) * d // level)


def summaries(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments of all levels, side by side."""
    f, mean, dev = v.astype(np.float64), [], []
    for level in LEVELS:
        e = edges(v.shape[1], level)
        n = np.diff(e)
        m = np.add.reduceat(f, e[:-1], axis=1) / n
        rest = f - np.repeat(m, n, axis=1)
        mean.append(m)
        dev.append(np.sqrt(np.add.reduceat(rest * rest, e[:-1], axis=1) / n))
    return np.concatenate(mean, 1), np.concatenate(dev, 1)


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def lists(m: np.ndarray, kind) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]),
                                        pa.array(m.ravel(), kind))
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for d in np.unique(dims).tolist():
            rows = batch.filter(pa.array(dims == d))
            v = rows.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            mean, dev = summaries(v)
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id"), rows.column("label"), rows.column("dim"), lists(v, pa.int64()),
                 lists(mean, pa.float64()), lists(dev, pa.float64())],
                names=["vec_id", "label", "dim", "v", "mean", "dev"])


class _Block:
    """The rows of one block, by vec_id."""

    def __init__(self, cell: pa.StructArray):
        def numbers(name):
            return cell.field(name).to_numpy(zero_copy_only=False)
        ids = numbers("vec_id")
        order = np.argsort(ids, kind="stable")
        self.id, self.label = ids[order], numbers("label")[order]
        self.v, self.mean, self.dev = (
            cell.field(c).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)[order] for c in ("v", "mean", "dev"))
        self.windows = None
        if "windows" in [f.name for f in cell.type]:
            self.windows = [cell.field("windows")[i].as_py() for i in order.tolist()]


def bounds(q: _Block, x: _Block, rows: np.ndarray, cols: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of all inner products of some rows by the segments of one level."""
    d = q.v.shape[1]
    sizes = [len(edges(d, n)) - 1 for n in LEVELS]
    a = sum(sizes[:level])
    part, n = slice(a, a + sizes[level]), np.diff(edges(d, LEVELS[level]))
    middle = (q.mean[rows, part] * n) @ x.mean[cols, part].T
    reach = (q.dev[rows, part] * n) @ x.dev[cols, part].T
    reach += 1 + 1e-9 * (np.abs(middle) + reach)  # roundings
    return middle - reach, middle + reach


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if top < 2.0 ** 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def best(group: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each group's k highest scores, ties to the smaller id."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    return order[np.arange(len(g)) - np.searchsorted(g, g) < k]


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest value of each row."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, -k]


def _shrink(open_: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r, c = np.flatnonzero(open_.any(1)), np.flatnonzero(open_.any(0))
    return open_[np.ix_(r, c)], rows[r], cols[c]


def near_in_block(q: _Block, x: _Block, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score): each anchor's k best of its label in the block."""
    rows, cols = np.arange(len(q.id)), np.arange(len(x.id))
    open_ = (q.label[:, None] == x.label) & (q.id[:, None] != x.id)
    for level in range(len(LEVELS)):
        open_, rows, cols = _shrink(open_, rows, cols)
        low, high = bounds(q, x, rows, cols, level)
        open_ &= high >= _kth(np.where(open_, low, -np.inf), k)[:, None]
    open_, rows, cols = _shrink(open_, rows, cols)
    s = products(q.v[rows], x.v[cols])
    r, c = np.nonzero(open_)
    keep = best(r, x.id[cols[c]], s[r, c], k)
    return rows[r[keep]], cols[c[keep]], s[r[keep], c[keep]]


def windows_in_block(q: _Block, x: _Block, low_at: np.ndarray, high_at: np.ndarray, k: int):
    """(anchor, window, row, score): the k best rows of another label in each
    window; ``low_at`` and ``high_at`` are anchors x windows, empty ones reversed."""
    rows, cols = np.arange(len(q.id)), np.arange(len(x.id))
    open_ = q.label[:, None] != x.label
    for level in range(len(LEVELS)):
        open_, rows, cols = _shrink(open_, rows, cols)
        low, high = bounds(q, x, rows, cols, level)
        still = np.zeros_like(open_)
        for w in range(low_at.shape[1]):
            a, b = low_at[rows, w][:, None], high_at[rows, w][:, None]
            sure = open_ & (low >= a) & (high <= b)
            least = np.maximum(_kth(np.where(sure, low, -np.inf), k)[:, None], a)
            still |= open_ & (high >= least) & (low <= b) & (a <= b)
        open_ = still
    open_, rows, cols = _shrink(open_, rows, cols)
    s = products(q.v[rows], x.v[cols])
    found = [np.nonzero(open_ & (s >= low_at[rows, w][:, None]) & (s <= high_at[rows, w][:, None]))
             for w in range(low_at.shape[1])]
    r, c = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    w = np.repeat(np.arange(low_at.shape[1]), [len(f[0]) for f in found])
    keep = best(r * low_at.shape[1] + w, x.id[cols[c]], s[r, c], k)
    return rows[r[keep]], w[keep], cols[c[keep]], s[r[keep], c[keep]]


def _positives(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q, x = _Block(batch.column("q")[i].values), _Block(batch.column("x")[i].values)
                a, b, s = near_in_block(q, x, k)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (q.id[a], x.id[b], s)],
                                                 names=["anchor_id", "positive_id", "positive_score"])
    return run


def _negatives(k: int, floor_share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q, x = _Block(batch.column("q")[i].values), _Block(batch.column("x")[i].values)
                most = max(map(len, q.windows))
                pid = np.full((len(q.id), most), -1, np.int64)
                low, high = np.zeros(pid.shape, np.int64), np.full(pid.shape, -1, np.int64)  # low > high: none
                for r, held in enumerate(q.windows):
                    for w, one in enumerate(held):
                        p = one["positive_score"]
                        pid[r, w], low[r, w], high[r, w] = one["positive_id"], -(-floor_share * p // 100), p
                a, w, b, s = windows_in_block(q, x, low, high, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in (q.id[a], pid[a, w], high[a, w], x.id[b], s)],
                    names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])
    return run


def _part(cells: int) -> Column:
    """Which of its group's blocks a row belongs to, given the group's size ``n``."""
    return F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("n") * F.col("dim") / cells)).cast("int")


def _blocks(rows: DataFrame, sizes: DataFrame, keys: list[str], cells: int, name: str) -> DataFrame:
    held = [c for c in ("vec_id", "label", "v", "mean", "dev", "windows") if c in rows.columns]
    return rows.join(F.broadcast(sizes), keys).withColumn("part", _part(cells)) \
        .groupBy(*keys, "part").agg(F.collect_list(F.struct(*held)).alias(name))


def mine(vectors: DataFrame, is_anchor: Column, label: Column, scale: int = 256, positives: int = 5,
         negatives: int = 5, floor_share: int = 80) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has vec_id and embedding; ``label`` and ``is_anchor`` are over its
    columns.  A negative n of a positive p fulfils ``floor_share * p <= 100 * n <=
    100 * p``."""
    spark = vectors.sparkSession
    path = scratch_path(spark, "negatives")
    x = F.col("embedding")
    ints = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("int").alias("label"), is_anchor.alias("anchor"),
        F.when(sound(x), F.transform(x, lambda a: F.floor(a.cast("double") * F.lit(float(scale))))).alias("v")) \
        .filter("vec_id is not null and label is not null and v is not null")
    one = ints.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("s"), F.max("anchor").alias("anchor"))
    one.write.parquet(f"{path}/ints")
    one = spark.read.parquet(f"{path}/ints")
    one.select("vec_id", "s.label", F.size("s.v").alias("dim"), "s.v").mapInArrow(_summarise, ROW) \
        .withColumn("bucket", F.pmod(F.xxhash64("label"), F.lit(LABEL_BUCKETS)).cast("int")).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    anchors = rows.join(one.filter("anchor").select("vec_id"), "vec_id", "left_semi")

    # One row per vector length and label bucket: LABEL_BUCKETS rows for each length.
    sizes = rows.groupBy("dim", "bucket").agg(F.count(F.lit(1)).alias("n"))
    sizes.write.parquet(f"{path}/sizes")
    sizes = spark.read.parquet(f"{path}/sizes")
    all_blocks = _blocks(rows, sizes, ["dim", "bucket"], CELLS, "x")
    parts = sizes.select("dim", "bucket", F.ceil(F.col("n") * F.col("dim") / CELLS).cast("int").alias("parts"))

    def meet(blocks: DataFrame, keys: list[str]) -> DataFrame:
        plan = blocks.join(F.broadcast(parts), keys)
        each = plan.select("dim", "bucket", "q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        return each.join(all_blocks, ["dim", "bucket", "part"]).select("q", "x")

    count = anchors.groupBy("dim", "bucket").agg(F.count(F.lit(1)).alias("n"))
    own = _blocks(anchors, count, ["dim", "bucket"], ANCHOR_CELLS, "q").drop("part")
    kind = "anchor_id long, positive_id long, positive_score long"
    near = meet(own, ["dim", "bucket"]).mapInArrow(_positives(positives), kind)
    w = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= positives).drop("_r").write.parquet(f"{path}/near")

    held = spark.read.parquet(f"{path}/near").groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("windows"))
    asking = anchors.join(held, "vec_id")
    count = anchors.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    own = _blocks(asking, count, ["dim"], ANCHOR_CELLS, "q").drop("part")
    found = meet(own, ["dim"]).mapInArrow(_negatives(negatives, floor_share), f"{kind}, negative_id long, negative_score long")
    w = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= negatives) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
