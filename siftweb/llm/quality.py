"""Quality classifier: a factorisation machine.

A document's sparse features are

* its words (A-Z lower-cased) hashed to ``BUCKETS`` buckets, with the square
  roots of the counts scaled to unit length,
* about twenty structure statistics, each cut into bins (one feature per bin),
* metadata: the bin of the ``n_chars`` column (its own bin where it is null).

The score is the logistic function of ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j>
x_i x_j``.  The pairwise sum costs linear time as ``1/2 sum_f ((sum_i v_if
x_i)^2 - sum_i v_if^2 x_i^2)``.

``fit`` learns from at most ``SAMPLE`` labelled documents, picked by a hash of
their doc_id; that bound also makes the join with ``documents`` a broadcast of
at most ``SAMPLE`` ids, and the driver's fit a fixed amount of work.  ``score``
is a narrow pass over whole texts.

Defined cases: null text is empty; empty texts are scored by their statistics;
several labels of a doc_id are averaged (one half counts as 1), null labels
and null doc_ids are not learned; without any label the score is 0.5; repeated
rows are scored each; an empty table gives no rows; other columns are ignored,
and a missing ``n_chars`` counts as null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftweb.llm import vec

BUCKETS, BINS, LENGTH_BINS = 1 << 14, 12, 32
SAMPLE, RANK, EPOCHS, BATCH, RATE, DECAY = 4000, 8, 8, 200, 0.1, 1e-4

_UPPER, _LOWER, _DIGIT, _HIGH, _LINE = (np.zeros(256, bool) for _ in range(5))
_UPPER[0x41:0x5B] = _LOWER[0x61:0x7B] = _DIGIT[0x30:0x3A] = _HIGH[0x80:] = True
_LINE[0x0A] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:?'\"-()")] = True
_SIGN = np.zeros(256, bool)
_SIGN[33:127] = True
_SIGN &= ~(_UPPER | _LOWER | _DIGIT | _STOP)
_SIGNS = list(b"|!#$%&*<>{}=/_")


def _per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    s = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return s[off[1:]] - s[off[:-1]]


def statistics(data: np.ndarray, off: np.ndarray, h: np.ndarray, woff: np.ndarray,
               start: np.ndarray, end: np.ndarray, top: np.ndarray, distinct: np.ndarray) -> list[np.ndarray]:
    """Shares between 0 and 1, one array over the documents for each."""
    size, n = np.maximum(np.diff(off), 1), np.maximum(np.diff(woff), 1)
    shares = [_per_doc(t[data], off) / size for t in (_UPPER, _DIGIT, _HIGH, _STOP, _SIGN, _LINE)]
    shares += [_per_doc(data == c, off) / size for c in _SIGNS]
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    again = np.zeros(len(h), bool)
    again[2:] = h[2:] == h[:-2]
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    first = data[start] if len(start) else np.zeros(0, np.uint8)
    shares += [_per_doc(x, woff) / n for x in (same, again, last == 0x2E, _SIGN[last], _UPPER[first])]
    shares += [distinct / n, top / n, np.minimum(1, _per_doc(end - start, woff) / n / 32),
               np.minimum(1, n / np.maximum(_per_doc(data == 0x0A, off) + 1, 1) / 256)]
    return shares


N_SHARES = 6 + len(_SIGNS) + 5 + 4
SIZE = BUCKETS + N_SHARES * BINS + 3 * LENGTH_BINS


def features(data: np.ndarray, off: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, value, offsets) of the documents of a slice; n_chars: -1 for null."""
    low = vec.lower(data)
    start, end, woff = vec.words(low, off)
    h = vec.word_hashes(low, start, end)
    docs = len(off) - 1
    doc = np.repeat(np.arange(docs), np.diff(woff))
    key, count = np.unique(doc * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
    owner, bucket = key // BUCKETS, key % BUCKETS
    total = np.maximum(np.bincount(owner, count, docs), 1)
    distinct = np.bincount(owner, minlength=docs)
    top = np.zeros(docs)
    np.maximum.at(top, owner, count)
    shares = statistics(data, off, h, woff, start, end, top, distinct)
    columns = [BUCKETS + k * BINS + np.minimum((np.sqrt(np.clip(s, 0, 1)) * BINS).astype(np.int64), BINS - 1)
               for k, s in enumerate(shares)]
    base = BUCKETS + N_SHARES * BINS
    for k, x in enumerate((np.diff(off), np.diff(woff), n_chars + 1)):
        columns.append(base + k * LENGTH_BINS + np.minimum(np.log2(np.maximum(x, 0) + 1).astype(np.int64), LENGTH_BINS - 1))
    fixed = np.stack(columns, 1)
    idx = np.concatenate([bucket, fixed.ravel()])
    val = np.concatenate([np.sqrt(count / total[owner]), np.full(fixed.size, 0.5)])
    who = np.concatenate([owner, np.repeat(np.arange(docs), fixed.shape[1])])
    order = np.argsort(who, kind="stable")
    return idx[order], val[order], np.concatenate([[0], np.cumsum(np.bincount(who, minlength=docs))])


@dataclass
class Machine:
    bias: float
    w: np.ndarray  # SIZE
    v: np.ndarray  # SIZE x RANK

    def margin(self, idx: np.ndarray, val: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Sum-of-squares identity over each document's features (none is empty)."""
        vx = self.v[idx] * val[:, None]
        s = np.add.reduceat(vx, off[:-1], axis=0)
        sq = np.add.reduceat(vx * vx, off[:-1], axis=0)
        return self.bias + np.add.reduceat(self.w[idx] * val, off[:-1]) + 0.5 * (s * s - sq).sum(1)

    def scores(self, idx, val, off) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(idx, val, off), -30, 30)))


def learn(idx: np.ndarray, val: np.ndarray, off: np.ndarray, y: np.ndarray, rank: int = RANK) -> Machine:
    """Logistic loss by AdaGrad over fixed batches."""
    rng = np.random.default_rng(7)
    m = Machine(0.0, np.zeros(SIZE), rng.normal(0, 0.02, (SIZE, rank)))
    if not len(y):
        m.v[:] = 0
        return m
    m.bias = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    gw, gv, gb = np.full(SIZE, 1e-2), np.full((SIZE, rank), 1e-2), 1.0
    rows = rng.permutation(len(y))
    batches = []
    for a in range(0, len(rows), BATCH):
        part = rows[a: a + BATCH]
        n = off[part + 1] - off[part]
        boff = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(off[part] - boff[:-1], n) + np.arange(boff[-1])
        order = np.argsort(idx[at], kind="stable")
        some, first = np.unique(idx[at][order], return_index=True)
        batches.append((idx[at], val[at], boff, np.repeat(np.arange(len(part)), n), y[part], order, some, first))
    for _ in range(EPOCHS):
        for b in rng.permutation(len(batches)):
            i, x, boff, who, target, order, some, first = batches[b]
            vx = m.v[i] * x[:, None]
            s = np.add.reduceat(vx, boff[:-1], axis=0)
            sq = np.add.reduceat(vx * vx, boff[:-1], axis=0)
            margin = m.bias + np.add.reduceat(m.w[i] * x, boff[:-1]) + 0.5 * (s * s - sq).sum(1)
            g = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - target
            dw = np.add.reduceat((g[who] * x)[order], first) + DECAY * m.w[some]
            dv = np.add.reduceat(((g[who] * x)[:, None] * (s[who] - vx))[order], first, axis=0) + DECAY * m.v[some]
            gw[some] += dw * dw
            gv[some] += dv * dv
            gb += g.sum() ** 2
            m.w[some] -= RATE * dw / np.sqrt(gw[some])
            m.v[some] -= RATE * 0.3 * dv / np.sqrt(gv[some])
            m.bias -= RATE * g.sum() / np.sqrt(gb)
    return m


def held_out(doc_id: Column) -> Column:
    """Never learned from: crc32 of the doc_id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled(labels: DataFrame, column: str, sample: int) -> DataFrame:
    """(doc_id, label) of at most ``sample`` doc_ids outside the held-out third."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).alias("_y")) \
        .filter(F.col("doc_id").isNotNull() & F.col("_y").isNotNull() & ~held_out(F.col("doc_id")))
    one = rows.groupBy("doc_id").agg((F.avg("_y") >= 0.5).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def _plain(docs: DataFrame) -> DataFrame:
    n = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(n, F.lit(-1)).alias("n_chars"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, off in vec.slices(batches):
        idx, val, foff = features(data, off, rows.column("n_chars").to_numpy())
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("label"),
             pa.ListArray.from_arrays(pa.array(foff, pa.int32()), pa.array(idx, pa.int32())),
             pa.ListArray.from_arrays(pa.array(foff, pa.int32()), pa.array(val, pa.float32()))],
            names=["doc_id", "label", "idx", "val"])


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", sample: int = SAMPLE) -> Machine:
    """The sampled ids (at most ``sample`` rows) meet the documents by a broadcast join."""
    chosen = _plain(docs).join(F.broadcast(labelled(labels, column, sample)), "doc_id")
    rows = chosen.mapInArrow(_extract, "doc_id long, label int, idx array<int>, val array<float>")
    got = rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("idx")).limit(sample) \
        .select("label", "idx", "val").toArrow().combine_chunks()
    lists = [got.column(c).combine_chunks() for c in ("idx", "val")]
    n = np.array([len(x) for x in lists[0]], np.int64)
    machine = learn(lists[0].flatten().to_numpy().astype(np.int64), lists[1].flatten().to_numpy().astype(float),
                    np.concatenate([[0], np.cumsum(n)]), got.column("label").to_numpy().astype(float))
    got = lists = None
    vec.give_back()
    return machine


def score(docs: DataFrame, model: Machine) -> DataFrame:
    """(doc_id, score) of every row, in one narrow pass.  The model is about
    1.2 MB whatever the input, and travels in a broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.bias, model.w.astype(np.float32), model.v.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Machine(*shared.value)
        for rows, data, off in vec.slices(batches):
            s = m.scores(*features(data, off, rows.column("n_chars").to_numpy()))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(s, pa.float64())], names=["doc_id", "score"])
    return _plain(docs).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Machine, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.bias, model.w.astype(np.float32), model.v.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Machine(*shared.value)
        for rows, data, off in vec.slices(batches):
            n = rows.column("n_chars").fill_null(-1).to_numpy() if "n_chars" in rows.schema.names \
                else np.full(rows.num_rows, -1)
            yield rows.filter(pa.array(m.scores(*features(data, off, n)) >= least))
    plain = vec.numbered(docs)
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
