"""Toxicity: cumulative-link ordinal regression over sparse word features.

Words are runs of letters (A-Z lower-cased; bytes beyond ASCII are letters).
``fit`` takes at most ``SAMPLE`` labelled documents, picked by a hash of their
doc_id, and

1. selects words whose document share differs between toxic and other
   documents by more than ``Z`` standard deviations, in at least ``LEAST``
   documents (at most ``WORDS`` of them: the model's size);
2. gives grades 0..3: a labels table of 0/1 only says which documents are
   above grade 0, so toxic documents are graded by the tertiles of their
   evidence, the sum of x over words that toxic documents hold more often
   (a labels column of several grades is used as is);
3. fits ``P(grade > j) = logistic(w.x - threshold_j)`` with one weight vector
   for all ordered thresholds, x = log(1 + count) of each selected word.

``score`` gives for each document the expected severity, the sum of P(grade >
j) over j, the probability ``p_toxic`` = P(grade > 0), the likeliest grade,
and the decision ``toxic`` (p_toxic >= 0.5).

Defined cases: null text is empty; texts without a selected word get the
thresholds' base rate; several labels of a doc_id are averaged, null labels
and null doc_ids are not learned; without labels or selected words nothing is
toxic; repeated rows are scored each; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftweb.llm import vec
from siftweb.llm.quality import held_out

SAMPLE, WORDS, Z, LEAST, GRADES, STEPS, DECAY = 8000, 512, 5.0, 4, 3, 400, 2e-3

_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def counted(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, count, offsets) of each document's distinct words."""
    low = _LETTER[data]
    start, end, woff = vec.words(low, off)
    h = vec.word_hashes(low, start, end).view(np.int64)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(woff))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(h)))
    return h[at], n, np.searchsorted(doc[at], np.arange(len(off)))


@dataclass
class Model:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    def above(self, h: np.ndarray, n: np.ndarray, off: np.ndarray) -> np.ndarray:
        """P(grade > j), documents x thresholds."""
        eta = np.zeros(len(off) - 1)
        if len(self.words) and len(h):
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            hit = np.flatnonzero(self.words[at] == h)
            doc = np.searchsorted(off, hit, side="right") - 1
            eta = np.bincount(doc, self.weights[at[hit]] * np.log1p(n[hit]), len(eta))
        return 1 / (1 + np.exp(-np.clip(eta[:, None] - self.thresholds[None], -30, 30)))


def select(h: np.ndarray, doc: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Hashes of the words whose document shares differ most."""
    words, inverse, df = np.unique(h, return_inverse=True, return_counts=True)
    hot = np.bincount(inverse, toxic[doc], len(words))
    p = toxic.mean()
    z = (hot - df * p) / np.sqrt(np.maximum(df * p * (1 - p), 1e-9))
    strong = np.flatnonzero((df >= LEAST) & (np.abs(z) > Z))
    strong = strong[np.argsort(-np.abs(z[strong]), kind="stable")[:WORDS]]
    return np.sort(words[strong])


def learn(h: np.ndarray, n: np.ndarray, off: np.ndarray, label: np.ndarray) -> Model:
    """Select words, grade, and fit by Adam on the whole sample."""
    nothing = Model(np.zeros(0, np.int64), np.zeros(0), np.full(GRADES, 30.0))
    hot = (label > 0).astype(float)
    if not len(label) or hot.min() == hot.max():
        return nothing
    doc = np.repeat(np.arange(len(label)), np.diff(off))
    words = select(h, doc, hot)
    if not len(words):
        return nothing
    at = np.minimum(np.searchsorted(words, h), len(words) - 1)
    hit = words[at] == h
    x = np.zeros((len(label), len(words)))
    x[doc[hit], at[hit]] = np.log1p(n[hit])
    if len(np.unique(label)) <= 2:
        both = [np.bincount(at[hit], y[doc[hit]], len(words)) / y.sum() for y in (hot, 1 - hot)]
        share_hot = both[0] > both[1]
        hits = np.concatenate([(x[i:i + 256] * share_hot).sum(1) for i in range(0, len(x), 256)])
        cuts = np.quantile(hits[hot > 0], [1 / 3, 2 / 3])
        grade = np.where(hot > 0, 1 + np.searchsorted(cuts, hits, side="left"), 0).astype(int)
    else:
        grade = np.minimum(label.astype(int), GRADES)
    # Adam over (weights, first threshold, logs of the steps between thresholds).
    k = x.shape[1]
    par = np.concatenate([np.zeros(k), [2.0], np.full(GRADES - 1, -0.5)])
    m1, m2 = np.zeros_like(par), np.zeros_like(par)
    row = np.arange(len(grade))

    def thresholds(p):
        return p[k] + np.concatenate([[0], np.cumsum(np.exp(p[k + 1:]))])

    for t in range(1, STEPS + 1):
        th = thresholds(par)
        c = 1 / (1 + np.exp(-np.clip((x @ par[:k])[:, None] - th[None], -30, 30)))
        c = np.concatenate([np.ones((len(c), 1)), c, np.zeros((len(c), 1))], 1)
        lo, hi = c[row, grade], c[row, grade + 1]
        p = np.maximum(lo - hi, 1e-9)
        g_eta = -(1 - lo - hi) / len(grade)
        g_th = np.zeros((len(grade), GRADES + 2))
        g_th[row, grade] += lo * (1 - lo) / p
        g_th[row, grade + 1] -= hi * (1 - hi) / p
        g_th = g_th[:, 1:-1].sum(0) / len(grade)
        steps = np.exp(par[k + 1:])
        tail = np.cumsum(g_th[::-1])[::-1]
        g = np.concatenate([x.T @ g_eta + DECAY * par[:k] / max(k, 1), [tail[0]], tail[1:] * steps])
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        par -= 0.1 * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.999 ** t)) + 1e-8)
    return Model(words, par[:k].copy(), thresholds(par))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, off in vec.slices(batches):
        h, n, hoff = counted(data, off)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("label"),
             pa.ListArray.from_arrays(pa.array(hoff, pa.int32()), pa.array(h, pa.int64())),
             pa.ListArray.from_arrays(pa.array(hoff, pa.int32()), pa.array(n, pa.int32()))],
            names=["doc_id", "label", "h", "n"])


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", sample: int = SAMPLE) -> Model:
    """The sampled ids (at most ``sample`` rows) meet the documents by a broadcast join."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).alias("_y")) \
        .filter(F.col("doc_id").isNotNull() & F.col("_y").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = rows.groupBy("doc_id").agg(F.round(F.avg("_y")).cast("int").alias("label")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    met = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    got = met.mapInArrow(_extract, "doc_id long, label int, h array<long>, n array<int>") \
        .orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("h")).limit(sample) \
        .select("label", "h", "n").toArrow().combine_chunks()
    h, n = (got.column(c).combine_chunks() for c in ("h", "n"))
    off = np.concatenate([[0], np.cumsum([len(x) for x in h])]).astype(np.int64)
    model = learn(h.flatten().to_numpy(), n.flatten().to_numpy().astype(float), off,
                  got.column("label").to_numpy().astype(float))
    got = h = n = None
    vec.give_back()
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, severity, p_toxic, grade, toxic) of every row, in one narrow pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in vec.slices(batches):
            c = model.above(*counted(data, off))
            p = np.concatenate([np.ones((len(c), 1)), c], 1) - np.concatenate([c, np.zeros((len(c), 1))], 1)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(c.sum(1), pa.float64()), pa.array(c[:, 0], pa.float64()),
                 pa.array(p.argmax(1), pa.int32()), pa.array(c[:, 0] >= 0.5)],
                names=["doc_id", "severity", "p_toxic", "grade", "toxic"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, severity double, p_toxic double, grade int, toxic boolean")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not toxic, columns as they were."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in vec.slices(batches):
            yield rows.filter(pa.array(model.above(*counted(data, off))[:, 0] < 0.5))
    plain = vec.numbered(docs)
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
