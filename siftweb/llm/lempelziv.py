"""Substring dedup by relative Lempel-Ziv parsing.

Words are runs of bytes other than 0x20 and 0x09-0x0D.  A window is ``WINDOW``
consecutive words; a window whose words also start in a document with a
smaller doc_id is a repeat, and every word under a repeat goes.

1. Index.  Each document is cut at reference points: of every 25 consecutive
   runs of ``RUN`` = 26 words, the run with the smallest hash (and the first
   and the last run of the document).  Equal windows hold the same reference
   point at the same place.  Hash partitions of the points are the reference
   blocks; each point that more than one document holds gets its first
   document and position there (a partial minimum before the shuffle, so a
   passage in a third of all documents costs one row per task and point).
2. Factors.  A document looks all its points up in their blocks and is parsed
   greedily from the left: neighbouring points are at most 25 words apart and
   26 long, so while they lie in one reference document at one distance, the
   factor goes on, and all of its words are equal.  Factors of ``WINDOW``
   words or more are duplicate spans.
3. Boundaries.  Windows whose point is shared but which no factor covers run
   across a boundary (or their first match is not the point's first
   document).  They are looked up one by one in an index of such windows.
   That is exact: a window's first occurrence is under no factor, and a
   window whose point starts in its own document is no repeat.

Then spans are united and cut out.

Defined cases: null text has no words; a text without repeats is kept as it
is; a null doc_id is neither cut nor a reference; rows that repeat a doc_id
are one document to each other (no repeats between them) and are cut alike;
an empty table gives no rows; other columns are kept as they are (columns
named like the results are replaced).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from siftweb.llm import vec
from siftweb.session import scratch_path

WINDOW, RUN = 50, 26
SPREAD = WINDOW - RUN + 1
_U = np.uint64


def _windows_min(h: np.ndarray) -> np.ndarray:
    """Start of the smallest of each SPREAD consecutive run hashes (the
    leftmost of equals), by doubling."""
    at = np.arange(len(h))
    width = 1

    def better(a, b):
        return np.where(h[b] < h[a], b, a)

    while width * 2 <= SPREAD:
        at = better(at[: len(at) - width], at[width:])
        width *= 2
    rest = SPREAD - width
    return better(at[: len(at) - rest], at[rest:]) if rest else at


class Document:
    """Word, run and window hashes of one text; points: positions of its
    reference points; pick: each window's point."""

    def __init__(self, h: np.ndarray):
        self.h, self.n = h, len(h)
        if self.n >= WINDOW:
            s = vec.FIRST.prefix(h)
            at = np.arange(self.n - RUN + 1)
            self.runs = vec.FIRST.spans(s, at, at + RUN)
            self.pick = _windows_min(self.runs)
            self.points = np.unique(np.concatenate([self.pick, [0, self.n - RUN]]))
        else:
            self.pick = self.points = np.zeros(0, np.int64)

    def windows(self, start: np.ndarray) -> np.ndarray:
        return vec.SECOND.spans(vec.SECOND.prefix(self.h), start, start + WINDOW)


def factors(points: np.ndarray, ref: np.ndarray, ref_at: np.ndarray, doc_id: int) -> np.ndarray:
    """Greedy factors (start, end), rows; points ascend, ref are their first
    documents and ref_at their positions there (row mark included)."""
    known = ref != doc_id
    shift = ref_at - points
    go = known[1:] & known[:-1] & (ref[1:] == ref[:-1]) & (shift[1:] == shift[:-1]) & (np.diff(points) <= SPREAD)
    first = np.flatnonzero(known & ~np.concatenate([[False], go]))
    last = np.flatnonzero(known & ~np.concatenate([go, [False]]))
    spans = np.stack([points[first], points[last] + RUN], 1)
    return spans[spans[:, 1] - spans[:, 0] >= WINDOW]


def covered(n: int, spans: np.ndarray) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    if len(spans):
        np.add.at(edge, spans[:, 0], 1)
        np.add.at(edge, spans[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


def _mark(raw: bytes) -> int:
    """Tells rows of one doc_id apart; the high half of a position."""
    return (zlib.crc32(raw) & 0x7FFFFFFF) << 32


def _documents(rows: pa.RecordBatch, data: np.ndarray, off: np.ndarray) -> Iterator[tuple]:
    """(row number, mark, Document, word starts, word ends)"""
    start, end, woff = vec.words(data, off)
    h = vec.word_hashes(data, start, end)
    raw = data.tobytes()
    for i, (a, b) in enumerate(zip(woff[:-1].tolist(), woff[1:].tolist())):
        yield i, _mark(raw[off[i]: off[i + 1]]), Document(h[a:b]), start[a:b] - off[i], end[a:b] - off[i]


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, off in vec.slices(batches):
        ids = rows.column("doc_id").to_numpy()
        h, doc, at = [np.zeros(0, _U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, mark, d, _, _ in _documents(rows, data, off):
            if d.n >= WINDOW:
                h.append(d.runs[d.points])
                doc.append(np.full(len(d.points), ids[i]))
                at.append(d.points + mark)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h).view(np.int64)), pa.array(np.concatenate(doc)),
                                          pa.array(np.concatenate(at))], names=["h", "doc_id", "at"])


def cut(raw: bytes, spans: np.ndarray) -> tuple[int, int, str, str]:
    """(words, removed words, digest of the kept words, text without the
    spans).  A text without spans comes back unchanged; otherwise white space
    before a removed word goes with it."""
    data, off = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    start, end, _ = vec.words(data, off)
    gone = covered(len(start), spans)
    kept = hashlib.sha256()
    if not gone.any():
        kept.update(b" ".join(raw.split()))
        return len(start), 0, kept.hexdigest(), raw.decode()
    keep = np.flatnonzero(~gone)
    kept.update(_joined(raw, start[keep], end[keep]))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], ~gone, [True]]).astype(np.int8)))
    out, at = [], 0
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):  # runs of removed words
        out.append(raw[at: end[a - 1] if a else 0])
        at = int(end[b - 1])
    out.append(raw[at:])
    return len(start), int(gone.sum()), kept.hexdigest(), b"".join(out).decode()


def _joined(raw: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    return b" ".join([raw[a:b] for a, b in zip(start.tolist(), end.tolist())])


def _add(rows: pa.RecordBatch, text: list, **columns: pa.Array) -> pa.RecordBatch:
    kept = [n for n in rows.schema.names if n not in ("_hits", "_more")]
    arrays = [pa.array(text, pa.string()) if n == "text" else rows.column(n) for n in kept]
    return pa.RecordBatch.from_arrays([*arrays, *columns.values()], names=[*kept, *columns])


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, off in vec.slices(batches):
        raw = data.tobytes()
        mark = [_mark(raw[a:b]) >> 32 for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
        yield rows.append_column("_mark", pa.array(mark, pa.int64()))


RESULT = "n_words long, n_removed long, kept_sha256 string"
MIDDLE = "_mark long, _spans array<int>, _ask array<struct<pos:int,h:long>>, _own array<long>, _open boolean, " + RESULT


def _parse(column: str, keep_text: bool):
    """Factors and boundary windows of documents with shared points; all other
    documents, and those without a boundary window, are finished at once."""
    pair = pa.struct([("pos", pa.int32()), ("h", pa.int64())])

    def hits_of(t, d: Document, doc_id: int):
        at = t.field("at").to_numpy() & 0xFFFFFFFF
        some, first = np.unique(at, return_index=True)
        ref, ref_at = t.field("ref").to_numpy()[first], t.field("ref_at").to_numpy()[first]
        found = factors(some, ref, ref_at, doc_id)
        slot = np.minimum(np.searchsorted(some, d.pick), len(some) - 1)
        shared, mine = some[slot] == d.pick, ref[slot] == doc_id
        inside = np.zeros(len(d.pick), bool)
        for a, b in found.tolist():
            inside[a: b - WINDOW + 1] = True
        return found, np.flatnonzero(shared & ~mine & ~inside), np.flatnonzero(shared & mine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros((0, 2), np.int64)
        for rows, data, off in vec.slices(batches):
            raw, hits, ids = data.tobytes(), rows.column("_hits"), rows.column(column)
            null = rows.column("text").is_valid().to_numpy(zero_copy_only=False)
            texts, spans, ask, own, done = [], [], [], [], []
            with_hits = hits.is_valid().to_numpy(zero_copy_only=False)
            made = _documents(rows, data, off) if with_hits.any() else ((i, 0, None) for i in range(rows.num_rows))
            for i, _, d, *_ in made:
                text = raw[off[i]: off[i + 1]]
                found, open_, mine = none, (), ()
                if with_hits[i]:
                    found, open_, mine = hits_of(hits[i].values, d, ids[i].as_py())
                spans.append(found.ravel().astype(np.int32))
                own.append(np.unique(d.windows(mine).view(np.int64)) if len(mine) else [])
                ask.append([{"pos": p, "h": x} for p, x in zip(open_.tolist(), d.windows(open_).view(np.int64).tolist())]
                           if len(open_) else [])
                if len(open_):
                    texts.append(text.decode())
                    done.append((None, None, None))
                else:
                    *numbers, after = cut(text, found)
                    texts.append(after if keep_text and null[i] else None)
                    done.append(numbers)
            n, gone, sha = zip(*done)
            yield _add(rows, texts, _spans=pa.array(spans, pa.list_(pa.int32())), _ask=pa.array(ask, pa.list_(pair)),
                       _own=pa.array(own, pa.list_(pa.int64())), _open=pa.array([len(x) > 0 for x in ask]),
                       n_words=pa.array(n, pa.int64()), n_removed=pa.array(gone, pa.int64()),
                       kept_sha256=pa.array(sha, pa.string()))
    return run


def _finish(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, done = [], []
            for text, spans, more in zip(batch.column("text"), batch.column("_spans"), batch.column("_more")):
                spans = spans.values.to_numpy().reshape(-1, 2).astype(np.int64)
                if more.is_valid:
                    start = more.values.to_numpy().astype(np.int64)
                    spans = np.concatenate([spans, np.stack([start, start + WINDOW], 1)])
                *numbers, after = cut(text.as_py().encode(), spans)
                texts.append(after if keep_text else None)
                done.append(numbers)
            if texts:
                n, gone, sha = zip(*done)
                yield _add(batch.drop_columns(["_spans"]), texts, n_words=pa.array(n, pa.int64()),
                           n_removed=pa.array(gone, pa.int64()), kept_sha256=pa.array(sha, pa.string()))
    return run


def remove_repeats(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """All columns of ``docs``, with the repeats cut out of ``text`` (or text
    null, if not ``keep_text``), and n_words, n_removed and kept_sha256 (which
    replace columns of these names)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "lempelziv")
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_sha256")]
    # Other columns travel by number, so that none clashes with a name used here.
    held = {c: c if c in ("doc_id", "text") else f"o{i}" for i, c in enumerate(names)}
    columns = list(held.values())
    docs = docs.select(*[F.col(f"`{c}`").cast("long").alias(h) if c == "doc_id" else F.col(f"`{c}`").alias(h)
                         for c, h in held.items()])

    def shape(more: str) -> StructType:
        """The columns and more; no text form of their types, for a nested name may need quotes."""
        return StructType([*(StructField(f.name, f.dataType) for f in docs.schema), *StructType.fromDDL(more)])

    points = docs.select("doc_id", "text").filter("doc_id is not null and text is not null") \
        .mapInArrow(_points, "h long, doc_id long, at long")
    points.groupBy("h").agg(F.min(F.struct("doc_id", "at")).alias("r"), F.max("doc_id").alias("last")) \
        .filter("r.doc_id < last").select("h", F.col("r.doc_id").alias("ref"), F.col("r.at").alias("ref_at")) \
        .write.parquet(f"{path}/blocks")
    blocks = spark.read.parquet(f"{path}/blocks")
    hits = points.join(blocks, "h").groupBy("doc_id", F.shiftright("at", 32).alias("_mark")).agg(
        F.collect_list(F.struct("at", "ref", "ref_at")).alias("_hits"))
    marked = docs.mapInArrow(_marks, shape("_mark long"))
    marked.join(hits, ["doc_id", "_mark"], "left").select(*columns, "_mark", "_hits") \
        .mapInArrow(_parse("doc_id", keep_text), shape(MIDDLE)).write.parquet(f"{path}/middle")
    middle = spark.read.parquet(f"{path}/middle")

    ask = middle.select("doc_id", "_mark", F.explode("_ask").alias("a")).select("doc_id", "_mark", "a.pos", "a.h")
    own = middle.select(F.explode("_own").alias("h"), "doc_id").join(ask.select("h").distinct(), "h", "left_semi")
    ask.select("h", "doc_id").unionByName(own).groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")) \
        .filter("first < last").select("h", "first").write.parquet(f"{path}/windows")
    repeats = ask.join(spark.read.parquet(f"{path}/windows"), "h").filter("first < doc_id") \
        .groupBy("doc_id", "_mark").agg(F.collect_set("pos").alias("_more"))
    open_ = middle.filter("_open").select(*columns, "_mark", "_spans").join(repeats, ["doc_id", "_mark"], "left") \
        .select(*columns, "_spans", "_more").mapInArrow(_finish(keep_text), shape(RESULT))
    done = middle.filter("not _open").select(*columns, "n_words", "n_removed", "kept_sha256").unionByName(open_)
    return done.select(*[F.col(h).alias(c) for c, h in held.items()], "n_words", "n_removed", "kept_sha256")
