"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text's paragraphs are its lines, cut further after words whose hash is
divisible by ``STEP``, a power of two, and after ``LONGEST * STEP`` words at
the latest.  The rule is the same at every length, so an edit changes only
the few words' paragraphs that it touches, and texts of any lengths compare.
The distinct digests go into a table of cells: every digest adds one to the
count and is xored, with a check value, into one cell of each of three parts
of the table.

Two tables of equal shape subtract cell by cell; digests that both hold
cancel.  Peeling then takes digests from cells that hold a single one until
the table is empty, which recovers the digests that differ.  If cells remain,
both texts are sketched anew with four times the cells, until it succeeds, so
the cells grow with the difference, not with the texts.  The likeness of two
texts is the share of common digests among all of theirs (two texts without
words: 1).

A fingerprint is the string ``step:digests:cells`` with the ``CELLS`` cells
in base64 (counts and check values of 32 bits, digests of 64).  Two of them
give back small differences only (``difference``); ``changes`` has both texts
and gives back any.

``versions`` puts each document beside its edited text and the next document
by descending doc_id.  The documents are dealt to ranges of doc_id, whose
bounds come from approximate quantiles; the first document of each range also
goes to the range before it (the first of all to the last range), so one
shuffle of the texts suffices and no range needs another.

Defined cases: null text is empty (no digests); null doc_ids come after all
others; rows of one doc_id are ordered by the text's hash; a single document
is its own next one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftweb.llm import vec

CELLS, GROW, STEP, LONGEST, SPLIT = 24, 4, 4, 4, 4
_U = np.uint64
_SEEDS = [_U(0x51ED270B35D5A1F3), _U(0x8CB92BA72F3D8DD7), _U(0xC2B2AE3D27D4EB4F)]


def steps(n_chars: np.ndarray) -> np.ndarray:
    """The step of each text: ``STEP``, whatever its length."""
    return np.full(np.shape(n_chars), STEP, np.int64)


class Words:
    """Word hashes of some texts, and where their lines end."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"".join(texts), np.uint8)
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        start, end, self.off = vec.words(data, off)
        self.h = vec.word_hashes(data, start, end)
        self.sum = vec.FIRST.prefix(self.h)
        lines = np.concatenate([[0], np.cumsum(data == 0x0A)])
        self.line = np.ones(len(start), bool)
        if len(start):
            self.line[:-1] = lines[start[1:]] > lines[end[:-1]]
            self.line[self.off[1:][np.diff(self.off) > 0] - 1] = True
        self.size = np.diff(self.off)

    def digests(self, which: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(owner, digest): the distinct paragraphs of texts ``which``, each at its step."""
        n = self.size[which]
        base = np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(self.off[which], n) + np.arange(n.sum()) - base
        owner = np.repeat(np.arange(len(which)), n)
        wide = np.repeat(step, n)
        ends = self.line[at] | ((self.h[at] & (wide - 1).astype(_U)) == 0)
        here = np.arange(len(at))  # a long run without an end is cut every LONGEST * step words
        since = here - np.maximum.accumulate(np.where(np.concatenate([[True], ends[:-1]]), here, 0)) if len(at) else here
        last = np.flatnonzero(ends | (since % (LONGEST * wide) == LONGEST * wide - 1))
        if not len(last):
            return np.zeros(0, np.int64), np.zeros(0, _U)
        begin = np.concatenate([[0], last[:-1] + 1])
        d = vec.FIRST.spans(self.sum, at[begin], at[last] + 1)
        who = owner[last]
        order = np.lexsort((d, who))
        d, who = d[order], who[order]
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (who[1:] != who[:-1])
        return who[new], d[new]


def _check(d: np.ndarray) -> np.ndarray:
    return (vec.mix(d ^ _U(0x5851F42D4C957F2D)) >> _U(32)).astype(np.uint32)


def _places(d: np.ndarray, cells: int) -> list[np.ndarray]:
    third = cells // 3
    return [(vec.mix(d ^ s) % _U(third)).astype(np.int64) + j * third for j, s in enumerate(_SEEDS)]


class Tables:
    """Cells of many sketches of one size."""

    def __init__(self, n: int, cells: int):
        self.n, self.cells = n, cells
        self.count = np.zeros(n * cells, np.int32)
        self.key = np.zeros(n * cells, _U)
        self.check = np.zeros(n * cells, np.uint32)

    def add(self, owner: np.ndarray, d: np.ndarray, sign: np.ndarray | int = 1) -> np.ndarray:
        c = _check(d)
        at = np.concatenate([owner * self.cells + p for p in _places(d, self.cells)])
        np.add.at(self.count, at, np.tile(np.broadcast_to(sign, d.shape), 3))
        np.bitwise_xor.at(self.key, at, np.tile(d, 3))
        np.bitwise_xor.at(self.check, at, np.tile(c, 3))
        return at

    def minus(self, other: Tables) -> Tables:
        out = Tables(self.n, self.cells)
        out.count, out.key, out.check = self.count - other.count, self.key ^ other.key, self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(done per sketch; owner, digest, sign of the recovered digests).  Empties the tables."""
        owners, found, signs = [np.zeros(0, np.int64)], [np.zeros(0, _U)], [np.zeros(0, np.int64)]
        look = np.flatnonzero(np.abs(self.count) == 1)
        while len(look):
            look = look[np.abs(self.count[look]) == 1]
            look = look[self.check[look] == _check(self.key[look])]
            if not len(look):
                break
            owner, d, sign = look // self.cells, self.key[look], self.count[look].astype(np.int64)
            order = np.lexsort((d, owner))
            owner, d, sign = owner[order], d[order], sign[order]
            new = np.ones(len(d), bool)
            new[1:] = (d[1:] != d[:-1]) | (owner[1:] != owner[:-1])
            owner, d, sign = owner[new], d[new], sign[new]
            look = np.unique(self.add(owner, d, -sign))
            owners.append(owner)
            found.append(d)
            signs.append(sign)
        rest = (self.count != 0) | (self.key != 0) | (self.check != 0)
        return ~rest.reshape(self.n, self.cells).any(1), np.concatenate(owners), np.concatenate(found), np.concatenate(signs)

    def strings(self, step: np.ndarray, size: np.ndarray) -> list[str]:
        raw = np.concatenate([self.count.astype("<i4").reshape(self.n, -1).view(np.uint8),
                              self.key.astype("<u8").reshape(self.n, -1).view(np.uint8),
                              self.check.astype("<u4").reshape(self.n, -1).view(np.uint8)], 1)
        return [f"{s}:{m}:{base64.b64encode(r.tobytes()).decode()}" for s, m, r in zip(step.tolist(), size.tolist(), raw)]

    @classmethod
    def parse(cls, fingerprint: str) -> tuple[int, int, Tables]:
        step, size, cells = fingerprint.split(":")
        raw = base64.b64decode(cells)
        t = cls(1, len(raw) // 16)
        t.count = np.frombuffer(raw, "<i4", t.cells).astype(np.int32)
        t.key = np.frombuffer(raw, "<u8", t.cells, 4 * t.cells).astype(_U)
        t.check = np.frombuffer(raw, "<u4", t.cells, 12 * t.cells).astype(np.uint32)
        return int(step), int(size), t


def difference(a: str, b: str) -> tuple[list[int], list[int]] | None:
    """Digests only in a, and only in b, from two fingerprints; None if their
    steps or cell counts differ or the cells do not suffice (see ``changes``)."""
    (s, _, t), (r, _, u) = Tables.parse(a), Tables.parse(b)
    if s != r or t.cells != u.cells:
        return None
    done, _, d, sign = t.minus(u).peel()
    return (d[sign > 0].tolist(), d[sign < 0].tolist()) if done[0] else None


def _sketch(words: Words, which: np.ndarray, step: np.ndarray, cells: int) -> tuple[Tables, np.ndarray]:
    owner, d = words.digests(which, step)
    t = Tables(len(which), cells)
    t.add(owner, d)
    return t, np.bincount(owner, minlength=len(which))


class Digests:
    """Distinct digests of some texts, for sketches of any size."""

    def __init__(self, words: Words):
        n = len(words.size)
        owner, self.d = words.digests(np.arange(n), steps(np.zeros(n)))
        self.size = np.bincount(owner, minlength=n)
        self.off = np.concatenate([[0], np.cumsum(self.size)])

    def tables(self, which: np.ndarray, cells: int) -> Tables:
        n = self.size[which]
        at = np.repeat(self.off[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        t = Tables(len(which), cells)
        t.add(np.repeat(np.arange(len(which)), n), self.d[at])
        return t


def recover(texts: Digests, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(pairs, place among them, digest, sign) that subtracting and peeling gives
    for the texts a[i] and b[i], sign 1 for a's; pairs that fail try again with
    GROW times the cells, so each pair comes once."""
    left, cells = np.arange(len(a)), CELLS
    # The sizes alone tell that so many digests differ: no table holds more than its cells.
    least = np.abs(texts.size[a] - texts.size[b])
    while len(left):
        now = left[least[left] <= cells]
        done, owner, d, sign = texts.tables(a[now], cells).minus(texts.tables(b[now], cells)).peel()
        keep = done[owner]
        yield now[done], (np.cumsum(done) - 1)[owner[keep]], d[keep], sign[keep]
        left = np.setdiff1d(left, now[done], assume_unique=True)
        cells *= GROW


def likeness(texts: Digests, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shares of common digests of the texts a[i] and b[i]."""
    out = np.zeros(len(a))
    for pairs, at, _, sign in recover(texts, a, b):
        common = texts.size[a[pairs]] - np.bincount(at[sign > 0], minlength=len(pairs))
        union = texts.size[a[pairs]] + texts.size[b[pairs]] - common
        out[pairs] = np.where(union > 0, common / np.maximum(union, 1), 1.0)
    return out


def fingerprints(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """(doc_id, fingerprint) of every row, in one narrow pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in vec.slices(batches):
            raw = data.tobytes()
            texts = [raw[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            step = steps(np.zeros(len(texts)))
            t, size = _sketch(Words(texts), np.arange(len(texts)), step, cells)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(t.strings(step, size))],
                                             names=["doc_id", "fingerprint"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint string")


CHANGES = "doc_id long, n_common long, only_text array<long>, only_other array<long>"


def _pairs(batches: Iterator[pa.RecordBatch], limit: int = 1 << 20) -> Iterator[tuple[list, list[bytes], list[bytes]]]:
    """(doc_ids, texts, other texts) of about ``limit`` bytes at a time."""
    for batch in batches:
        ids, texts, others, held = [], [], [], 0
        for i in range(batch.num_rows):
            text, other = ((batch.column(c)[i].as_py() or "").encode() for c in ("text", "other"))
            if ids and held + len(text) + len(other) > limit:
                yield ids, texts, others
                ids, texts, others, held = [], [], [], 0
            ids.append(batch.column("doc_id")[i].as_py())
            texts.append(text)
            others.append(other)
            held += len(text) + len(other)
        if ids:
            yield ids, texts, others


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def lists(at: np.ndarray, d: np.ndarray, n: int) -> pa.Array:
        order = np.lexsort((d, at))
        off = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=n))])
        return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(d[order].view(np.int64)))

    for ids, texts, others in _pairs(batches):
        m = len(ids)
        every = Digests(Words(texts + others))
        found = [(pairs[at], d, sign) for pairs, at, d, sign in recover(every, np.arange(m), np.arange(m) + m)]
        at, d, sign = (np.concatenate(c) for c in zip(*found))
        n_common = every.size[:m] - np.bincount(at[sign > 0], minlength=m)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n_common, pa.int64()),
             lists(at[sign > 0], d[sign > 0], m), lists(at[sign < 0], d[sign < 0], m)],
            names=["doc_id", "n_common", "only_text", "only_other"])


def changes(pairs: DataFrame) -> DataFrame:
    """The paragraph digests that two versions differ in, for every row
    (doc_id, text, other), in one narrow pass: how many digests both hold, and
    those only in ``text`` and only in ``other`` (64 bits as signed numbers,
    ascending as unsigned ones), whatever their number: pairs whose cells do
    not peel try again with GROW times the cells."""
    return pairs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "other").mapInArrow(_changes, CHANGES)


def _runs(batches: Iterator[pa.RecordBatch], limit: int = 1 << 20) -> Iterator[tuple[list, list[str]]]:
    """(doc_ids, their texts and the one after the last): consecutive rows of
    one range, about ``limit`` characters at a time."""
    ids, texts, held, last = [], [], 0, None
    for batch in batches:
        for i in range(batch.num_rows):
            place = batch.column("range")[i].as_py()
            text = batch.column("text")[i].as_py() or ""
            if place != last:  # the row before was the range's tail, which only follows
                ids, texts, held, last = [], [], 0, place
            texts.append(text)
            held += len(text)
            if batch.column("tail")[i].as_py():
                if ids:
                    yield ids, texts
                ids, texts, held = [], [], 0
                continue
            if held > limit and ids:
                yield ids, texts
                ids, texts, held = [], texts[-1:], len(text)
            ids.append(batch.column("doc_id")[i].as_py())


VERSIONS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double")


def _versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in _runs(batches):
        m = len(ids)
        n = np.array([len(t) for t in texts[:m]])
        edited = [t[: len(t) - len(t) // 3] + nxt[: len(t) // 3] for t, nxt in zip(texts[:m], texts[1:])]
        raw = [t.encode() for t in edited]
        every = Digests(Words([t.encode() for t in texts] + raw))
        own, late = np.arange(m), np.arange(m) + len(texts)
        fp, fe = (every.tables(which, CELLS).strings(steps(which), every.size[which]) for which in (own, late))
        near = likeness(every, np.concatenate([own, own]), np.concatenate([late, own + 1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array([hashlib.sha256(r).hexdigest() for r in raw]),
             pa.array(fp), pa.array(fe), pa.array(near[:m]), pa.array(near[m:])],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def versions(docs: DataFrame) -> DataFrame:
    """One row per document (see VERSIONS): itself, its edited text, the next one."""
    spark = docs.sparkSession
    lowest = -(2 ** 63)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .withColumn("key", F.coalesce("doc_id", F.lit(lowest)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A few numbers per range on the driver, whatever the table's size.
    cuts = rows.approxQuantile("key", [i / (SPLIT * parts) for i in range(1, SPLIT * parts)], 0.1 / (SPLIT * parts))
    bounds = -np.unique(np.array(cuts, np.float64))[::-1]

    def range_of(key: np.ndarray) -> np.ndarray:
        return np.searchsorted(bounds, -key.astype(np.float64), side="left")

    @F.pandas_udf("long")
    def place(key: pd.Series) -> pd.Series:
        return pd.Series(range_of(key.to_numpy()))

    first = {r["range"]: r["first"] for r in
             rows.select("key").withColumn("range", place("key")).groupBy("range").agg(F.max("key").alias("first")).collect()}
    order = sorted(first)
    before = {first[b]: a for a, b in zip(order, order[1:])} | ({first[order[0]]: order[-1]} if order else {})
    # The first keys of the ranges, and the range that each one follows.
    tops, follows = np.array(sorted(before), np.int64), np.array([before[k] for k in sorted(before)], np.int64)

    @F.pandas_udf("array<long>")
    def copies(key: pd.Series) -> pd.Series:
        k = key.to_numpy()
        own = range_of(k) * 2
        at = np.minimum(np.searchsorted(tops, k), max(len(tops) - 1, 0))
        top = tops[at] == k if len(tops) else np.zeros(len(k), bool)
        return pd.Series([[a, int(follows[i]) * 2 + 1] if t else [a] for a, i, t in zip(own.tolist(), at.tolist(), top.tolist())])

    dealt = rows.withColumn("code", F.explode(copies("key"))).withColumn("range", F.shiftright("code", 1)) \
        .withColumn("tail", F.col("code") % 2 == 1).drop("code")
    placed = dealt.repartition(parts, "range").sortWithinPartitions("range", "tail", F.desc("key"), F.xxhash64("text"))
    return placed.select("doc_id", "text", "range", "tail").mapInArrow(_versions, VERSIONS)
