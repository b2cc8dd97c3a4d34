"""Near-duplicate documents by a chosen-path set similarity join.

A document's set holds its distinct shingles of ``SHINGLE`` words (A-Z
lower-cased); documents with equal sets are one from the start.  Each set has
``COORDS`` minwise tokens (the smallest hash under one of as many functions).

``TREES`` independent trees branch the sets.  A node is a list of (coordinate,
minwise token) choices and holds the sets that agree on them.  The root of a
tree branches on a coordinate of its own.  A node below picks, by its hash, one
coordinate of its level, and in one case of three a second one: 4/3 on average,
the inverse of the similarity, so that a pair at 0.75 goes on in one child on
average and less similar pairs die out: documents that share a passage at 0.58
leave 0.77 pairs a level.  The levels' coordinates are ``FAN`` of the ``SHARED``
each, dealt to every tree in an order of its own, none twice on a path.

A pair at exactly 0.75 meets in the first level with all but a chance of 0.25 **
TREES = 2e-10.  Nodes of one component or few members end there; where they do not,
a pair goes on by a critical branching and is lost with a chance of 2e-5 in two more
levels, 2e-3 in five, 3 % in ten (of pairs at 0.8: 1e-6, 2e-4, 3e-3; at 0.9: 1e-6 in
ten).  Pairs that other links join lose nothing.

Each level of all trees is one round of Spark jobs:

1. Star: the members of a node are compared with its smallest member, and
   links (exact, on the full sets) are merged into components.  So a group of
   thousands of near copies costs a number of comparisons in proportion to
   its size; nodes of a single component are done.  Pairs that an earlier level
   has compared so are left out.
2. Small nodes are compared exhaustively: a node is small if it has at most
   ``LEAF`` members, or at most ``LEAF`` outside its largest component.
   These meet all members, in chunks of ``CHUNK``; pairs of one component
   are skipped, for they can add nothing.
3. Nodes that are not small branch into the next level.  Beyond the last level
   (``SHARED // FAN`` equal tokens) they are compared exhaustively, chunk by chunk.

A comparison looks at the set sizes and at two bits of each of ``BRIEF`` minwise
tokens first, which are all that travels with the members of a node: at least
``ALIKE`` must be equal.  Of what is left, at least ``AGREE`` of ``COORDS`` low bytes
must be equal (at similarity 0.75 a pair misses either with a chance of less than
1e-8).  Then the full sets decide, in integers.  Nodes of two are done with the star.
Work goes to groups of at most ``CHUNK + LEAF`` sets, however large a node is.

Defined cases: texts without words (null, empty, white space) have n_shingles
0 and are linked with nothing; texts of fewer words have one shingle; a null
doc_id is linked with nothing (component_id null, kept); repeated rows are one
document; rows of one doc_id with different texts are one document with several
sets, each of which links it; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftweb.llm import vec
from siftweb.llm.bloom import Bloom
from siftweb.session import scratch_path

SHINGLE, PART, WHOLE = 5, 75, 100
#: SHARED is prime: a tree's order of the coordinates is a multiple of their numbers.
TREES, SHARED, FAN = 16, 179, 4
COORDS = TREES + SHARED
LEAF, CHUNK, AGREE, FEW = 1024, 2000, 110, 100_000
BRIEF, ALIKE = 192, 123
#: Bits of an element that are compared before whole elements.
CODE = 18
#: A table has at most a file for so many documents, or FILES for each core.
ROWS, FILES = 5000, 8
SETS = "doc_id long, n_shingles long, s1 long, s2 long, sig array<int>, low binary, brief binary"

_U = np.uint64
_PAIRS = _U(0x5555555555555555)
_XOR, _ODD = vec.mix(np.arange(1, COORDS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)), \
    vec.mix(np.arange(1001, COORDS + 1001, dtype=_U) * _U(0xD1342543DE82EF95)) | _U(1)


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes, offsets) of each document of a slice."""
    low = vec.lower(data)
    start, end, woff = vec.words(low, off)
    h = vec.word_hashes(low, start, end)
    runs, _, roff = vec.runs(h, woff, k)
    n = np.diff(woff)
    short = np.flatnonzero((n > 0) & (n < k))
    whole = dict(zip(short.tolist(), vec.FIRST.spans(vec.FIRST.prefix(h), woff[short], woff[short + 1])))
    sets = [np.unique(runs[a:b]) if b > a else np.array([whole[i]], _U) if i in whole else runs[:0]
            for i, (a, b) in enumerate(zip(roff[:-1].tolist(), roff[1:].tolist()))]
    return (np.concatenate(sets) if sets else runs[:0]), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, off in vec.slices(batches):
        h, soff = shingle_sets(data, off)
        n = np.diff(soff)
        full = np.flatnonzero(n)
        sig = np.zeros((len(n), COORDS), np.uint32)
        s1, s2 = np.zeros(len(n), _U), np.zeros(len(n), _U)
        if len(full):
            at = soff[full]
            for c in range(COORDS):
                sig[full, c] = np.minimum.reduceat(((h ^ _XOR[c]) * _ODD[c]) >> _U(32), at)
            s1[full], s2[full] = _identity(h, at)
        flat = pa.array(sig.view(np.int32).ravel())
        step = pa.array(np.arange(len(n) + 1, dtype=np.int32) * COORDS)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
             pa.ListArray.from_arrays(step, flat),
             pa.array([r.tobytes() for r in (sig & 0xFF).astype(np.uint8)], pa.binary()),
             pa.array([r.tobytes() for r in _brief(sig)], pa.binary())],
            names=["doc_id", "n_shingles", "s1", "s2", "sig", "low", "brief"])


def _brief(sig: np.ndarray) -> np.ndarray:
    """Two bits of each token, four tokens a byte."""
    two = ((sig[:, :BRIEF] >> 8) & 3).astype(np.uint8).reshape(len(sig), -1, 4)
    return two[..., 0] | two[..., 1] << 2 | two[..., 2] << 4 | two[..., 3] << 6


def _identity(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each of the sets that start at ``at``."""
    return np.add.reduceat(vec.mix(h + _U(1)), at), np.add.reduceat(vec.mix(h ^ _U(0xABCDEF987654321)), at)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, off in vec.slices(batches):
        h, soff = shingle_sets(data, off)
        full = np.flatnonzero(np.diff(soff))
        if len(full):
            s1, s2 = _identity(h, soff[full])
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").take(pa.array(full)), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                 pa.array([h[soff[i]:soff[i + 1]].tobytes() for i in full.tolist()], pa.binary())],
                names=["doc", "s1", "s2", "elements"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Consecutive rows of equal (g, part); input sorted by them."""
    vec.give_back()
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        g, p = batch.column("g").to_numpy(), batch.column("part").to_numpy()
        cut = np.concatenate([[0], np.flatnonzero((g[1:] != g[:-1]) | (p[1:] != p[:-1])) + 1, [len(g)]])
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            if last != (g[a], p[a]) and held:
                yield pa.Table.from_batches(held)
                held = []
            last = (g[a], p[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


class _Group:
    """The sets of one group."""

    def __init__(self, t: pa.Table):
        self.rid, self.comp, self.size = (t.column(c).to_numpy() for c in ("rid", "comp", "size"))
        self.focus = t.column("focus").to_numpy(zero_copy_only=False)

        def rows(name: str, kind):
            return np.frombuffer(b"".join(t.column(name).to_pylist()), kind).reshape(t.num_rows, -1)
        self.brief = rows("brief", "<u8")
        self.low = rows("low", np.uint8) if "low" in t.column_names else None

    def near(self, i: int) -> np.ndarray:
        """Sets of other components that may be similar to the i-th, by sizes, equal
        bits and, where they are there, low bytes."""
        n = self.size
        at = np.flatnonzero((WHOLE * n >= PART * n[i]) & (WHOLE * n[i] >= PART * n) & (self.comp != self.comp[i]))
        x = self.brief[at] ^ self.brief[i]
        at = at[np.bitwise_count((x | x >> _U(1)) & _PAIRS).sum(1, dtype=np.int64) <= BRIEF - ALIKE]
        if self.low is not None:
            at = at[(self.low[at] == self.low[i]).sum(1) >= AGREE]
        return at


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a promising partner in another component.  Groups that come
    down to the same rows get the same name, so the nodes where the same
    documents meet count once."""
    held, n = [], 0
    for t in _groups(batches):
        x = _Group(t)
        rid, focus = x.rid, x.focus
        keep = np.zeros(len(rid), bool)
        for i in np.flatnonzero(focus):
            hit = x.near(i)
            if len(hit):
                keep[hit] = keep[i] = True
        if keep.any():
            name = vec.mix(vec.mix(rid[keep].view(_U) ^ (focus[keep].astype(_U) << _U(63))).sum(keepdims=True)).view(np.int64)
            t = t.set_column(t.schema.get_field_index("g"), "g", pa.array(np.repeat(name, len(rid))))
            t = t.set_column(t.schema.get_field_index("part"), "part", pa.array(np.zeros(len(rid), np.int32)))
            held.append(t.filter(pa.array(keep)).combine_chunks())
            n += int(keep.sum())
        if n > 5000:
            yield from pa.concat_tables(held).to_batches()
            held, n = [], 0
    if held:
        yield from pa.concat_tables(held).to_batches()


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """WHOLE * |a & b| >= PART * |a | b| for sorted distinct values."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or WHOLE * len(a) < PART * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    same = int((b[at] == a).sum())
    return WHOLE * same >= PART * (len(a) + len(b) - same)


def _promising(codes: list[np.ndarray], n: np.ndarray, i: int, at: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Those of the sets ``at`` (of ``n`` elements each) that may be linked to the i-th, all
    at once.  Elements of equal codes (their high bits) count as equal, so this is never less than what the sets share."""
    mark[codes[i]] = True
    same = np.add.reduceat(mark[np.concatenate([codes[j] for j in at.tolist()])], np.cumsum(n) - n, dtype=np.int64)
    mark[codes[i]] = False
    return at[WHOLE * same >= PART * (len(codes[i]) + n - same)]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between different components, as few as join the group's."""
    out: list[tuple[int, int]] = []

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    mark = np.zeros(1 << CODE, bool)
    for t in _groups(batches):
        x = _Group(t)
        rid, focus = x.rid, x.focus
        comp = x.comp = x.comp.copy()
        sets = [np.frombuffer(e, _U) for e in t.column("elements").to_pylist()]
        codes = [(s >> _U(64 - CODE)).astype(np.uint32) for s in sets]
        for i in np.flatnonzero(focus):
            at = x.near(i)
            if len(at):
                at = _promising(codes, x.size[at], i, at, mark)
            for j in at.tolist():
                if comp[j] != comp[i] and linked(sets[i], sets[j]):
                    out.append((int(rid[i]), int(rid[j])))
                    comp[comp == comp[j]] = comp[i]
        if len(out) > 5000:
            yield flush()
            out = []
    if out:
        yield flush()


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over a bounded number of edges (hi, lo)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("hi").to_pylist(), batch.column("lo").to_pylist()):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    if parent:
        ids = list(parent)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([root(x) for x in ids], pa.int64())],
                                         names=["id", "comp"])


class _Join:
    """Tables of one run, written under the shared scratch folder."""

    def __init__(self, docs: DataFrame):
        self.spark: SparkSession = docs.sparkSession
        self.root = scratch_path(self.spark, "chosenpath")
        self.docs, self.count, self.files = docs, 0, None

    def grown(self, rows: int) -> None:
        """From now on tables get files in proportion to the documents, however many
        partitions a shuffle has."""
        self.files = max(rows // ROWS, FILES * self.spark.sparkContext.defaultParallelism)

    def few(self, df: DataFrame) -> DataFrame:
        return df.coalesce(self.files) if self.files else df

    def together(self, df: DataFrame) -> DataFrame:
        """Rows of equal (g, part) side by side, for ``_groups``."""
        return self.few(df.repartition("g", "part")).sortWithinPartitions("g", "part", "rid")

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{name}-{self.count}"
        self.few(df).write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def among(self, rows: DataFrame, key: str, ids: DataFrame, name: str, n: int) -> DataFrame:
        """The rows whose key is among n written ids, and maybe others, without a shuffle:
        at most ``FEW`` ids (1 MB) are broadcast, more become a Bloom filter."""
        if n <= FEW:
            return rows.join(F.broadcast(ids.select(F.col(name).alias(key))), key, "left_semi")
        bloom = Bloom(ids, name)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array(bloom.may_hold(b.column(key).to_numpy())))
        return rows.mapInArrow(run, rows.schema)

    def compare(self, groups: DataFrame, reps: DataFrame, comps: DataFrame | None) -> DataFrame | None:
        """Links (a, b) among the members of groups (g, part, rid, focus)."""
        groups = self.write(groups, "groups")
        size = F.col("n_shingles").alias("size")
        n = groups.count()
        # Few rows (less than 4 MB each) go to the tables instead of a shuffle.
        near = F.broadcast if n <= FEW // 8 else self.few
        rows = self.among(reps.select("rid", size, "brief"), "rid", groups, "rid", n).join(near(groups), "rid")
        if comps is None:
            rows = rows.withColumn("comp", F.col("rid"))
        else:
            if n <= FEW // 8:
                comps = F.broadcast(self.among(comps, "rid", groups, "rid", n))
            rows = rows.join(comps, "rid", "left").withColumn("comp", F.coalesce("comp", "rid"))
        rows = rows.select("g", "part", "rid", "comp", "focus", "size", "brief")
        kind = "g long, part int, rid long, comp long, focus boolean, size long, brief binary"
        some = self.write(self.together(self.few(rows)).mapInArrow(_estimate, kind).dropDuplicates(["g", "rid", "focus"]), "promising")
        n = some.count()
        if not n:
            return None
        asked = self.among(reps.select("rid", "doc", "s1", "s2", "low"), "rid", some, "rid", n)
        if n > FEW:
            asked = asked.join(some.select("rid").distinct(), "rid")
        asked = self.write(asked, "asked")
        sets = self.among(self.docs, "doc_id", asked, "doc", n).mapInArrow(_sets, "doc long, s1 long, s2 long, elements binary") \
            .dropDuplicates(["doc", "s1", "s2"])
        near = F.broadcast if n <= FEW // 8 else self.few
        sets = sets.join(near(asked), ["doc", "s1", "s2"]).select("rid", "low", "elements")
        full = self.few(self.few(sets).join(near(some), "rid")).select(*some.columns, "low", "elements")
        links = self.write(self.together(full).mapInArrow(_verify, "a long, b long"), "links")
        return None if links.isEmpty() else links

    def components(self, edges: DataFrame) -> DataFrame:
        """(id, comp): the smallest id reachable, by alternating large and
        small stars until the edges are stars around the smallest ids.  At
        most ``FEW`` edges (less than 48 MB in Python, with up to two ids
        each) are united in one task instead."""
        e = self.write(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                       .filter("hi <> lo").distinct(), "edges")
        seen = None
        if e.count() <= FEW:
            return e.coalesce(1).mapInArrow(_unite, "id long, comp long")
        while True:
            both = e.unionByName(e.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
            least = both.groupBy("hi").agg(F.min("lo").alias("m")).select("hi", F.least("hi", "m").alias("m"))
            large = both.join(least, "hi").filter("lo > hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")) \
                .filter("hi <> lo").distinct()
            large = self.write(large, "large")
            low = large.groupBy("hi").agg(F.min("lo").alias("m"))
            small = large.join(low, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")) \
                .unionByName(low.select("hi", F.col("m").alias("lo"))).distinct()
            e = self.write(small, "small")
            now = e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
            if now == seen:
                break
            seen = now
        return e.select(F.col("hi").alias("id"), F.col("lo").alias("comp")).unionByName(
            e.select(F.col("lo").alias("id"), F.col("lo").alias("comp")).distinct())

    def merge(self, comps: DataFrame | None, links: DataFrame | None) -> DataFrame | None:
        """Components (rid, comp) after new links; single documents have no row."""
        if links is None:
            return comps
        if comps is None:
            return self.write(self.components(links).select(F.col("id").alias("rid"), "comp"), "comps")
        for side in ("a", "b"):
            links = links.join(comps.select(F.col("rid").alias(side), F.col("comp").alias("_c")), side, "left") \
                .withColumn(side, F.coalesce("_c", side)).drop("_c")
        moved = self.write(self.components(links), "moved")
        old = comps.join(moved.select(F.col("id").alias("comp"), F.col("comp").alias("_to")), "comp", "left") \
            .select("rid", F.coalesce("_to", "comp").alias("comp"))
        new = moved.select(F.col("id").alias("rid"), "comp").join(comps.select("rid"), "rid", "left_anti")
        return self.write(old.unionByName(new), "comps")

    def members(self, rows: DataFrame) -> DataFrame:
        """(node, rid, center) of nodes with more than one member."""
        rows = rows.select("node", "rid").distinct() if rows.columns != ["node", "rid"] else rows
        size = self.write(rows.groupBy("node").agg(F.count("*").alias("m"), F.min("rid").alias("center"))
                          .filter("m > 1").drop("m"), "nodes")
        return self.write(rows.join(size, "node").select("node", "rid", "center"), "members")


def _chunk(rid, n):
    return F.pmod(F.xxhash64(rid), n).cast("int")


def _root(tree: int):
    """The node of a tree's root coordinate; its low bits name the tree."""
    return F.xxhash64(F.lit(tree), F.element_at("sig", tree + 1)).bitwiseAND(F.lit(-TREES)).bitwiseOR(F.lit(tree))


def _children(level: int):
    """The one or two nodes that a set goes on to from ``node`` at a level >= 0."""
    tree = F.col("node").bitwiseAND(F.lit(TREES - 1))
    first = F.pmod(F.xxhash64("node", F.lit("first")), F.lit(FAN))
    other = F.pmod(first + 1 + F.pmod(F.xxhash64("node", F.lit("other")), F.lit(FAN - 1)), F.lit(FAN))

    def child(turn):
        at = F.pmod((tree * 11 + 1) * (F.lit(FAN * level) + turn) + tree * 7, F.lit(SHARED)).cast("int")
        token = F.element_at("sig", at + F.lit(TREES + 1))
        return F.xxhash64("node", turn, token).bitwiseAND(F.lit(-TREES)).bitwiseOR(tree)

    two = F.pmod(F.xxhash64("node", F.lit("two")), F.lit(3)) == 0
    return F.when(two, F.array(child(first), child(other))).otherwise(F.array(child(first)))


def _all_pairs(rows: DataFrame, live: DataFrame) -> DataFrame:
    """Groups (g, part, rid, focus) in which all pairs of a node meet, of at most
    about 2 * CHUNK members each."""
    k = F.ceil((F.col("m") / CHUNK)).cast("int")
    each = rows.join(live.select("node", k.alias("_k")), "node").withColumn("_c", _chunk("rid", F.col("_k"))) \
        .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    part = F.least("_c", "_o") * F.col("_k") + F.greatest("_c", "_o")
    return each.select(F.col("node").alias("g"), part.alias("part"), "rid", (F.col("_c") <= F.col("_o")).alias("focus"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    run = _Join(plain.filter("doc_id is not null"))
    every = run.write(plain.mapInArrow(_sketch, SETS), "sketches")
    run.grown(every.count())
    sets = every.filter("n_shingles > 0 and doc_id is not null")
    # Numbered as they are written, once: a set's number is its own, whatever doc_ids repeat.
    reps = run.write(sets.groupBy("n_shingles", "s1", "s2").agg(
        F.min("doc_id").alias("doc"), F.first("sig").alias("sig"), F.first("low").alias("low"), F.first("brief").alias("brief"))
        .withColumn("rid", F.monotonically_increasing_id()), "reps")
    places = run.write(sets.select("doc_id", "n_shingles", "s1", "s2").join(
        reps.select("n_shingles", "s1", "s2", "rid"), ["n_shingles", "s1", "s2"]).select("doc_id", "n_shingles", "rid"), "places")
    # The sets of one doc_id belong together.
    several = places.groupBy("doc_id").agg(F.min("rid").alias("a"), F.max("rid").alias("b")).filter("a < b") \
        .join(places, "doc_id").select("a", F.col("rid").alias("b")).filter("a < b").distinct()
    several = run.write(several, "several")
    comps = run.merge(None, None if several.isEmpty() else several)

    level = run.members(reps.select(F.explode(F.array(*[_root(t) for t in range(TREES)])).alias("node"), "rid"))
    compared: DataFrame | None = None
    for depth in range(SHARED // FAN + 1):
        star = level.filter("rid <> center").select(F.col("center").alias("g"), "rid").distinct()
        if compared is not None:
            star = star.join(compared, ["g", "rid"], "left_anti")
        star = run.write(star, "pairs")
        compared = star if compared is None else compared.unionByName(star)
        chunks = run.few(star.groupBy("g").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("_k")))
        star = star.join(chunks, "g").select("g", "rid", _chunk("rid", F.col("_k")).alias("part"))
        hubs = chunks.select("g", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("part"))
        groups = star.select("g", "part", "rid", F.lit(False).alias("focus")).unionByName(
            hubs.select("g", "part", F.col("g").alias("rid"), F.lit(True).alias("focus")))
        comps = run.merge(comps, run.compare(groups, reps, comps))

        rows = level.select("node", "rid")
        if comps is None:
            rows = rows.withColumn("comp", F.col("rid"))
        else:
            rows = rows.join(comps, "rid", "left").select("node", "rid", F.coalesce("comp", "rid").alias("comp"))
        rows = run.write(rows, "placed")
        held = run.few(rows.groupBy("node", "comp").agg(F.count("*").alias("n"))).groupBy("node").agg(
            F.sum("n").alias("m"), F.max(F.struct("n", "comp")).alias("top"))
        # Nodes of two have been compared in their star.
        live = run.write(held.filter("m > top.n and m > 2").select(
            "node", "m", F.col("top.comp").alias("major"),
            ((F.col("m") <= LEAF) | (F.col("m") - F.col("top.n") <= LEAF)).alias("small"),
            F.when(F.col("m") <= LEAF, 1).otherwise(F.ceil(F.col("top.n") / CHUNK)).cast("int").alias("_k")), "live")
        flags = {r["small"] for r in live.select("small").distinct().collect()}
        if True in flags:
            inner = rows.join(live.filter("small").drop("m"), "node").withColumn("focus", F.col("comp") != F.col("major"))
            part = F.when(F.col("focus"), F.sequence(F.lit(0), F.col("_k") - 1)).otherwise(F.array(_chunk("rid", F.col("_k"))))
            groups = inner.select(F.col("node").alias("g"), F.explode(part).alias("part"), "rid", "focus")
            comps = run.merge(comps, run.compare(groups, reps, comps))
        if False not in flags:
            break
        wide = live.filter("not small")
        if depth == SHARED // FAN:
            comps = run.merge(comps, run.compare(_all_pairs(rows.select("node", "rid"), wide), reps, comps))
            break
        wide = run.write(rows.join(wide.select("node"), "node", "left_semi").select("node", "rid"), "wide")
        wide = wide.join(run.among(reps.select("rid", "sig"), "rid", wide, "rid", wide.count()), "rid")
        level = run.members(wide.select(F.explode(_children(depth)).alias("node"), "rid"))

    found = places
    if comps is not None:
        # A component is named by its smallest doc_id; single sets have no row in comps.
        named = comps.join(reps.select("rid", "doc"), "rid").groupBy("comp").agg(F.min("doc").alias("name"))
        found = found.join(comps.join(named, "comp").select("rid", "name"), "rid", "left")
    else:
        found = found.withColumn("name", F.lit(None).cast("long"))
    found = found.join(reps.select("rid", "doc"), "rid") \
        .select("doc_id", "n_shingles", F.coalesce("name", "doc").alias("component_id"))
    alone = every.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of each component (one of
    several equal doc_ids), columns as they were, whatever their names."""
    from pyspark.sql import Window

    spark = docs.sparkSession
    path = scratch_path(spark, "keepone")
    near_duplicates(docs.select("doc_id", "text")).write.parquet(path)
    found = spark.read.parquet(path).filter("doc_id is not null").groupBy("doc_id").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    odd = found.filter("not kept or n > 1")  # dropped, or several rows
    bloom = Bloom(odd, "doc_id")

    def side(inside: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids = b.column("doc_id").cast(pa.int64())
                hit = bloom.may_hold(ids.fill_null(0).to_numpy()) & ids.is_valid().to_numpy(zero_copy_only=False)
                yield b.filter(pa.array(hit == inside))
            vec.give_back()
        return run

    names, docs = docs.columns, vec.numbered(docs)
    # Only documents that may have to go are shuffled, each row as one column.
    doubt = docs.mapInArrow(side(True), docs.schema).select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("h"), F.struct("*").alias("row"))
    doubt = doubt.join(odd.filter("not kept").select(F.col("doc_id").alias("id")), "id", "left_anti")
    one = doubt.withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy("h"))).filter("place = 1")
    return docs.mapInArrow(side(False), docs.schema).unionByName(one.select("row.*")).toDF(*names)
