"""SentencePiece BPE by prefix tables, and decoding.

A chunk is a run of characters that no piece spans beyond (a word with its
leading marker).  For every prefix of a chunk exactly one piece can be the
last token of the prefix's encoding; the table of these pieces is filled from
left to right:

* pieces that end at the position are found by walking a suffix automaton of
  the vocabulary (a trie of the reversed pieces, kept as a sorted array of
  node and character);
* such a piece is the last token if it starts the chunk, or if the last token
  of the prefix before it is compatible with it: merging the two from scratch
  must give the two back.  The test undoes the merges of both pieces in the
  order of their priority and fails where a merge across the border would
  have come first.

The ids are then read backwards from the whole chunk's last token.  All
unknown chunks of a slice fill their tables together, one position at a time
(arrays over chunks).  The worker remembers pair tests (``2**PAIR_BITS``
slots) and space-separated parts of the texts, in two generations of about
``KEEP``: when the younger is full it becomes the older, and parts still in
use move up again.  A part is remembered with its ids as decimals and with the text
that they stand for, so a text's results are joins over its parts; parts with
byte pieces and texts with runs of spaces are decoded by the library.

The model has to be BPE with an identity normalizer, a leading marker, byte
fallback and no piece with a marker inside; ``Model`` checks that.  Runs of
markers have pieces of one common, lowest score, which merge from the left:
a small loop over the run's length does that.

Defined cases: null and empty texts have no ids and decode to ''; a null
doc_id is kept; repeated rows are rows of their own; an empty table gives no
rows; other columns are ignored.  Chunks of any length are handled (the table
has one entry per character).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftweb.llm import vec

KEEP, PAIR_BITS = 150_000, 21
#: Bytes of text that are cut and looked up at once.
SLICE = 4 << 20
MARK = "▁"
#: Stands for a byte piece; no piece of the vocabulary holds it.
BYTE = "\0"
NEVER = np.int64(1) << 40
SCHEMA = "doc_id long, n_tokens long, ids string, decoded string"
_LOADED: dict[str, Model] = {}


class Model:
    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm, train = proto.normalizer_spec, proto.trainer_spec
        pieces = [(i, p.piece, p.score) for i, p in enumerate(proto.pieces) if p.type == 1]
        if (train.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.add_dummy_prefix or not norm.escape_whitespaces or not train.byte_fallback
                or any(p.type == 4 for p in proto.pieces) or any(BYTE in p or MARK in p.lstrip(MARK) for _, p, _ in pieces)):
            raise ValueError("this model is not a plain byte-fallback BPE model")
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == 6}
        self.decimals = [str(i) for i in range(len(proto.pieces))]
        self.surface = [BYTE if p.type == 6 else p.piece for p in proto.pieces]
        self.runs = {len(p): i for i, p, _ in pieces if set(p) == {MARK}}
        #: Characters of some longer piece; all others end a chunk.
        words = [(i, p, s) for i, p, s in pieces if set(p) != {MARK} or len(p) == 1]
        self.single = {p: i for i, p, _ in words if len(p) == 1}
        inner = {c for _, p, _ in words if len(p) > 1 for c in p}
        scores = [s for _, p, s in words if len(p) > 1]
        if not inner <= set(self.single) or len(set(scores)) < len(scores):
            raise ValueError("merges need a piece for each character and scores without ties")
        self.inner = inner
        self._vocabulary([w for w in words if len(w[1]) == 1 or set(w[1]) <= inner])
        self.known: dict[str, tuple[str, list[int]]] = {}
        self.older: dict[str, tuple[str, list[int]]] = {}
        self.pairs = np.full(1 << PAIR_BITS, -1, np.int64)
        self.good = np.zeros(1 << PAIR_BITS, bool)
        self.boundary = re.compile(f"([^{re.escape(''.join(sorted(inner)))}])")

    def _vocabulary(self, words: list[tuple[int, str, float]]) -> None:
        """Tokens in merge order (rank 0 merges first; characters before all),
        their halves, the pairs that merge, and the suffix automaton."""
        words.sort(key=lambda w: (len(w[1]) > 1, -w[2] if len(w[1]) > 1 else 0, w[0]))
        rank = {p: r for r, (_, p, _) in enumerate(words)}
        n = len(words)
        self.ids = np.array([i for i, _, _ in words], np.int64)
        self.length = np.array([len(p) for _, p, _ in words], np.int64)
        left, right, first, second, whole = np.arange(n), np.arange(n), [], [], []
        self.reach = np.ones(n, bool)
        for r, (_, p, _) in enumerate(words):
            for cut in range(1, len(p)):
                a, b = rank.get(p[:cut]), rank.get(p[cut:])
                if a is not None and b is not None:
                    first.append(a)
                    second.append(b)
                    whole.append(r)
            if len(p) > 1:
                parts = list(p)
                while len(parts) > 2:
                    best = min(((rank.get(x + y, n), k) for k, (x, y) in enumerate(zip(parts, parts[1:]))))
                    if best[0] == n:
                        break
                    parts[best[1]: best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
                if len(parts) == 2 and all(x in rank for x in parts):
                    left[r], right[r] = rank[parts[0]], rank[parts[1]]
                else:
                    self.reach[r] = False  # merges never arrive at this piece
        self.left, self.right = left, right
        key = (np.array(first, np.int64) << 20) | np.array(second, np.int64)
        order = np.argsort(key)
        self.merge_key, self.merge_rank = key[order], np.array(whole, np.int64)[order]
        # The automaton: (node, character) -> node, a token's rank at its node.
        nodes: dict[tuple[int, int], int] = {}
        ends = {0: -1}
        for r, (_, p, _) in enumerate(words):
            at = 0
            for c in reversed(p):
                at = nodes.setdefault((at, ord(c)), len(nodes) + 1)
            if self.reach[r]:
                ends[at] = r
        arcs = sorted((a << 21 | c, b) for (a, c), b in nodes.items())
        self.arc = np.array([k for k, _ in arcs], np.int64)
        self.target = np.array([b for _, b in arcs], np.int64)
        self.token = np.full(len(nodes) + 1, -1, np.int64)
        for node, r in ends.items():
            self.token[node] = r
        self.longest = int(self.length.max(initial=1))

    def _compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Encoding the two tokens' joined text gives these two tokens.
        Answers are kept in a table of fixed size, newer over older."""
        key = (a << 20) | b
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        good = self.good[slot]
        new = np.flatnonzero(self.pairs[slot] != key)
        if len(new):
            fresh, inverse = np.unique(key[new], return_inverse=True)
            answer = self._test(fresh >> 20, fresh & ((1 << 20) - 1))[inverse]
            good[new] = answer
            self.pairs[slot[new]], self.good[slot[new]] = key[new], answer
        return good

    def _test(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Vectorised test.  Whichever token was merged last is taken apart on
        the side of the border; ``limit`` is the priority of the merge that
        was undone last.  A merge across the border that would have come
        before it refutes the pair.  (Left of the border an equal priority
        also would: the leftmost of equal merges comes first.)"""
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), NEVER)
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            key = (x << 20) | y
            at = np.minimum(np.searchsorted(self.merge_key, key), len(self.merge_key) - 1)
            across = (self.merge_key[at] == key) & (self.merge_rank[at] < limit[live])
            good[live[across]] = False
            keep = ~across
            live, x, y = live[keep], x[keep], y[keep]
            split_x, split_y = self.length[x] > 1, self.length[y] > 1
            from_x = split_x & (~split_y | (x > y))
            from_y = split_y & ~from_x
            limit[live[from_x]] = x[from_x]
            a[live[from_x]] = self.right[x[from_x]]
            limit[live[from_y]] = y[from_y] + 1
            b[live[from_y]] = self.left[y[from_y]]
            live = live[from_x | from_y]
        return good

    def _last_tokens(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(last, offsets): for each chunk, its prefixes' last tokens (-1: the
        position ends in a character without a piece)."""
        size = np.array([len(c) for c in chunks], np.int64)
        off = np.concatenate([[0], np.cumsum(size)])
        text = np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4").astype(np.int64)
        last = np.full(len(text), -2, np.int64)
        for e in range(int(size.max(initial=0))):
            live = np.flatnonzero(size > e)
            base, found = off[live], np.full(len(live), -1, np.int64)
            node, who = np.zeros(len(live), np.int64), np.arange(len(live))
            for back in range(min(self.longest, e + 1)):
                key = node << 21 | text[base[who] + e - back]
                at = np.minimum(np.searchsorted(self.arc, key), len(self.arc) - 1)
                ok = self.arc[at] == key
                node, who = self.target[at[ok]], who[ok]
                if not len(who):
                    break
                tok = self.token[node]
                could = (tok >= 0) & (found[who] < 0)
                if back == e:
                    found[who[could]] = tok[could]
                    continue
                prev = last[base[who[could]] + e - back - 1]
                hit = np.flatnonzero(could)
                hit, prev = hit[prev >= 0], prev[prev >= 0]
                hit = hit[self._compatible(prev, tok[hit])]
                found[who[hit]] = tok[hit]
            last[base + e] = found
        return last, off

    def _learn(self, chunks: list[str]) -> dict[str, list[int]]:
        """Ids of chunks made of vocabulary characters, shortest chunk first."""
        done = {}
        for a in range(0, len(chunks), 20_000):
            part = chunks[a: a + 20_000]
            last, off = self._last_tokens(part)
            at, base = off[1:].copy(), off[:-1]
            owner, found = [], []
            live = np.arange(len(part))
            while len(live):  # backwards, one token of every chunk at a time
                t = last[at[live] - 1]
                owner.append(live)
                found.append(self.ids[t])
                at[live] -= self.length[t]
                live = live[at[live] > base[live]]
            if not owner:
                continue
            owner, found = np.concatenate(owner[::-1]), np.concatenate(found[::-1])
            order = np.argsort(owner, kind="stable")
            cut = np.searchsorted(owner[order], np.arange(len(part) + 1)).tolist()
            flat = found[order].tolist()
            done |= {c: flat[i:j] for c, i, j in zip(part, cut, cut[1:])}
        return done

    def _run(self, n: int) -> list[int]:
        """A run of markers: merges from the left while a piece has the length."""
        parts: list[int] = []
        for _ in range(n):
            parts.append(1)
            while len(parts) > 1 and parts[-2] + parts[-1] in self.runs:
                parts[-2:] = [parts[-2] + parts[-1]]
        return [self.runs[x] if x > 1 else self.single[MARK] for x in parts]

    def _chunks(self, part: str) -> list[str]:
        """Cut a part between two spaces, its marker in front, at characters
        of no longer piece."""
        return [x for x in self.boundary.split(MARK + part) if x]

    def _know(self, parts: set[str]) -> None:
        """Remember new parts: their ids as decimals, their ids, their decoded text."""
        cut = {p: [MARK + p] if p.isascii() and p.isalpha() else self._chunks(p) for p in parts}
        whole = set().union(*cut.values())
        odd = {c for c in whole if len(c) == 1 and c not in self.inner}
        ids = {c: [self.single[c]] if c in self.single else [self.bytes[b] for b in c.encode()] for c in odd}
        ids |= self._learn(sorted(whole - odd, key=len))
        found = [ids[c[0]] if len(c) == 1 else [i for x in c for i in ids[x]] for c in cut.values()]
        number, text = self.decimals.__getitem__, self.surface.__getitem__
        backs = ["".join(map(text, out)) for out in found]
        # Byte pieces mean nothing one by one: the library decodes parts with them.
        with_bytes = [k for k, b in enumerate(backs) if BYTE in b]
        for k, b in zip(with_bytes, self.decode([found[k] for k in with_bytes]) if with_bytes else []):
            backs[k] = MARK + b
        for p, out, back in zip(cut, found, backs):
            self.known[p] = (",".join(map(number, out)), out, back[1:])

    def look_up(self, parts: list[str]) -> list[tuple[str, list[int], str]]:
        want = set(parts)
        if len(self.known) > KEEP:
            self.known, self.older = {}, self.known
        new = want - self.known.keys()
        again = new & self.older.keys()
        self.known |= {p: self.older[p] for p in again}
        new -= again
        self._know(new)
        out = list(map(self.known.__getitem__, parts))
        for x in [p for p in new if len(p) > 200]:
            del self.known[x]
        return out

    def _easy(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """(numbers of ids, ids joined by commas, decoded texts) of texts whose
        parts stand between single spaces: Arrow finds the distinct parts, and
        joins what is known of them."""
        data, off = vec.text_buffers(texts)
        new = np.zeros(len(data) + 1, bool)
        new[off] = True
        new[np.flatnonzero(data == 0x20) + 1] = True
        start = np.flatnonzero(new[:-1])
        ends = np.append(start, len(data)).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data)]) \
            .dictionary_encode()
        parts = [p.removesuffix(" ") for p in coded.dictionary.cast(pa.large_string()).to_pylist()]
        found = self.look_up(parts)
        code = coded.indices
        n = np.concatenate([[0], np.cumsum(np.array([len(x[1]) for x in found], np.int64)[code.to_numpy()])])
        place = np.searchsorted(start, off)

        def joined(k: int, sign: str) -> pa.Array:
            each = pa.array([x[k] for x in found], pa.large_string()).take(code)
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(place, pa.int32()), each), pa.scalar(sign, pa.large_string()))
        return n[place[1:]] - n[place[:-1]], joined(0, ","), joined(2, " ")

    def round_trip(self, texts: pa.Array) -> tuple[list[int], list[str], list[str]]:
        """(numbers of ids, ids joined by commas, decoded texts); null counts as empty."""
        texts = pc.replace_substring(pc.fill_null(pc.cast(texts, pa.large_string()), ""), MARK, " ")
        odd = pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")))
        odd = odd.to_numpy(zero_copy_only=False)  # several spaces in a row, or at an end
        rows = np.flatnonzero(~odd).tolist()
        n, ids, back = [0] * len(texts), [""] * len(texts), [""] * len(texts)
        for i, a, b, c in zip(rows, *(x.tolist() for x in self._easy(texts.filter(pa.array(~odd))))):
            n[i], ids[i], back[i] = a, b, c
        rows = np.flatnonzero(odd).tolist()
        cut = [texts[i].as_py().split(" ") for i in rows]
        known = dict(zip(words := list(set().union(*cut)), self.look_up(words)))
        runs = [self._with_runs(c, known) for c in cut]
        for i, found, c in zip(rows, runs, self.decode(runs) if runs else []):
            n[i], ids[i], back[i] = len(found), ",".join(map(str, found)), c
        return n, ids, back

    def _with_runs(self, parts: list[str], known: dict[str, tuple[str, list[int], str]]) -> list[int]:
        """Lone markers in a row merge among themselves, together with the
        marker that starts the next part where its word leaves it alone."""
        ids: list[int] = []
        lone, mark = 0, self.single[MARK]
        for p in parts:
            found = known[p][1]
            if found[0] == mark:
                lone += 1
                found = found[1:]
                if not found:
                    continue
            ids += self._run(lone) + found
            lone = 0
        ids += self._run(lone)
        return ids

    def encode(self, texts: list[str]) -> list[tuple[str, list[int]]]:
        """(ids joined by commas, ids) of each text."""
        _, found, _ = self.round_trip(pa.array(texts, pa.large_string()))
        return [(x, list(map(int, x.split(","))) if x else []) for x in found]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1)


def load(path: str) -> Model:
    if path not in _LOADED:
        _LOADED[path] = Model(path)
    return _LOADED[path]


def _round_trip(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for rows, _, _ in vec.slices(batches, limit=SLICE):
            yield rows, *model.round_trip(rows.column("text"))
    return run


def encode_decode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids as decimals joined by commas."""
    inner = _round_trip(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, n, ids, back in inner(batches):
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def digests(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), hashed where they are made."""
    inner = _round_trip(model)

    def sha(x: str) -> str:
        return hashlib.sha256(x.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, n, ids, back in inner(batches):
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(n, pa.int64()),
                 pa.array([sha(x) for x in ids], pa.string()), pa.array([sha(x) for x in back], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
