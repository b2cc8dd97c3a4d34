"""Whole-text tokenization with the tokenizers library, over arrays of pre-tokens.

Both tokenizer files cut a text into pre-tokens, which are merged one by one,
so a text's ids are the joined ids of its pre-tokens.  A slice of documents is
cut at once: each byte has the class of its character (letter, digit, space,
other), and the files' patterns are rules on where classes change.  Arrow finds
the distinct pre-tokens of the slice, only those are looked up, and the ids are
gathered by numpy.  Texts of characters whose class is not known to be the
library's go through the pattern itself (``byte_bpe_50k``) or through the library
(``word_bpe_49k``, which also normalizes); texts that hold the string of an added
token, or a character that the library's pattern sees otherwise, are encoded whole.

Each worker keeps the ids of the pre-tokens that it has seen, in two
generations of about ``keep``: when the younger is full it becomes the older,
and pre-tokens that are still in use move up again.  New ones go to the merges of
the library's model one by one, written in its letters for bytes, without the
library's own normalizing, cutting and counting of offsets, which is done by then.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from siftweb.llm import vec

LONGEST = 200
#: Bytes of text that are cut and looked up at once.
SLICE = 4 << 20
HARD, LETTER, DIGIT, SPACE, OTHER, INSIDE = range(6)
# The byte tokenizer's pattern, and the endings after an apostrophe.
_BYTE = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
_ENDINGS = (b"s", b"t", b"m", b"d", b"re", b"ve", b"ll")
#: Characters whose classes are looked up by code point.
PLAIN = 0x800
#: The letters by which both vocabularies write bytes: printable ones as they are, the others from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_LETTERS = {b: 0x100 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))}
_LOADED: dict[tuple[str, str], Pieces] = {}


def _ascii_classes() -> np.ndarray:
    c = np.full(PLAIN, HARD, np.uint8)
    c[:128] = OTHER
    c[[0x20, 9, 10, 11, 12, 13]] = SPACE
    c[0x30:0x3A] = DIGIT
    c[0x41:0x5B] = c[0x61:0x7B] = LETTER
    return c


def word_classes() -> np.ndarray:
    """Letters that the library's normalizer only lower-cases; other than ASCII
    characters beside these are hard."""
    c = _ascii_classes()
    for a, b in ((0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x12F), (0x132, 0x2AF)):
        c[a:b + 1] = LETTER
    for x in range(128, PLAIN):  # the lower case has to be one letter of the same range
        low = chr(x).lower()
        if c[x] == LETTER and (len(low) != 1 or ord(low) >= PLAIN or c[ord(low)] != LETTER):
            c[x] = HARD
    return c


def byte_classes() -> np.ndarray:
    """Letters, numbers and others as the pattern sees them; spaces beyond ASCII are hard."""
    c = _ascii_classes()
    for x in range(128, PLAIN):
        ch = chr(x)
        c[x] = HARD if regex.match(r"\s", ch) else LETTER if regex.match(r"\p{L}", ch) else \
            DIGIT if regex.match(r"\p{N}", ch) else OTHER
    return c


def unlike(chars: str) -> set[str]:
    """Those of distinct characters (without U+0000) that the library's regular
    expressions class otherwise than those here, whose Unicode version may differ."""
    from tokenizers import Regex, normalizers

    odd: set[str] = set()
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        theirs = normalizers.Replace(Regex(kind), "\0").normalize_str(chars)
        odd |= {c for c, a, b in zip(chars, theirs, regex.sub(kind, "\0", chars)) if a != b}
    return odd


def classes_of(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Class of each byte's character; INSIDE for all but a character's first byte."""
    one = np.full(256, HARD, np.uint8)
    one[:0x80], one[0x80:0xC0] = table[:0x80], INSIDE
    out = np.frombuffer(bytearray(data.tobytes().translate(one.tobytes())), np.uint8)
    two = np.flatnonzero((data >= 0xC2) & (data <= 0xDF))
    out[two] = table[((data[two] & 31).astype(np.int16) << 6) | (data[two + 1] & 63)]
    return out


def _endings(data: np.ndarray, at: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Length of the ending behind each apostrophe, 0 if there is none."""
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    one, two = padded[at + 1], padded[at + 2]
    n = np.zeros(len(at), np.int64)
    for e in _ENDINGS:
        if len(e) == 1:
            n[(one == e[0]) & (at + 1 < stop)] = 1
        else:
            n[(one == e[0]) & (two == e[1]) & (at + 2 < stop)] = 2
    return n


class Pieces:
    """Ids of pre-tokens as little-endian 16- or 32-bit strings."""

    table: np.ndarray
    #: Pre-tokens in a generation.
    keep: int

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.library.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.model = self.library.model

    def ids(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def starts(self, data: np.ndarray, kind: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start of each pre-token or gap, whether it is a gap); the first of
        each document starts at the document."""
        raise NotImplementedError

    def _bounds(self, kind: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per byte: its character's class, that of the byte before, whether a
        document starts there, whether it is a character's first byte."""
        first = kind != INSIDE
        both = np.empty(len(kind) + 1, np.uint8)
        both[0], both[1:] = HARD, kind
        own, inside = both[1:], np.flatnonzero(~first)
        own[inside] = kind[inside - 1]
        edge = np.zeros(len(kind) + 1, bool)
        edge[off] = True
        return own, both[:-1], edge[:-1], first

    def _take_endings(self, data: np.ndarray, off: np.ndarray, new: np.ndarray) -> None:
        """An apostrophe that starts its pre-token takes an ending with it."""
        at = np.flatnonzero((data == 0x27) & new)
        n = _endings(data, at, off[np.searchsorted(off, at, side="right")])
        at, n = at[n > 0], n[n > 0]
        new[at + 1] = False
        behind = at + 1 + n
        new[behind[behind < len(data)]] = True

    def hard(self, text: str) -> list[str] | None:
        """Pre-tokens of a text with hard characters; None if it has to be encoded whole."""
        return None

    def lowered(self, texts: pa.Array) -> pa.Array:
        return texts

    def ids_of(self, words: list[str]) -> dict[str, bytes]:
        """Ids of many pre-tokens."""
        ids, ends, merged = [], [0], self.model.tokenize
        for w in words:
            if not (w.isascii() and w.isalnum()):
                w = w.encode().decode("latin-1").translate(_LETTERS)
            ids += [t.id for t in merged(w)]
            ends.append(len(ids))
        raw, size = np.array(ids, self.dtype).tobytes(), self.dtype.itemsize
        return {w: raw[i * size: j * size] for w, i, j in zip(words, ends, ends[1:])}

    def look_up(self, words: list[str]) -> list[bytes]:
        """Ids of distinct pre-tokens."""
        if len(self.known) > self.keep:
            self.known, self.older = {}, self.known
        out = list(map(self.known.get, words))
        absent = [i for i, x in enumerate(out) if x is None]
        again = {}
        new = []
        for i in absent:
            w = words[i]
            x = out[i] = self.older.get(w)
            if x is None:
                new.append(w)
            else:
                again[w] = x
        self.known.update(again)
        if new:
            found = self.ids_of(new)
            for i in absent:
                if out[i] is None:
                    out[i] = found[words[i]]
            self.known.update(found)
            for w in new:
                if len(w) > LONGEST:
                    del self.known[w]
        return out

    def _plain(self, texts: pa.Array) -> list[bytes]:
        """Ids of texts without hard characters and added tokens."""
        texts = self.lowered(texts)
        data, off = vec.text_buffers(texts)
        kind = classes_of(data, self.table)
        start, gap = self.starts(data, kind, off)
        ends = np.append(start, len(data)).astype(np.int64)
        cut = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        coded = cut.filter(pa.array(~gap)).dictionary_encode()
        words = coded.dictionary.cast(pa.large_string()).to_pylist()
        raw = self.look_up(words)
        size = self.dtype.itemsize
        n = np.array([len(x) for x in raw], np.int64) // size
        flat, first = np.frombuffer(b"".join(raw), self.dtype), np.concatenate([[0], np.cumsum(n)])[:-1]
        code = coded.indices.to_numpy()
        count = n[code]
        end = np.cumsum(count)
        at = np.arange(end[-1] if len(end) else 0) + np.repeat(first[code] - (end - count), count)
        ids = flat[at].tobytes()
        # Each document's first pre-token, counted without gaps.
        place = np.searchsorted(start[~gap], off)
        cuts = (np.concatenate([[0], end])[place] * size).tolist()
        return [ids[i:j] for i, j in zip(cuts[:-1], cuts[1:])]

    def encode_array(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text of an Arrow array; null counts as empty."""
        texts = pc.fill_null(pc.cast(texts, pa.large_string()), "")
        data, off = vec.text_buffers(texts)
        kind = classes_of(data, self.table)
        bad = np.searchsorted(np.flatnonzero(kind == HARD), off)
        easy = bad[1:] == bad[:-1]
        whole = np.zeros(len(texts), bool)
        for x in self.added:
            whole |= pc.match_substring(texts, x).to_numpy(zero_copy_only=False)
        easy &= ~whole
        out: list[bytes] = [b""] * len(texts)
        rows = np.flatnonzero(easy)
        for i, x in zip(rows.tolist(), self._plain(texts.take(pa.array(rows)))):
            out[i] = x
        for i in np.flatnonzero(~easy).tolist():
            text = texts[i].as_py()
            cut = None if whole[i] else self.hard(text)
            if cut is None:
                out[i] = self.ids(text)
            else:
                held = dict(zip(words := list(set(cut)), self.look_up(words)))
                out[i] = b"".join([held[w] for w in cut])
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        return self.encode_array(pa.array(texts, pa.large_string()))


class WordPieces(Pieces):
    table = word_classes()
    keep = 300_000

    def lowered(self, texts):
        return pc.utf8_lower(texts)

    def starts(self, data, kind, off):
        own, prior, edge, first = self._bounds(kind, off)
        new = first & ((own != prior) | (own == DIGIT) | edge)
        self._take_endings(data, off, new)
        start = np.flatnonzero(new)
        return start, kind[start] == SPACE


class BytePieces(Pieces):
    table = byte_classes()
    keep = 100_000

    def __init__(self, path):
        super().__init__(path)
        self.judged: set[str] = {chr(c) for c in range(PLAIN)}
        self.odd = unlike("".join(sorted(self.judged - {"\0"})))
        self.table = self.table.copy()
        self.table[[ord(c) for c in self.odd]] = HARD

    def hard(self, text):
        used = set(text)
        if new := used - self.judged:
            self.odd |= unlike("".join(new))
            self.judged |= new
        return _BYTE.findall(text) if self.odd.isdisjoint(used) else None

    def starts(self, data, kind, off):
        own, prior, edge, first = self._bounds(kind, off)
        new = first & ((own != prior) | edge)
        # Behind spaces: the last one leaves their run, and a blank joins what follows.
        after = np.flatnonzero(new & (own != SPACE) & (prior == SPACE) & ~edge)
        new[after - 1] = True
        blank = data[after - 1] == 0x20
        new[after[blank]] = False
        self._take_endings(data, off, new)
        start = np.flatnonzero(new)
        return start, np.zeros(len(start), bool)


def load(kind: str, path: str) -> Pieces:
    """The worker's own tokenizer: kind is 'word' or 'byte'."""
    if (kind, path) not in _LOADED:
        _LOADED[kind, path] = {"word": WordPieces, "byte": BytePieces}[kind](path)
    return _LOADED[kind, path]


def encode_rows(pieces: Pieces, rows: pa.RecordBatch, end_id: int) -> list[np.ndarray]:
    """Ids of each document of a slice (see ``vec.slices``), the end id appended."""
    tail = np.array([end_id], pieces.dtype).tobytes()
    return [np.frombuffer(x + tail, pieces.dtype) for x in pieces.encode_array(rows.column("text"))]
