"""The training-data operators against brute force, and on odd inputs.

``ODD`` holds nulls, empty and blank texts, one word, a long text, repeated
rows, a copy, a null doc_id and characters of all kinds; its other columns
have names that the operators use themselves.
"""

import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from siftweb.llm import (bloomlookup, chat, chosenpath, lempelziv, packing, pieces, quality, queries, tokens, topk,
                         toxicity, wavelet)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i * i % 977}" for i in range(6000))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, LONG), (5, LONG), (6, LONG), (None, "no id " * 40),
       (7, "Ünï 漢字 \U0001f642 \0 <|endoftext|> ▁x   y \r\n"), (8, "a b c d"), (9, "A b c D")]
SHAPE = "doc_id long, text string, h long, comp string, score double, range int, mark int, n_chars long, spans int"


def frame(spark, rows):
    full = [(i, t, 1, "x", 0.5, 2, 3, None if t is None else len(t), 4) for i, t in rows]
    return spark.createDataFrame(full, SHAPE)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def ids_of(rows):
    return collections.Counter(r["doc_id"] for r in rows)


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


# ------------------------------------------------------------------ 1 and 6

def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    return (rank[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()


@pytest.mark.parametrize("name,label,score,least", [
    ("op1_quality", "quality", "score", 0.97), ("op6_toxicity", "toxic", "p_toxic", 0.75)])
def test_held_out(spark, name, label, score, least):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES[name](spark, sf).toPandas()
    assert len(got) == docs_of(spark).sparkSession.read.parquet(f"{sf}/documents.parquet").count()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    met = got[got.held_out].merge(labels, on="doc_id", suffixes=("", "_label"))
    y = met[f"{label}_label" if f"{label}_label" in met else label].to_numpy().astype(int)
    assert auc(y, met[score].to_numpy()) >= least
    assert all(got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id])


def test_factorisation_identity():
    rng = np.random.default_rng(1)
    m = quality.Machine(0.3, rng.normal(size=quality.SIZE), rng.normal(size=(quality.SIZE, 4)))
    idx, val = np.array([3, 70, 9000, 5, 6]), np.array([0.5, 1.0, -2.0, 1.0, 3.0])
    off = np.array([0, 3, 5])
    want = [0.3 + sum(m.w[idx[i]] * val[i] for i in r) + sum(
        m.v[idx[i]] @ m.v[idx[j]] * val[i] * val[j] for i in r for j in r if i < j) for r in (range(3), range(3, 5))]
    assert np.allclose(m.margin(idx, val, off), want)


def test_classifiers_on_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (5, 1, 1), (8, None, None), (None, 1, 1), (9, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    no_labels = labels.limit(0)
    for use in (labels, no_labels):
        q, t = quality.fit(odd, use), toxicity.fit(odd, use)
        scored = quality.score(odd, q).collect()
        assert ids_of(scored) == collections.Counter(i for i, _ in ODD)
        assert all(0 <= r["score"] <= 1 for r in scored)
        found = toxicity.score(odd, t).collect()
        assert ids_of(found) == collections.Counter(i for i, _ in ODD)
        assert all(0 <= r["severity"] <= toxicity.GRADES for r in found)
        assert quality.score(none, q).count() == toxicity.score(none, t).count() == 0
    assert all(r["score"] == 0.5 for r in quality.score(odd, quality.fit(odd, no_labels)).collect())
    assert not any(r["toxic"] for r in found)
    assert toxicity.keep_clean(odd, t).schema == odd.schema and toxicity.keep_clean(odd, t).count() == len(ODD)
    assert quality.keep_good(odd, q).columns == odd.columns


def test_filters_keep_what_they_score_and_columns_of_any_name(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    odd = docs.select("source", "doc_id", F.lit(1).alias("a.b"), "text", F.lit("x").alias("o0"), "n_chars", "lang")
    q, t = quality.fit(docs, labels), toxicity.fit(docs, labels)
    good = {r["doc_id"] for r in quality.score(docs, q).filter("score >= 0.5").collect()}
    clean = {r["doc_id"] for r in toxicity.score(docs, t).filter("not toxic").collect()}
    assert 0 < len(good) < docs.count() and 0 < len(clean) < docs.count()
    for kept, want in ((quality.keep_good(odd, q), good), (toxicity.keep_clean(odd, t), clean)):
        assert kept.schema == odd.schema
        assert sorted(kept.collect(), key=lambda r: r["doc_id"]) == [
            r for r in sorted(odd.collect(), key=lambda r: r["doc_id"]) if r["doc_id"] in want]


def test_severity_orders_grades():
    rng = np.random.default_rng(3)
    n = 600
    grade = rng.integers(0, 4, n)
    h = [np.array([10, 20][: 1 + (g > 0)]) for g in grade]
    count = [np.array([1, 3 * g][: 1 + (g > 0)]) for g in grade]
    off = np.concatenate([[0], np.cumsum([len(x) for x in h])])
    m = toxicity.learn(np.concatenate(h), np.concatenate(count).astype(float), off, grade.astype(float))
    above = m.above(np.concatenate(h), np.concatenate(count), off)
    assert (np.diff(above, axis=1) <= 0).all() and (np.diff(m.thresholds) > 0).all()
    severity = above.sum(1)
    assert [severity[grade == g].mean() for g in range(4)] == sorted(severity[grade == g].mean() for g in range(4))


# ------------------------------------------------------------------------ 2

def shingles(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(rng, groups, size, words, edits):
    rows, n = [], 0
    for _ in range(groups):
        base = prose(rng, words, 5000)
        for k in range(size):
            w = list(base)
            for _ in range(rng.randrange(edits + 1)):
                w[rng.randrange(words)] = f"e{rng.randrange(9999)}"
            rows.append((n * 7 % 1009, " ".join(w)))
            n += 1
    return rows


@pytest.mark.parametrize("leaf,chunk", [(512, 2000), (3, 4)])
def test_near_duplicates(spark, monkeypatch, leaf, chunk):
    monkeypatch.setattr(chosenpath, "LEAF", leaf)
    monkeypatch.setattr(chosenpath, "CHUNK", chunk)
    rng = random.Random(5)
    rows = near_copies(rng, 6, 12, 120, 6) + [(2000 + i, t) for i, t in near_copies(rng, 30, 1, 40, 0)]
    rows += [(5000 + i, rows[0][1]) for i in range(20)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           chosenpath.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_by_stars(spark, monkeypatch):
    monkeypatch.setattr(chosenpath, "FEW", 0)
    monkeypatch.setattr(chosenpath, "_unite", None)
    rng = random.Random(6)
    rows = near_copies(rng, 4, 12, 120, 6) + [(5000 + i, " ".join(prose(rng, 30))) for i in range(10)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           chosenpath.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_united_in_one_task_within_its_memory():
    n = chosenpath.FEW
    ids = np.random.default_rng(1).permutation(2 * n) << 30
    edges = (pa.RecordBatch.from_arrays([pa.array(ids[i: i + 10000]), pa.array(ids[n + i: n + i + 10000])], names=["hi", "lo"])
             for i in range(0, n, 10000))
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in chosenpath._unite(edges)) == 2 * n
        assert tracemalloc.get_traced_memory()[1] < 48e6
    finally:
        tracemalloc.stop()


def binomial(n, p):
    return [math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(n + 1)]


@pytest.mark.parametrize("p,losses", [(0.75, (3e-10, 2e-5, 2e-3, 3e-2)), (0.8, (1e-11, 1e-6, 2e-4, 3e-3)),
                                      (0.9, (1e-15, 1e-9, 1e-7, 1e-6))])
def test_stated_loss_of_pairs(p, losses):
    shared = chosenpath.SHARED
    for depth, most in zip((0, 2, 5, 10), losses):
        lost = 0.0
        for m, chance in enumerate(binomial(shared, p)):  # a pair's equal coordinates serve all trees
            a, end = m / shared, 0.0
            for _ in range(depth):  # one child in two cases of three, else two
                one = 1 - a + a * end
                end = (2 * one + one * one) / 3
            lost += chance * (1 - p + p * end) ** chosenpath.TREES
        assert lost < most
    assert sum(binomial(chosenpath.COORDS, 0.75 + 0.25 / 256)[: chosenpath.AGREE]) < 1e-8


def test_paths_use_no_coordinate_twice():
    for tree in range(chosenpath.TREES):
        at = [((tree * 11 + 1) * (chosenpath.FAN * level + turn) + tree * 7) % chosenpath.SHARED
              for level in range(chosenpath.SHARED // chosenpath.FAN) for turn in range(chosenpath.FAN)]
        assert len(set(at)) == len(at)


def test_dissimilar_groups_die_out(spark, monkeypatch):
    """Documents that share a passage, at a similarity of 0.58: nothing to link,
    and the rows of a level do not grow."""
    monkeypatch.setattr(chosenpath, "LEAF", 120)
    rng = random.Random(8)
    passage = prose(rng, 48, 10 ** 6)
    rows = [(i, " ".join(passage + prose(rng, 16, 10 ** 6))) for i in range(500)]
    sizes = []
    members = chosenpath._Join.members

    def counted(self, df):
        out = members(self, df)
        sizes.append(out.count())
        return out
    monkeypatch.setattr(chosenpath._Join, "members", counted)
    got = chosenpath.near_duplicates(frame(spark, rows)).collect()
    assert all(r["component_id"] == r["doc_id"] for r in got) and len(got) == 500
    assert len(sizes) > 3 and max(sizes) <= 1.5 * sizes[0] and sizes[-1] < sizes[0]


def test_exhausted_paths_compare_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(chosenpath, "LEAF", 3)
    monkeypatch.setattr(chosenpath, "CHUNK", 5)
    monkeypatch.setattr(chosenpath, "SHARED", 3)  # FAN = 4: no level below the roots
    rng = random.Random(9)
    passage = prose(rng, 60, 10 ** 6)
    rows = [(i, " ".join(passage + prose(random.Random(i // 2), 18, 10 ** 6) + prose(rng, 1, 10 ** 6))) for i in range(60)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           chosenpath.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_one_doc_id_with_several_texts(spark):
    rng = random.Random(10)
    a, b = prose(rng, 60, 10 ** 6), prose(rng, 60, 10 ** 6)
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join([*a, "z"])), (3, " ".join([*b, "z"])), (4, "else " * 9)]
    got = {(r["doc_id"], r["component_id"]) for r in chosenpath.near_duplicates(frame(spark, rows)).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_keep_one_with_clashing_names(spark):
    names = ["_first", "_gone", "row", "id", "h", "place", "kept", "n", "doc", "rid", "a.b"]
    rows = [(1, "one two three four five six") + tuple(range(11)), (2, "One two three four five six") + tuple(range(11)), (3, "x") + (None,) * 11]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    kept = chosenpath.keep_one(df)
    assert kept.schema == df.schema
    assert sorted(kept.collect(), key=lambda r: r[0]) == [r for r in df.collect() if r[0] != 2]


def test_near_duplicates_odd(odd, none):
    got = chosenpath.near_duplicates(odd).collect()
    assert ids_of(got) == collections.Counter(i for i, _ in ODD)
    by = {r["doc_id"]: r for r in got}
    want = brute_components([r for r in ODD if r[0] is not None])
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in by.items() if i is not None} == want
    assert by[None]["component_id"] is None and by[None]["kept"]
    assert [by[i]["n_shingles"] for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert by[9]["component_id"] == 8 and not by[9]["kept"]
    assert chosenpath.near_duplicates(none).count() == 0
    kept = chosenpath.keep_one(odd)
    assert kept.columns == odd.columns
    assert ids_of(kept.collect()) == collections.Counter([1, 2, 3, 4, 5, None, 7, 8])


def test_near_duplicate_query(spark):
    rows = [tuple(r) for r in docs_of(spark).select("doc_id", "text").collect()]
    got = queries.QUERIES["op2_chosen_path"](spark, SF).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


# ------------------------------------------------------------------------ 3

def test_wavelet_matrix():
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 70, 3000).astype(np.uint16)
    w = wavelet.WaveletMatrix.from_row(wavelet.WaveletMatrix.build(ids).row())
    assert (w.decode() == ids).all()
    assert [w.access(i) for i in range(0, 3000, 37)] == ids[::37].tolist()
    for t in (0, 3, 69, 70, 5000):
        at = np.flatnonzero(ids == t)
        assert w.count(t) == len(at) and w.count(t, 1000) == (at < 1000).sum()
        assert [w.occurrence(t, k) for k in range(0, len(at), 9)] == at[::9].tolist()
    with pytest.raises(IndexError):
        w.occurrence(3, 10 ** 6)
    assert len(wavelet.WaveletMatrix.build(np.zeros(0, np.uint16)).decode()) == 0


def library_ids(file, texts, end=True):
    t = Tokenizer.from_file(public_tokenizers.path(file))
    return [e.ids + [1] * end for e in t.encode_batch(texts, add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_shards(spark, odd, none):
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs_of(spark).collect())
    ids = library_ids("word_bpe_49k.json", [t for _, t in rows])
    start = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    want = {(i, int(s), len(x), crc(x)) for (i, _), s, x in zip(rows, start, ids)}
    got = queries.QUERIES["op3_token_shards"](spark, SF)
    assert {(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got.collect()} == want
    from siftweb.session import scratch_path
    for df, texts in ((odd, [t or "" for _, t in ODD]), (none, [])):
        path = scratch_path(spark, "odd")
        wavelet.write_shards(df, public_tokenizers.path("word_bpe_49k.json"), path, shard_tokens=50)
        back = wavelet.read_documents(spark, path).collect()
        assert collections.Counter(r["ids_crc32"] for r in back) == collections.Counter(
            crc(x) for x in library_ids("word_bpe_49k.json", texts))
        ends = sorted((r["start"], r["n_tokens"]) for r in back)
        assert all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:]))


def test_look_up_in_written_shards(spark):
    from siftweb.session import scratch_path
    path, file = scratch_path(spark, "found"), "word_bpe_49k.json"
    rows = [(i, " ".join(prose(random.Random(i), 30, 9))) for i in range(20)]
    wavelet.write_shards(frame(spark, rows), public_tokenizers.path(file), path, shard_tokens=200)
    ids = dict(zip(range(20), library_ids(file, [t for _, t in rows])))
    shards = {r["shard"]: sum((ids[i] for i in r["doc_ids"]), []) for r in spark.read.parquet(path).collect()}
    assert len(shards) > 3
    token = ids[0][3]
    for k, at in ((0, 0), (5, 150), (40, 10 ** 6), (-1, -1)):
        for t in (token, 1, 40_000, 10 ** 7):
            got = {r["shard"]: tuple(r)[1:] for r in wavelet.look_up(spark, path, t, k, at).collect()}
            want = {}
            for s, x in shards.items():
                hits = [i for i, v in enumerate(x) if v == t]
                want[s] = (len(x), len(hits), hits[k] if 0 <= k < len(hits) else None, x[at] if 0 <= at < len(x) else None)
            assert got == want


@pytest.mark.parametrize("kind,file", [("word", "word_bpe_49k.json"), ("byte", "byte_bpe_50k.json")])
def test_new_words_meet_the_merges_only(kind, file, monkeypatch):
    """New words of plain texts are neither normalized nor cut by the library again, and a
    worker remembers a bounded number of them."""
    import tokenizers

    path = public_tokenizers.path(file)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}" * (1 + i // 100 % 3) for i in range(300)]
    texts = [" ".join(words), "It's  caf\u00e9, 12 %\t x's don't\n\n('ll) " + "a" * 500, "", " ", "\u00df \x07~\x7f"]
    model = type(tokens.load(kind, path))(path)
    library = tokenizers.Tokenizer.from_file(path)
    monkeypatch.setattr(model, "ids", None)
    got = [np.frombuffer(x, model.dtype).tolist() for x in model.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    for a in range(0, 400_000, 50_000):
        model.look_up([f"{i:x}" for i in range(a, a + 50_000)])
    if kind == "byte":  # of the pipeline, where workers have little room
        assert len(model.known) + len(model.older) <= 300_000


@pytest.mark.parametrize("kind,file", [("word", "word_bpe_49k.json"), ("byte", "byte_bpe_50k.json")])
def test_tokens_as_the_library(kind, file):
    rng = random.Random(4)
    bits = ["a", "the", " ", "  ", "\n", "\t", "é", "ß", "漢", "\U0001f642", "<|endoftext|>", "\0", "'s",
            "'ll", "12", "!", "|", " | ", "\r", "\x85", "\xa0", "é", "İ", "ﬁ", ", ", "...", "\x1c", "A"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(14))) for _ in range(4000)]
    model = tokens.load(kind, public_tokenizers.path(file))
    got = [np.frombuffer(x, model.dtype).tolist() for x in model.encode(texts)]
    assert got == library_ids(file, texts, end=False)


@pytest.mark.parametrize("kind,file", [("word", "word_bpe_49k.json"), ("byte", "byte_bpe_50k.json")])
def test_every_character_as_the_library(kind, file):
    """Alone, inside a word, beside digits and behind an apostrophe."""
    chars = [chr(c) for c in range(0x2000)]
    texts = [*chars, *(f"a{c}b" for c in chars), *(f"x {c} 1{c}" for c in chars), *(f"'{c}" for c in chars),
             *(f"{c}'s {c}'rex\n{c}  {c}\n\n{c} " for c in chars)]
    model = tokens.load(kind, public_tokenizers.path(file))
    got = [np.frombuffer(x, model.dtype).tolist() for x in model.encode(texts)]
    assert got == library_ids(file, texts, end=False)


def test_characters_of_another_unicode_version():
    """Those that the pattern here and the library's class differently, of all there are."""
    every = "".join(chr(c) for c in [*range(1, 0xD800), *range(0xE000, 0x110000)])
    odd = sorted(tokens.unlike(every))[::7]
    texts = [f"{a}{c}{b}" for c in odd for a, b in (("'", "'s"), ("x ", "1"), ("", "'s"))] + ["\0 \u4e2d's"]
    model = tokens.load("byte", public_tokenizers.path("byte_bpe_50k.json"))
    got = [np.frombuffer(x, model.dtype).tolist() for x in model.encode(texts)]
    assert got == library_ids("byte_bpe_50k.json", texts, end=False)


# ------------------------------------------------------------------------ 4

def test_top_k(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2 + 0.3 * (i % 3), 8)]) for i in range(700)]
    rows += [(700, None), (701, [1.0, None] + [0.0] * 6), (702, [float("nan")] * 8), (703, [float("inf")] * 8),
             (704, rows[3][1]), (None, rows[0][1]), (720, [1.0, 2.0]), (740, [0.0] * 8)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got = topk.top_k(df, df["vec_id"] % 20 == 0, k=5)
    ints = {i: np.floor(64 * np.array(v, float)).astype(int) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all()}
    want = set()
    for q, x in ints.items():
        if q % 20 == 0:
            near = sorted((-int(x @ y), i) for i, y in ints.items() if i != q and len(y) == len(x))[:5]
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(near)}
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == want
    assert topk.top_k(df.limit(0), df["vec_id"] % 20 == 0).count() == 0


# ------------------------------------------------------------------------ 5

def test_repeats_with_clashing_names(spark):
    names = ["_mark", "_hits", "_spans", "_more", "_ask", "_own", "_open", "h", "ref", "o0", "n_words", "row", "a.b"]
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text) + tuple(range(13)), (2, "x " + text + " y") + tuple(range(13)), (3, None) + (None,) * 13]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    got = {r["doc_id"]: r for r in lempelziv.remove_repeats(df).collect()}
    assert got[2]["text"] == "x y" and got[2]["n_removed"] == 60 and got[1]["n_removed"] == 0
    for i, r in enumerate(rows):
        assert [got[r[0]][n] for n in names if n != "n_words"] == [v for n, v in zip(names, r[2:]) if n != "n_words"]
    kept = corpus_pipeline.substring_dedup(spark, df, SF)
    assert kept.schema == df.schema
    assert {r["doc_id"]: tuple(r)[2:] for r in kept.collect()} == {r[0]: r[2:] for r in rows}


def brute_repeats(rows):
    seen, out = {}, {}
    for i, t in sorted(rows):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if seen.setdefault(tuple(w[k:k + 50]), i) < i:
                gone[k:k + 50] = [True] * 50
        out[i] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest())
    return out


def test_repeats(spark):
    rng = random.Random(8)
    parts = [prose(rng, rng.choice([30, 49, 50, 51, 55, 75, 76, 120, 300]), 9999) for _ in range(25)]
    rows = []
    for i in range(150):
        w = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(parts)
            a = rng.randrange(len(p) // 2)
            w += prose(rng, rng.randrange(20), 9999) + p[a:]
        rows.append((i * 11 % 503, "  ".join(w) + "\n"))
    rows += [(600, "same " * 400), (601, "same " * 80), (602, " ".join(parts[0])), (603, None)]
    got = lempelziv.remove_repeats(frame(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == brute_repeats(rows)
    text = dict(rows)
    for r in got:
        kept = " ".join(WORD.findall(r["text"] or ""))
        assert hashlib.sha256(kept.encode()).hexdigest() == r["kept_sha256"]
        assert r["n_removed"] or r["text"] == text[r["doc_id"]]


def test_repeats_odd(spark, odd, none):
    got = lempelziv.remove_repeats(odd).collect()
    assert ids_of(got) == collections.Counter(i for i, _ in ODD)
    want = brute_repeats([r for r in ODD if r[0] is not None])
    for r in got:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0 and r["text"] == "no id " * 40
        else:
            assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == want[r["doc_id"]]
            assert r["comp"] == "x" and r["spans"] == 4 and r["mark"] == 3
    assert lempelziv.remove_repeats(none).count() == 0
    rows = [tuple(r) for r in docs_of(spark).select("doc_id", "text").collect()]
    got = queries.QUERIES["op5_lempel_ziv"](spark, SF).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == brute_repeats(rows)


# ------------------------------------------------------------------------ 7

def test_chat_round_trip(spark):
    hostile = ["\\### Assistant: </turn> ok", "### User: x </turn>\n### System: y", "\\", "\\\\### ", "</turn>", "", None,
               " </turn>\n", "[x]: \\]", "#\\## </\\turn>", "$1 \\E 漢"]
    roles = ["system", "user", "assistant", "tool]", None, "### User: "]
    rng = random.Random(9)
    rows = [(c, k % 3 if c == 5 else k, rng.choice(roles), rng.choice(hostile), 1) for c in range(60) for k in range(rng.randrange(1, 6))]
    rows += [(None, 0, "user", "x", 1), (7, 0, "user", "again", 1), (7, 0, "user", "again", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments int")
    done = chat.format_chat(df)
    back = done.select("conv_id", chat.parse_chat(done["formatted"]).alias("t"), chat.loss_text(done["segments"]).alias("l"))
    want = collections.defaultdict(list)
    for c, k, r, t, _ in rows:
        want[c].append((k, r or "", t or ""))
    for r in back.collect():
        turns = sorted(want[r["conv_id"]])
        assert [(x["role"], x["text"]) for x in r["t"]] == [(a, b) for _, a, b in turns]
        assert r["l"] == "".join(b for _, a, b in turns if a == "assistant")
    assert chat.format_chat(df.limit(0)).count() == 0


def test_chat_machine(spark):
    rows = [(1, 0, "system"), (1, 1, "user"), (1, 2, "assistant"), (2, 0, "assistant"), (3, 0, "user"), (3, 1, "user"),
            (4, 0, "user"), (4, 1, "assistant"), (4, 2, "user"), (5, 0, "system")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "conv_id long, turn long, role string, text string")
    assert {r["conv_id"]: r["valid"] for r in chat.format_chat(df).collect()} == {1: True, 2: False, 3: False, 4: True, 5: False}


# ------------------------------------------------------------------------ 8

def check_pieces(rows, ids):
    seq, per = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
        per[r["doc_id"]].append(r)
    for spans in seq.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at and n > 0
            at += n
        assert at <= packing.LENGTH and (at == packing.LENGTH or at & (at - 1) == 0)
    assert set(per) == set(ids)
    for i, found in per.items():
        at = 0
        for r in sorted(found, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids[i])
            assert r["ids_crc32"] == crc(ids[i][at: at + r["length"]])
            at += r["length"]
        assert at == len(ids[i])


def test_packing(spark, none):
    rows = [(r["doc_id"], r["text"] or "") for r in docs_of(spark).collect()]
    ids = dict(zip([i for i, _ in rows], library_ids("byte_bpe_50k.json", [t for _, t in rows])))
    check_pieces(queries.QUERIES["op8_hilbert_packing"](spark, SF).collect(), ids)
    own = [r for k, r in enumerate(ODD) if k != 5]
    ids = dict(zip([i for i, _ in own], library_ids("byte_bpe_50k.json", [t or "" for _, t in own])))
    path = public_tokenizers.path("byte_bpe_50k.json")
    check_pieces(packing.pack(frame(spark, own), path).collect(), ids)
    twice = packing.pack(frame(spark, ODD), path).collect()
    assert sum(r["length"] for r in twice) == sum(map(len, ids.values())) + len(ids[5])
    assert packing.pack(none, path).count() == 0


def test_hilbert_key_is_a_curve():
    for dims, bits in ((2, 4), (3, 2), (4, 2)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = packing.hilbert_key(cells, bits)
        assert sorted(key.tolist()) == list(range(side ** dims))
        walk = cells[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


# ------------------------------------------------------------------------ 9

def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_sentencepiece(spark, odd, none):
    path = public_tokenizers.path("piece_bpe_32k.model")
    lib = pieces.load(path).library
    rng = random.Random(10)
    bits = ["a", "e", "he", " ", "  ", "\n", "é", "▁", "漢", "\U0001f642", "<s>", "\0", "ing", "tion", " the", "1", " " * 15]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(25))) for _ in range(3000)] + [" " * 77, "a" + " " * 40 + "b"]
    assert [x for _, x in pieces.load(path).encode(texts)] == lib.encode(texts)
    got = queries.QUERIES["op9_sentencepiece"](spark, SF).collect()
    for r, t in zip(sorted(got), sorted((r["doc_id"], r["text"]) for r in docs_of(spark).collect())):
        ids = lib.encode(t[1] or "")
        assert tuple(r) == (t[0], len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids)))
    got = pieces.encode_decode(odd, path).collect()
    assert collections.Counter((r["doc_id"], r["ids"], r["decoded"]) for r in got) == collections.Counter(
        (i, ",".join(map(str, lib.encode(t or ""))), lib.decode(lib.encode(t or ""))) for i, t in ODD)
    assert pieces.digests(none, path).count() == 0


# ----------------------------------------------------------------------- 10

def test_sketches_recover_differences():
    old = [f"Paragraph number {i} with some words." for i in range(60)]
    new = old[:20] + ["A changed one entirely."] + old[21:]
    def fingerprint(lines):
        text = "\n".join(lines)
        t, n = bloomlookup._sketch(bloomlookup.Words([text.encode()]), np.array([0]), np.array([1 << 20]), 24)
        return t.strings(np.array([1 << 20]), n)[0]
    a, b = fingerprint(old), fingerprint(new)
    gone, came = bloomlookup.difference(a, b)
    assert len(gone) == len(came) == 1
    assert bloomlookup.difference(a, a) == ([], [])
    assert bloomlookup.difference(a, fingerprint([f"other {i}" for i in range(60)])) is None


def exact_likeness(a, b):
    w = bloomlookup.Words([a.encode(), b.encode()])
    step = np.repeat(bloomlookup.steps(np.array([len(a), len(b)])).max(), 1)
    x, y = (set(w.digests(np.array([k]), step)[1].tolist()) for k in (0, 1))
    return len(x & y) / len(x | y) if x | y else 1.0


@pytest.mark.parametrize("odd_rows", [False, True])
def test_versions(spark, odd_rows):
    if odd_rows:
        rows = [r for k, r in enumerate(ODD) if k != 5]
        got = bloomlookup.versions(frame(spark, rows)).collect()
    else:
        rows = [tuple(r) for r in docs_of(spark).select("doc_id", "text").collect()]
        got = queries.QUERIES["op10_bloom_lookup"](spark, SF).collect()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    texts = [t or "" for _, t in rows]
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) == len(by)
    prints = {}
    for (i, _), t, nxt in zip(rows, texts, texts[1:] + texts[:1]):
        r, cut = by[i], len(t) // 3
        edited = t[: len(t) - cut] + nxt[:cut]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == sha(edited)
        assert prints.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert prints.setdefault(edited, r["edited_fingerprint"]) == r["edited_fingerprint"]
        assert r["near_edited"] == pytest.approx(exact_likeness(t, edited))
        assert r["near_next"] == pytest.approx(exact_likeness(t, nxt))
    assert np.mean([r["near_edited"] for r in got]) > 0.3


def test_versions_of_few(spark, none):
    assert bloomlookup.versions(none).count() == 0
    one = bloomlookup.versions(frame(spark, [(3, "some words here")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert bloomlookup.versions(frame(spark, ODD)).count() == len(ODD)
    assert bloomlookup.fingerprints(frame(spark, ODD)).count() == len(ODD)


def near_copy(rng, words):
    return [f"x{i}" if rng.random() < 0.01 else w for i, w in enumerate(words)]


def test_near_copies_are_alike_at_every_length(spark):
    rng, rows, length = random.Random(8), [], {}
    for n in [80] * 40 + [800] * 10 + [20000, 160000]:
        old = prose(rng, n, 20000)
        rows += [(2 * len(length) + 1, " ".join(old)), (2 * len(length), " ".join(near_copy(rng, old)))]
        length[rows[-2][0]] = n
    near = {n: [] for n in length.values()}
    for r in bloomlookup.versions(frame(spark, rows)).collect():
        if r["doc_id"] in length:
            near[length[r["doc_id"]]].append(r["near_next"])
    assert all(0.8 < np.mean(x) < 0.98 for x in near.values()), near


def test_changes_gives_back_every_difference(spark):
    rng, pairs = random.Random(9), [(1, None, ""), (2, "a b\nc", None), (None, LONG, LONG)]
    for n in (100, 2000, 50000):  # a third edited: far more digests than a stored fingerprint gives back
        old = prose(rng, n, 20000)
        pairs.append((n, " ".join(old), " ".join(old[: n - n // 3] + prose(rng, n // 3, 20000) + ["more"] * (n // 9))))
    got = {r["doc_id"]: r for r in bloomlookup.changes(spark.createDataFrame(pairs, "doc_id long, text string, other string")).collect()}
    assert len(got) == len(pairs)
    for i, a, b in pairs:
        w = bloomlookup.Words([(a or "").encode(), (b or "").encode()])
        x, y = (set(w.digests(np.array([k]), bloomlookup.steps(np.zeros(1)))[1].tolist()) for k in (0, 1))
        r = got[i]
        assert r["n_common"] == len(x & y)
        assert [v % 2 ** 64 for v in r["only_text"]] == sorted(x - y)
        assert [v % 2 ** 64 for v in r["only_other"]] == sorted(y - x)


def test_fingerprints_of_other_lengths_and_many_digests(spark):
    words = prose(random.Random(10), 300, 20000)
    text = (" ".join(words) + " " * 1024)[:1024]  # the length where the step once changed
    a, b = (r["fingerprint"] for r in bloomlookup.fingerprints(frame(spark, [(1, text), (2, text + " z")])).orderBy("doc_id").collect())
    gone, came = bloomlookup.difference(a, b)
    assert 1 <= len(gone) + len(came) <= 3
    t = bloomlookup.Tables(1, 24)
    t.count[:] = 40_000
    assert bloomlookup.Tables.parse(t.strings(np.array([4]), np.array([300_000]))[0])[2].count.tolist() == [40_000] * 24


# ----------------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    docs = docs_of(spark)
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_dedup", "substring_dedup", "packing"]
    before = None
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == "packing":
            texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
            check_pieces(out.collect(), dict(zip([i for i, _ in texts], library_ids("byte_bpe_50k.json", [t or "" for _, t in texts]))))
            break
        assert out.columns == columns
        rows = {r["doc_id"]: r for r in out.collect()}
        before = {r["doc_id"]: r for r in docs.collect()}
        assert set(rows) <= set(before)
        if name == "near_dedup":
            want = brute_components([(i, r["text"]) for i, r in before.items()])
            assert set(rows) == {i for i, (_, c) in want.items() if c == i}
        if name == "substring_dedup":
            want = brute_repeats([(i, r["text"]) for i, r in before.items()])
            assert {i: sha(" ".join(WORD.findall(r["text"]))) for i, r in rows.items()} == {i: w[2] for i, w in want.items()}
            assert all(r["n_chars"] == len(r["text"]) for i, r in rows.items() if want[i][1])
        else:
            assert all(rows[i] == before[i] for i in rows)
            assert len(rows) > 0.7 * len(before)
        docs = spark.createDataFrame(list(rows.values()), docs.schema)
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_pipeline_on_an_empty_table(spark):
    docs = docs_of(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0


def test_paths_carry_few_bits(spark, monkeypatch):
    """Neither low bytes nor whole sketches are dealt out with the members of nodes, and only
    sets in question leave the table of all sets."""
    rng = random.Random(23)
    words = [f"w{i}" for i in range(4000)]
    base = [rng.choices(words, k=120) for _ in range(60)]
    rows = []
    for i, x in enumerate(base):
        y = list(x)
        y[60] = "changed"
        rows += [(2 * i, " ".join(x)), (2 * i + 1, " ".join(y))]
    seen = []
    write = chosenpath._Join.write

    def noted(self, df, name):
        seen.append((name, df.columns))
        return write(self, df, name)
    monkeypatch.setattr(chosenpath._Join, "write", noted)
    got = {r["doc_id"]: r["component_id"] for r in chosenpath.near_duplicates(frame(spark, rows)).collect()}
    assert got == {i: i - i % 2 for i in got}
    held = [c for name, c in seen if name in ("groups", "promising")]
    assert held and not any({"low", "sig"} & set(c) for c in held)
    n, p = chosenpath.BRIEF, 0.75 + 0.25 / 4
    assert sum(math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(chosenpath.ALIKE)) < 1e-8
    bits = np.random.default_rng(1).integers(0, 2 ** 32, (2, chosenpath.COORDS), np.uint32)
    bits[1, :150] = bits[0, :150]
    a, b = chosenpath._brief(bits).view("<u8")
    x = a ^ b
    same = n - int(np.bitwise_count((x | x >> np.uint64(1)) & np.uint64(0x5555555555555555)).sum())
    assert same == sum((bits[0, :n] >> 8 & 3) == (bits[1, :n] >> 8 & 3))


def test_exact_comparison_of_many_unlinked_sets(monkeypatch):
    """Sets that share a little less than a link needs are told apart all at once; only
    pairs of enough equal codes are compared element by element."""
    rng = np.random.default_rng(3)
    sets = []
    for i in range(120):
        shared = rng.integers(0, 2 ** 63, 150, np.uint64) if i % 60 == 0 else sets[i - i % 60][:150]
        sets.append(np.concatenate([shared, rng.integers(0, 2 ** 63, 30, np.uint64)]))
    sets += [np.concatenate([sets[0][:170], rng.integers(0, 2 ** 63, 10, np.uint64)]), sets[60][:150]]
    sets = [np.sort(s) for s in sets]
    n = len(sets)
    table = pa.table({
        "g": np.zeros(n, np.int64), "part": np.zeros(n, np.int32), "rid": np.arange(n), "comp": np.arange(n),
        "focus": np.ones(n, bool), "size": np.array([len(s) for s in sets]),
        "brief": [bytes(chosenpath.BRIEF // 4)] * n, "low": [bytes(chosenpath.COORDS)] * n,
        "elements": [s.tobytes() for s in sets]})
    exact, calls = chosenpath.linked, []
    monkeypatch.setattr(chosenpath, "linked", lambda a, b: calls.append(1) or exact(a, b))
    got = [row for b in chosenpath._verify(iter(table.to_batches())) for row in zip(*b.to_pydict().values())]
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if exact(sets[i], sets[j])}
    assert want

    def parts(edges):
        name = list(range(n))
        for a, b in edges:
            old, new = max(name[a], name[b]), min(name[a], name[b])
            name = [new if x == old else x for x in name]
        return name
    assert parts(got) == parts(want)
    assert len(calls) < 400


def test_few_files_however_many_partitions(spark, monkeypatch):
    """A small table's files and the tasks that read it do not grow with a shuffle's partitions."""
    monkeypatch.setattr(chosenpath, "FILES", 1)
    run = chosenpath._Join(docs_of(spark))
    run.grown(1000)
    df = run.write(docs_of(spark).repartition(97, "doc_id").select("doc_id"), "some")
    at = df.inputFiles()
    assert len(at) <= max(1, spark.sparkContext.defaultParallelism)
    assert df.count() == docs_of(spark).count()
    run.grown(10 ** 9)
    assert run.files == 10 ** 9 // chosenpath.ROWS


def test_toxicity_learns_without_copies_of_the_sample(monkeypatch):
    """The driver holds the sample's matrix once."""
    monkeypatch.setattr(toxicity, "STEPS", 2)
    rng, n = np.random.default_rng(4), 4000
    label = (np.arange(n) % 4 == 0).astype(float)
    rows = [np.sort(rng.choice(np.arange(400) + (0 if y else 400), 10, replace=False)) for y in label]
    h, off = np.concatenate(rows), np.arange(n + 1) * 10
    tracemalloc.start()
    try:
        model = toxicity.learn(h, np.ones(len(h)), off, label)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(model.words) == toxicity.WORDS
    assert peak < 1.6 * 8 * n * toxicity.WORDS
