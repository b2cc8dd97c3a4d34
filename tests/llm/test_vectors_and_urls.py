"""Hard negatives, URL filter and whitening against brute force, and on odd inputs."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftweb.llm import feast, hardnegatives, queries, urlfilter, whitening

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def vectors(spark, rows):
    """Extra columns have names that the operators use themselves."""
    return spark.createDataFrame([(i, v, y, 1, "x", 2.0) for i, v, y in rows],
                                 "vec_id long, embedding array<double>, label int, part int, x string, n double")


def random_rows(seed, n, d=12, labels=3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 0.3, (labels, d))
    return [(int(i), [float(x) for x in centre[i % labels] * (i % 2) + rng.normal(0, 0.4, d)],
             int(i % labels) if i % 5 else 0) for i in range(n)]


ODD = [(900, None, 1), (901, [1.0, None] + [0.0] * 10, 1), (902, [NAN] * 12, 0), (903, [INF] + [0.0] * 11, 2),
       (904, [0.5] * 12, None), (None, [0.5] * 12, 1), (905, [], 1), (910, [0.25, -1.0], 0), (911, [1.0, -1.0], 0),
       (912, [1.0, -0.5], 1), (920, [0.0] * 12, 1)]


# ------------------------------------------------------------------------- 11

def brute_negatives(rows, anchor, positives=5, negatives=5):
    one = {}
    for i, v, y in rows:
        if i is None or y is None or not v or None in v or not np.isfinite(v).all():
            continue
        x = (y, [math.floor(256 * c) for c in v])
        one[i] = min(one.get(i, x), x)
    out = set()
    for a, (y, q) in one.items():
        if not anchor(a):
            continue
        score = {i: (z, sum(b * c for b, c in zip(q, v))) for i, (z, v) in one.items() if i != a and len(v) == len(q)}
        near = sorted((-s, i) for i, (z, s) in score.items() if z == y)[:positives]
        for s, p in near:
            some = sorted((-t, i) for i, (z, t) in score.items() if z != y and 80 * -s <= 100 * t <= 100 * -s)
            out |= {(a, p, k + 1, i, -s, -t) for k, (t, i) in enumerate(some[:negatives])}
    return out


def mined(df, every, **how):
    got = hardnegatives.mine(df, F.col("vec_id") % every == 0, F.col("label"), **how).collect()
    assert len(set(got)) == len(got)
    return {tuple(r) for r in got}


@pytest.mark.parametrize("cells,d", [(1 << 17, 12), (200, 12), (200, 3), (4000, 70)])
def test_hard_negatives(spark, monkeypatch, cells, d):
    monkeypatch.setattr(hardnegatives, "CELLS", cells)
    monkeypatch.setattr(hardnegatives, "ANCHOR_CELLS", cells // 2)
    rows = random_rows(d, 260, d) + [(700 + k, random_rows(d, 9, d)[k][1], k % 3) for k in range(9)]  # ties
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert len(want) > 100
    assert mined(vectors(spark, rows), 10) == want


def test_hard_negatives_odd(spark):
    rows = random_rows(4, 120) + ODD + random_rows(4, 3) + [(0, [1.0] * 12, 0)]
    assert mined(vectors(spark, rows), 10, positives=3, negatives=2) == brute_negatives(rows, lambda i: i % 10 == 0, 3, 2)
    assert mined(vectors(spark, []), 10) == set()
    assert mined(vectors(spark, [(0, [1.0], 1)]), 10) == set()
    far = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.9, 0.0], 2)]  # the positive's score is below zero
    assert mined(vectors(spark, far), 10) == brute_negatives(far, lambda i: i % 10 == 0) == set()


def test_segment_bounds_hold():
    rng = np.random.default_rng(8)
    for d in (1, 3, 16, 50, 64):
        v = rng.integers(-300, 300, (40, d))
        block = hardnegatives._Block.__new__(hardnegatives._Block)
        block.v, (block.mean, block.dev) = v, hardnegatives.summaries(v)
        every, exact, last = np.arange(40), v @ v.T, None
        for level in range(len(hardnegatives.LEVELS)):
            low, high = hardnegatives.bounds(block, block, every, every, level)
            assert (low <= exact).all() and (exact <= high).all()
            if last is not None:
                assert (high - low).mean() <= last + 1e-6  # finer segments bound closer
            last = (high - low).mean()


def test_summaries_filter_close_vectors():
    """Pairs of smooth vectors are told apart by summaries alone."""
    rng = np.random.default_rng(2)
    v = np.repeat(rng.integers(-300, 300, (200, 4)), 16, axis=1)
    block = hardnegatives._Block.__new__(hardnegatives._Block)
    block.id, block.label, block.v = np.arange(200), np.arange(200) % 2, v
    block.mean, block.dev = hardnegatives.summaries(v)
    low, high = hardnegatives.bounds(block, block, np.arange(200), np.arange(200), 0)
    assert (high - low).max() <= 2.1 + 1e-6 * np.abs(v @ v.T).max()
    a, b, s = hardnegatives.near_in_block(block, block, 5)
    assert (s == (v[a] * v[b]).sum(1)).all() and len(a) == 200 * 5


# ------------------------------------------------------------------------- 12

def cut(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def brute_rule(host, path, rules=urlfilter.RULES):
    fits = [(len(h + p), len(h), v == "block", v, h + p) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[3:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "http://a.COM/x", "http://com/", "http://com", "http://example.com/en/1",
        "http://WWW.Example.com/en/2?x#y", "http://m.www.example.com/en/", "http://notexample.com/en/", "http://x.net/es/9",
        "http://x.net/es", "http://x.net/fr/#z", "http://net/de/", "https://casino-win.example.org/de/5", "a://b://c.net/fr/",
        "http://x.org?u=http://y.com/", "http://ÄÖ.org/Ü漢\U0001f642\n/z", "http://x.net:80/es/1", "://q.com/", "HTTP://q.Com/en/",
        "http://" + ".".join(["a"] * 20000) + ".net/es/" + "x" * 50000, "http://x.org/" + "1234567890/" * 30000]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "p", "r", 0.5) for i, u in enumerate(urls)],
                                 "page_id long, url string, host string, path string, verdict string, p_block double")


def test_url_filter(spark):
    model = urlfilter.fit(urlfilter.labelled_urls(spark))
    rows = URLS + URLS[:9]
    got = sorted(urlfilter.judge(pages(spark, rows), model).collect(), key=lambda r: r["page_id"])
    assert len(got) == len(rows)
    for r, url in zip(got, rows):
        assert (r["host"], r["path"]) == cut(url)
        verdict, rule = brute_rule(r["host"], r["path"])
        assert r["rule"] == rule and 0 <= r["p_block"] <= 1
        assert r["verdict"] == (verdict or ("block" if r["p_block"] >= 0.5 else "allow"))
    by = dict(zip(rows, got))
    assert by["https://casino-win.example.org/de/5"]["verdict"] == "block"
    assert by["http://com"]["rule"] is None and by["http://com/"]["rule"] == "com/"
    assert by["http://m.www.example.com/en/"]["rule"] == "www.example.com/en/"
    assert urlfilter.judge(pages(spark, rows).limit(0), model).count() == 0


def test_url_filter_query(spark):
    rows = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    got = queries.QUERIES["op12_url_filter"](spark, SF).collect()
    assert {r["page_id"] for r in got} == set(rows) and len(got) == len(rows)
    for r in got:
        assert (r["host"], r["path"]) == cut(rows[r["page_id"]])
        verdict, rule = brute_rule(r["host"], r["path"])
        assert r["rule"] == rule and r["verdict"] in (("allow", "block") if rule is None else (verdict,))


def test_url_rules_overlap(spark):
    rules = [("allow", "a.b.com", "/"), ("block", "b.com", "/ab"), ("allow", "b.com", "/x"), ("block", "b.com", "/x"),
             ("allow", "b.com", "/x/y/z")]
    urls = [f"http://{h}{p}" for h in ("a.b.com", "b.com", "c.b.com", "ab.com", "x.a.b.com")
            for p in ("/", "/ab", "/abc", "/x", "/x/y/z", "")]
    got = {r["page_id"]: (r["verdict"], r["rule"]) for r in urlfilter.judge(
        pages(spark, urls), urlfilter.learn([], [], np.zeros(0)), rules).collect()}
    for i, u in enumerate(urls):
        verdict, rule = brute_rule(*cut(u), [r for r in rules if r != ("allow", "b.com", "/x")])
        assert got[i] == (verdict or "allow", rule)
    with pytest.raises(ValueError):
        urlfilter.RuleBook([("deny", "x", "/")])


def test_url_model_on_held_out_rows():
    """Every fifth URL of the labelled table is judged by a model of the others."""
    rows = urlfilter.invented_urls()
    random.Random(1).shuffle(rows)
    right = []
    for fold in range(5):
        learned = [r for i, r in enumerate(rows) if i % 5 != fold]
        model = urlfilter.learn(*(list(c) for c in zip(*(cut(u) for u, _ in learned))), np.array([y for _, y in learned], float))
        asked = rows[fold::5]
        p = model.scores(*(list(c) for c in zip(*(cut(u) for u, _ in asked))))
        right += [(x >= 0.5) == bool(y) for x, (_, y) in zip(p, asked)]
    assert np.mean(right) >= 0.88


def test_url_ngrams():
    who, what, value = urlfilter.features(["ab", "", "ab"], ["/1", "", "/2"])
    each = {r: collections.Counter(zip(what[who == r].tolist(), np.round(value[who == r], 9).tolist())) for r in range(3)}
    assert each[0] == each[2] and not each[1]  # digits are alike
    assert len(each[0]) == 3 + 2 + 1 + 1  # ^a ab b$, ^ab ab$, ^ab$ and /0
    for part in (what < urlfilter.BUCKETS, what >= urlfilter.BUCKETS):
        assert np.isclose((value[part & (who == 0)] ** 2).sum(), 1)


def test_url_labels(spark):
    made = spark.createDataFrame([("http://bad.org/x", 1), ("http://bad.org/x", 0), ("http://good.org/y", 0), (None, 1),
                                  ("http://z.org/", None)], "url string, blocked int")
    model = urlfilter.fit(made)
    assert model.scores(["bad.org"], ["/x"])[0] > 0.5 > model.scores(["good.org"], ["/y"])[0]
    none = urlfilter.fit(made.limit(0))
    assert none.scores(["bad.org"], ["/x"])[0] < 0.5


# ------------------------------------------------------------------------- 13

@pytest.mark.parametrize("make", [
    lambda r: r.normal(size=(500, 64)), lambda r: r.normal(size=(40, 64)), lambda r: r.normal(size=(5, 30)),
    lambda r: np.repeat(r.normal(size=(200, 4)), 5, axis=1), lambda r: r.normal(size=(300, 50)) * 10.0 ** -np.linspace(0, 6, 50),
    lambda r: np.eye(40) * 3, lambda r: np.zeros((9, 7)), lambda r: r.normal(size=(30, 1)),
    lambda r: np.vstack([r.normal(size=(900, 64)), 9 * np.ones((400, 64))])])
def test_contour_pairs(make):
    x = make(np.random.default_rng(3))
    a = np.cov(x.T, bias=True).reshape(x.shape[1], -1)
    e, u = feast.largest(a, 16)
    want = np.linalg.eigvalsh(a)[::-1][:16]
    scale = max(1.0, np.abs(a).max())
    assert len(e) == min(16, len(a)) and np.allclose(e, want, rtol=0, atol=1e-12 * scale)
    assert np.allclose(u.T @ u, np.eye(len(e)), atol=1e-12) and np.allclose(a @ u, u * e, atol=1e-11 * scale)


def test_inertia_counts():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(30, 30))
    a += a.T
    e = np.linalg.eigvalsh(a)
    for shift in np.linspace(e[0] - 1, e[-1] + 1, 41):
        assert feast.above(a, shift) in (None, (e > shift).sum())
    assert feast.above(np.eye(4), 1.0) is None and feast.above(np.array([[0.0, 1], [1, 0]]), 0.5) == 1


def brute_whitened(rows):
    """By vec_id: exact deviation, and values up to the component's sign."""
    x = {}
    for i, v, _ in rows:
        if v and None not in v and np.isfinite(v).all():
            x.setdefault(len(v), []).append((i, [math.floor(64 * c) + 1000000 for c in v]))
    out = {}
    for d, held in x.items():
        fit = np.array(sorted({tuple(v) for _, v in held}), object)
        n, sums = len(fit), fit.sum(0)
        centre = ((n * fit - sums).astype(float)) / n
        e, u = np.linalg.eigh(centre.T @ centre / n)
        e, u = e[::-1][:16], u[:, ::-1][:, :16]
        keep = e > whitening.FLAT * max(e.max(), 0)
        if keep.any():
            for i, v in held:
                dev = n * np.array(v, object) - sums
                out.setdefault(i, []).append((d, n, int((dev * dev).sum()), dev.astype(float) / n @ u[:, keep] / np.sqrt(e[keep]),
                                              e[keep] / np.trace(centre.T @ centre / n)))
    return out


def held_against_brute(spark, rows):
    df = vectors(spark, rows)
    got = collections.defaultdict(list)
    for r in whitening.whiten(df, whitening.fit(df)).collect():
        got[r["vec_id"]].append(r)
        assert r["identity_error"] <= 1e-4
    want = brute_whitened(rows)
    assert set(got) == set(want)
    signs = {}
    for i, all_of in want.items():
        assert len(got[i]) == sum(len(w[3]) for w in all_of)
        for d, n, dev, white, explained in all_of:
            mine = sorted((r for r in got[i] if r["n"] == n and r["deviation"] == dev), key=lambda r: r["component"])
            assert [r["component"] for r in mine][: len(white)] == sorted(
                (list(range(1, len(white) + 1)) * (len(mine) // len(white))))[: len(mine)][: len(white)] or len(mine) > len(white)
            by = {r["component"]: r for r in mine}
            for k in range(len(white)):
                r = by[k + 1]
                assert np.isclose(r["explained"], explained[k], rtol=1e-6)
                if abs(white[k]) > 1e-3:
                    sign = signs.setdefault((d, k), np.sign(r["whitened"] * white[k]))
                    assert np.isclose(r["whitened"], sign * white[k], rtol=1e-6, atol=1e-8)


def test_whitening(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(0, 0.1 + np.arange(20) / 20)], 1) for i in range(300)]
    held_against_brute(spark, rows + [(1000 + i, rows[7][1], 0) for i in range(150)])  # a third of all rows are copies


def test_whitening_odd(spark):
    rng = np.random.default_rng(10)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 12) * (1 + np.arange(12))], 1) for i in range(40)]
    held_against_brute(spark, rows + [r for r in ODD if not r[1] or len(r[1]) != 2] + [(3, rows[5][1], 0)])
    small = [(i, [float(i), 2.0, float(i * i)], None) for i in range(6)]  # one component is flat
    held_against_brute(spark, small + [(50 + i, [float(i)], 0) for i in range(4)] + [(60, [1.0, 2.0], 1)])
    for none in ([], [(1, None, 1)], [(1, [2.0, 3.0], 1), (2, [2.0, 3.0], 1)]):
        df = vectors(spark, none)
        assert whitening.whiten(df, whitening.fit(df)).count() == 0


def test_whitening_large_numbers(spark):
    """Sums beyond 64 bits stay exact; a deviation that does not fit is null."""
    rows = [(i, [1e12 * i, -3e11 * (i * i % 7), 5.0 + i], 1) for i in range(8)] + [(9, [1e300, 0.0, 0.0], 1)]
    df = vectors(spark, rows[:8])
    got = whitening.whiten(df, whitening.fit(df)).collect()
    want = brute_whitened(rows[:8])
    for r in got:
        dev = want[r["vec_id"]][0][2]
        assert r["deviation"] == (dev if dev < 2 ** 63 else None)
    huge = vectors(spark, rows)
    assert whitening.whiten(huge, whitening.fit(huge)).count() > 0


def test_whitening_query(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = queries.QUERIES["op13_whitening"](spark, SF).collect()
    want = brute_whitened(rows)
    assert len(got) == 16 * len(rows)
    for r in got:
        _, n, dev, white, explained = want[r["vec_id"]][0]
        k = r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, dev) and r["identity_error"] <= 1e-9
        assert np.isclose(abs(r["whitened"]), abs(white[k]), atol=1e-8) and np.isclose(r["explained"], explained[k], rtol=1e-9)
