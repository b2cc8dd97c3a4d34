"""URL filter: host and path rules, then a logistic regression on hashed
character n-grams of host and path.

A URL's host lies after the first ``://`` up to ``/``, ``?``, ``#`` or the end,
A-Z lower-cased; its path follows, up to ``?``, ``#`` or the end.  A rule fits
its host and all subdomains where the path starts with the rule's path.  The
longest rule (host and path together) decides; of equally long ones that of
the longer host, then ``block``.  URLs without a rule are judged by the model.

Features: all 2- to 5-grams of the host (its ends marked) and of the path, over
code points with every digit as ``0``, hashed to ``BUCKETS`` buckets of each
part's own.  Counts go in as square roots, each part scaled to unit length.
``fit`` takes a small labelled URL table, of which at most ``SAMPLE`` distinct
URLs are learned, picked by hash: that bounds the driver's work.  ``judge`` is
a narrow pass over whole URLs; model (2 x ``BUCKETS`` numbers) and rules (a list
that the caller holds) travel in a broadcast.

Defined cases: a null URL or one without ``://`` has an empty host and path, no
rule fits it, and the model judges it without any n-gram (by its bias: the
labelled table's balance); an empty path starts with no rule's ``/``; without
labelled rows everything is allowed; several labels of a URL are averaged (one
half blocks), null labels and null URLs are not learned; repeated rows are
judged each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftweb.llm import vec

BUCKETS, SHORTEST, LONGEST = 1 << 15, 2, 5
SAMPLE, STEPS, RATE, DECAY = 4000, 300, 0.5, 1e-4
_SEEDS = (0x51ED270B, 0xA24BAED5)
_POLY = vec.Poly(5)

#: (verdict, host, path)
Rule = tuple[str, str, str]
RULES: tuple[Rule, ...] = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

# Words of invented hosts: what a filter for training data blocks, and what it leaves.
BLOCKED_WORDS = """casino jackpot slots poker roulette betting bets bet odds gamble lottery bonus adult porn xxx sex
cams escort nude viagra pills meds pharmacy diet cheap replica discount spam farm backlink seo links ads adserver
popunder banner click track tracker tracking pixel payday loans cash free prize winner win claim warez crack
keygen serial torrent""".split()
ALLOWED_WORDS = """library museum university college school physics history poetry garden bakery kitchen recipes
weather mountain river harbour city council theatre cinema music chess astronomy atlas birds travel transport train
railway archive journal medical law review science maths lesson language guide docs open data source project wiki
news times daily world nation station notes letters books adventure farmers market craft health sport football
cycling running fishing forest village people family story thistle thorn thunder other then there theory
rest read order street""".split()
_SYLLABLES = "ba ca den el fo gar hin io ka lon mer nor pa ren sa ti un ver wol za th er an in re".split()


def _urls(words: list[str], seed: int, blocked: int) -> list[tuple[str, int]]:
    """Four URLs a word, by one rule for both labels, so that only the words tell them apart."""
    rng = random.Random(seed)
    out = []
    for word in words:
        for k in range(4):
            name = "".join(rng.choice(_SYLLABLES) for _ in range(rng.randrange(1, 4)))
            near = rng.choice(words)
            host = (f"{word}-{near}", f"{word}{name}", f"{name}-{word}", f"{near}-{word}-{name}")[k]
            page = rng.choice(("", "/", ".html", "?page=2", "#top", "?utm_source=feed"))
            out.append((f"http{rng.choice(['', 's'])}://{rng.choice(['', 'www.', 'm.', 'blog.'])}{host}.example."
                        f"{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'de', 'fr', 'es'])}/"
                        f"{rng.randrange(10 ** rng.randrange(1, 7))}{page}", blocked))
    return out


def invented_urls() -> list[tuple[str, int]]:
    """The small labelled URL table (url, blocked): word lists and one rule; plain
    invented names stand on the allowed side."""
    rng = random.Random(3)
    plain = ["".join(rng.choice(_SYLLABLES) for _ in range(rng.randrange(2, 5))) for _ in range(40)]
    return _urls(BLOCKED_WORDS, 1, 1) + _urls(ALLOWED_WORDS + plain, 2, 0)


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(invented_urls(), "url string, blocked int")


def host_of(url: Column) -> Column:
    return F.translate(_parts(url, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return _parts(url, 2)


def _parts(url: Column, group: int) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    return F.coalesce(F.regexp_extract(rest, r"(?s)^([^/?#]*)([^?#]*)", group), F.lit(""))


def text_of(rule: Rule) -> str:
    return rule[1] + rule[2]


class RuleBook:
    """Rules by host, the longest first."""

    def __init__(self, rules: Sequence[Rule]):
        best: dict[tuple[str, str], str] = {}
        for verdict, host, path in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"unknown verdict {verdict!r}")
            best[host, path] = "block" if "block" in (verdict, best.get((host, path))) else "allow"
        self.by_host: dict[str, list[Rule]] = {}
        for (host, path), verdict in sorted(best.items(), key=lambda r: (-len(r[0][1]), r[0])):
            self.by_host.setdefault(host, []).append((verdict, host, path))
        self.longest = max(map(len, self.by_host), default=0)

    def of_host(self, host: str) -> list[Rule]:
        """All rules of the host and the domains above it, the longest first."""
        found = list(self.by_host.get(host, []))
        at = host.find(".", max(0, len(host) - self.longest - 1))
        while at >= 0:
            found += self.by_host.get(host[at + 1:], [])
            at = host.find(".", at + 1)
        return sorted(found, key=lambda r: (-len(text_of(r)), -len(r[1])))

    def fit(self, hosts: list[str], paths: list[str]) -> list[Rule | None]:
        known = {h: self.of_host(h) for h in set(hosts)}
        return [next((r for r in known[h] if p.startswith(r[2])), None) for h, p in zip(hosts, paths)]


def _grams(texts: list[str], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of all n-grams inside one text."""
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    chars = np.where((chars >= 48) & (chars <= 57), np.uint32(48), chars)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    sums = _POLY.prefix(vec.mix(chars.astype(np.uint64) + np.uint64(seed)))
    who, what = [], []
    for n in range(SHORTEST, LONGEST + 1):
        at = np.arange(max(len(chars) - n + 1, 0))
        at = at[owner[at] == owner[at + n - 1]]
        who.append(owner[at])
        what.append((_POLY.spans(sums, at, at + n) % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(who), np.concatenate(what)


def features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value): each part's n-grams, scaled to unit length."""
    out = []
    for part, texts in enumerate(([f"^{h}$" if h else "" for h in hosts], paths)):
        who, what = _grams(texts, _SEEDS[part])
        key, count = np.unique(who * BUCKETS + what, return_counts=True)
        who = key // BUCKETS
        total = np.bincount(who, count, len(texts))
        out.append((who, key % BUCKETS + part * BUCKETS, np.sqrt(count / total[who])))
    return tuple(np.concatenate(c) for c in zip(*out))


@dataclass
class Model:
    bias: float
    w: np.ndarray  # 2 x BUCKETS

    def scores(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """Probability of being blocked."""
        who, what, value = features(hosts, paths)
        margin = self.bias + np.bincount(who, self.w[what] * value, len(hosts))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def learn(hosts: list[str], paths: list[str], y: np.ndarray) -> Model:
    """Logistic loss with a quadratic penalty, whole-table gradient steps scaled
    by each weight's gradients so far."""
    m = Model(0.0, np.zeros(2 * BUCKETS))
    if not len(y):
        m.bias = -30.0
        return m
    m.bias = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    who, what, value = features(hosts, paths)
    seen = np.full(2 * BUCKETS, 1e-3)
    for _ in range(STEPS):
        margin = m.bias + np.bincount(who, m.w[what] * value, len(y))
        g = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) / len(y)
        dw = np.bincount(what, g[who] * value, 2 * BUCKETS) + DECAY * m.w
        seen += dw * dw
        m.w -= RATE * dw / np.sqrt(seen)
    return m


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of a table (url, blocked)."""
    rows = labelled.filter(F.col("url").isNotNull() & F.col("blocked").isNotNull()).groupBy("url").agg(
        (F.avg(F.col("blocked").cast("double")) >= 0.5).cast("int").alias("y"))
    got = rows.orderBy(F.xxhash64("url"), "url").limit(sample) \
        .select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "y").collect()
    return learn([r["host"] for r in got], [r["path"] for r in got], np.array([r["y"] for r in got], float))


def judge(pages: DataFrame, model: Model, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, p_block) of every row of ``pages``."""
    kind = "page_id long, host string, path string, rule string, verdict string, p_block double"
    shared = pages.sparkSession.sparkContext.broadcast((list(rules), model.bias, model.w))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, bias, w = shared.value
        book, m = RuleBook(given), Model(bias, w)
        for batch in batches:
            # slices of about 1 MB of paths, so that n-gram arrays stay bounded
            for rows, _, _ in vec.slices(iter([batch]), "path"):
                hosts, paths = rows.column("host").to_pylist(), rows.column("path").to_pylist()
                p = m.scores(hosts, paths)
                found = book.fit(hosts, paths)
                verdict = [r[0] if r else "block" if x >= 0.5 else "allow" for r, x in zip(found, p.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("page_id"), rows.column("host"), rows.column("path"),
                     pa.array([r and text_of(r) for r in found], pa.string()), pa.array(verdict, pa.string()),
                     pa.array(p, pa.float64())], names=["page_id", "host", "path", "rule", "verdict", "p_block"])
    url = F.col("url").cast("string")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"),
                        path_of(url).alias("path")).mapInArrow(run, kind)
