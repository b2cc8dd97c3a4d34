import pytest
from pyspark.sql import functions as F

from siftweb.functions import text as T
from siftweb.operators import dedup as D
from siftweb.operators import nodes as N
from siftweb.sources import fetchlog, nodestore

COLS = "id long, url string, n_urls long, content array<string>, out_links array<string>, " \
       "language string, importance double, title string, content_hash string"


def test_upsert_rules(spark):
    store = spark.createDataFrame([
        (1, "u1", 1, ["old1"], [], "de", -1.0, "t1", "h1"),
        (2, "u2", 1, ["old2"], [], "de", -1.0, "t2", "h2"),
        (3, "u3", 1, ["old3"], [], "de", -1.0, "t3", "h3")], COLS)
    batch = spark.createDataFrame([
        (1, "u1", 1, None, [], "de", 0.5, "t1b", "h1"),            # null content keeps old
        (2, "u2", 1, ["new2"], [], None, 0.25, "t2b", "h2b"),     # replaced, null language taken
        (None, "n1", 1, ["c"], [], "en", -1.0, "tn", "hb"),        # inserted
        (None, "n0", 1, ["d"], [], "en", -1.0, "tm", "ha")], COLS)
    got = {r.id: r for r in nodestore.upsert(store, batch).collect()}
    assert got[1].content == ["old1"] and got[1].importance == 0.5 and got[1].title == "t1b"
    assert got[2].content == ["new2"] and got[2].language is None
    assert got[3].content == ["old3"]
    assert got[4].url == "n0" and got[5].url == "n1"              # ids by content_hash order
    assert sorted(got) == [1, 2, 3, 4, 5]


def test_assign_ids_dense(spark):
    df = spark.range(0, 1000).select(F.col("id").cast("string").alias("k")).repartition(7)
    out = nodestore.assign_ids(df, ["k"], 10).collect()
    ids = sorted(r.id for r in out)
    assert ids == list(range(11, 1011))
    first = {r.k: r.id for r in out}
    assert first[sorted(first)[0]] == 11


def test_pack_roundtrip_and_empty_links(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [])], "id long, content array<string>, out_links array<string>")
    packed = nodestore.pack(df).first()
    assert packed.content == "a<=_|_=>b" and packed.out_links == ""
    back = nodestore.unpack(nodestore.pack(df)).first()
    assert back.content == ["a", "b"] and back.out_links == [""]


def test_merge_duplicates_idempotent(spark):
    pages = spark.createDataFrame([
        (5, "http://b/", "<html><body><p>same</p></body></html>"),
        (3, "http://a/", "<html><body><p>same</p></body></html>"),
        (9, "http://c/", "<html><body><p>other</p></body></html>")], "page_id long, url string, html string")
    nodes, aliases = D.merge_duplicates(N.parse_pages(pages))
    got = {r.id: (r.url, r.n_urls) for r in nodes.collect()}
    assert got == {3: ("http://a", 2), 9: ("http://c", 1)}
    al = sorted((r.url, r.node_id) for r in aliases.collect())
    assert al == [("http://a", 3), ("http://b", 3), ("http://c", 9)]
    again, _ = D.merge_duplicates(nodes)
    assert sorted(r.id for r in again.collect()) == [3, 9]
    counts = D.crawl_counts(nodes, aliases).first()
    assert counts.net_size == 2 and counts.sites_processed == 3


def test_fetch_outcomes(spark):
    log = spark.createDataFrame([(200, ""), (404, "http"), (503, "http"), (None, "timeout"),
                                 (None, "remote_disconnect"), (None, "unencodable_url"), (None, "url_error")],
                                "status int, error_kind string")
    got = [r.outcome for r in fetchlog.fetch_outcomes(log).collect()]
    assert got == ["body", "never", "retry", "retry", "never", "never", "retry"]


def test_language_guess(spark):
    df = spark.createDataFrame([
        ("Gestern haben wir im Garten gearbeitet und danach einen langen Spaziergang "
         "durch den Wald gemacht, bevor es am Abend zu regnen begann.",),
        ("Yesterday we worked in the garden and then took a long walk through the "
         "woods before it started to rain in the evening.",), ("Straße",), ("",)], "t string")
    got = [r.g for r in df.select(T.guess_language(F.col("t")).alias("g")).collect()]
    assert got == ["de", "en", "de", None]
    shares = df.select(*T.letter_shares(F.col("t"))).collect()
    assert shares[2][26] == 0.0          # 'ß' upper-cases to 'SS', never counted
    assert shares[3][0] is None


def test_save_clear_and_upsert(spark):
    import tempfile
    path = tempfile.mkdtemp(prefix="siftweb-store-") + "/nodes"
    first = spark.createDataFrame([
        (None, "u1", 1, ["a"], [], "de", -1.0, "t1", "h1"),
        (None, "u2", 1, ["b"], [], "de", -1.0, "t2", "h2")], COLS)
    stored = nodestore.save(spark, path, first, clear=True)
    assert sorted((r.id, r.url) for r in stored.collect()) == [(1, "u1"), (2, "u2")]
    second = spark.createDataFrame([
        (2, "u2", 1, None, [], "de", 0.5, "t2", "h2"),
        (None, "u3", 1, ["c"], [], "en", -1.0, "t3", "h3")], COLS)
    stored = nodestore.save(spark, path, second)
    rows = {r.id: r for r in stored.collect()}
    assert sorted(rows) == [1, 2, 3] and rows[2].content == ["b"] and rows[2].importance == 0.5
    assert nodestore.scan(spark, path, with_content=False).columns == [
        "id", "url", "n_urls", "out_links", "language", "importance", "title", "content_hash"]
    again = nodestore.save(spark, path, first, clear=True)
    assert again.count() == 2


def test_page_sources(spark):
    import os
    import tempfile

    from siftweb.sources import pages as P
    from tests.conftest import SF001
    src = spark.read.parquet(f"{SF001}/pages.parquet")
    d = tempfile.mkdtemp(prefix="siftweb-pages-")
    src.write.json(f"{d}/json")
    back = P.read_pages(spark, f"{d}/json", "json")
    assert back.count() == src.count()
    os.makedirs(f"{d}/html")
    for r in src.limit(3).collect():
        with open(f"{d}/html/p{r.page_id}.html", "w", encoding="utf-8") as fh:
            fh.write(r.html)
    files = P.read_html_files(spark, f"{d}/html/*.html")
    nodes = N.parse_pages(files).collect()
    assert len(nodes) == 3 and all(n.title for n in nodes)


def test_ids_are_dense_on_wide_rows(spark):
    """Rows and partition counts come from one shuffle, AQE on or off."""
    wide = spark.range(300_000).select(F.xxhash64("id").alias("k"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 8).alias("pad"))
    try:
        for aqe in ("true", "false"):
            spark.conf.set("spark.sql.adaptive.enabled", aqe)
            got = nodestore.assign_ids(wide, ["k"], 5)
            s = got.agg(F.count_distinct("id").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).first()
            assert (s.n, s.lo, s.hi) == (300_000, 6, 300_005)
        first = got.orderBy("id").select("k").limit(3).collect()
        assert first == wide.orderBy("k").select("k").limit(3).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_save_mixed_and_repeated_ids(spark):
    from siftweb.session import scratch_path
    path = scratch_path(spark, "test-save") + "/nodes"
    batch = spark.createDataFrame([
        (1, "a", 1, ["x"], [], "de", -1.0, "t", "h1"), (7, "b", 1, ["y"], [], "de", -1.0, "t", "h2"),
        (None, "c", 1, ["z"], [], "de", -1.0, "t", "h3")], COLS)
    assert sorted(r.id for r in nodestore.save(spark, path, batch, clear=True).collect()) == [1, 7, 8]
    twice = spark.createDataFrame([
        (7, "b1", 1, ["new"], [], "en", 0.1, "t1", "h4", 1), (7, "b2", 1, None, [], "en", 0.2, "t2", "h2", 2)], COLS + ", seq int")
    rows = [r for r in nodestore.save(spark, path, twice, order_by="seq").collect() if r.id == 7]
    assert [(r.url, r.content, r.importance) for r in rows] == [("b2", ["new"], 0.2)]


def test_unreadable_store_raises(spark):
    from siftweb.session import scratch_path
    path = scratch_path(spark, "test-broken") + "/nodes"
    spark.createDataFrame([("not a node",)], "x string").write.text(path)
    batch = spark.createDataFrame([(None, "u1", 1, ["a"], [], "de", -1.0, "t1", "h1")], COLS)
    with pytest.raises(Exception):
        nodestore.save(spark, path, batch)
    assert spark.read.text(path).count() == 1
