import os
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from siftweb.operators import dedup as D
from siftweb.operators import nodes as N
from siftweb.streaming import pages_stream as ST
from tests.conftest import SF001


def test_stream_equals_batch(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    src = tempfile.mkdtemp(prefix="siftweb-src-")
    # three arriving files: the stream sees them as separate micro-batches
    parts = pages.withColumn("part", (F.col("page_id") % 3).cast("int"))
    for i in range(3):
        parts.filter(F.col("part") == i).drop("part").coalesce(1).write.parquet(f"{src}/f{i}")
    store, ck = ST.scratch(spark, "test-store"), ST.scratch(spark, "test-ckpt")
    stream = ST.read_pages_stream(spark, f"{src}/f*/*.parquet", max_files_per_trigger=1)
    ST.merge_stream(spark, stream, store, ck)
    s_nodes, s_aliases = ST.read_store(spark, store)
    b_nodes, b_aliases = D.merge_duplicates(N.parse_pages(pages))
    assert sorted(r.content_hash for r in s_nodes.collect()) == sorted(r.content_hash for r in b_nodes.collect())
    assert s_aliases.count() == b_aliases.count()
    # restart on the same checkpoint processes nothing new
    ST.merge_stream(spark, ST.read_pages_stream(spark, f"{src}/f*/*.parquet"), store, ck)
    assert ST.read_store(spark, store)[0].count() == b_nodes.count()
    assert os.path.isdir(store)


def test_entry_and_contract(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["position", "id", "title", "url", "snippet", "title_hits", "content_hits", "importance"]
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 60


def test_store_lookup_prunes_buckets(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    src = tempfile.mkdtemp(prefix="siftweb-src-")
    pages.coalesce(1).write.parquet(f"{src}/f0")
    store, ck = ST.scratch(spark, "prune-store"), ST.scratch(spark, "prune-ckpt")
    ST.merge_stream(spark, ST.read_pages_stream(spark, f"{src}/f*/*.parquet"), store, ck)
    merger = ST.StoreMerger(store, "x")
    df = merger._stored(spark, "none", [3, 7])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan
    rows = df.collect()
    n3_7 = spark.read.parquet(f"{store}/nodes").filter(F.col("bucket").isin(3, 7)).count()
    assert len(rows) == n3_7


def test_store_counts_urls_across_batches_and_compacts(spark):
    html = "<html><body><p>%s</p></body></html>"
    rows = [(1, "http://h/a", html % "same"), (2, "http://h/b/", html % "same"), (3, "http://h/c", html % "other")]
    pages = spark.createDataFrame(rows, ST.PAGES_SCHEMA)
    folder = ST.scratch(spark, "urls-in")
    for r in rows:
        pages.filter(F.col("page_id") == r[0]).coalesce(1).write.mode("append").parquet(folder)
    store = ST.scratch(spark, "urls-store")
    ST.merge_stream(spark, ST.read_pages_stream(spark, folder, max_files_per_trigger=1), store,
                    ST.scratch(spark, "urls-ck"), buckets=4, writers=2)
    before = {r.url: r.n_urls for r in ST.read_store(spark, store)[0].collect()}
    assert sorted(before.values()) == [1, 2]
    ST.compact(spark, store)
    nodes, aliases = ST.read_store(spark, store)
    assert {r.url: r.n_urls for r in nodes.collect()} == before and aliases.count() == 3
    # known URLs are compared in normalized form
    ST.merge_stream(spark, ST.read_pages_stream(spark, folder), store, ST.scratch(spark, "urls-ck2"),
                    known_urls=spark.createDataFrame([(r[1],) for r in rows], "url string"), buckets=4)
    assert ST.read_store(spark, store)[1].count() == 3


def test_known_content_and_a_replay_after_compaction(spark):
    """A micro-batch of known content adds URLs only; a batch replayed after the
    store was compacted adds nothing."""
    html = "<html><body><p>%s</p></body></html>"
    rows = [(1, "http://h/a", html % "same"), (2, "http://h/b", html % "other"), (3, "http://h/c", html % "same"),
            (4, "http://h/d", html % "other")]
    pages = spark.createDataFrame(rows, ST.PAGES_SCHEMA)
    store = ST.scratch(spark, "known-store")
    merge = ST.StoreMerger(store, "run", buckets=4)
    merge(pages.filter("page_id <= 2"), 0)
    merge(pages.filter("page_id > 2"), 1)  # known content alone
    want = {1: ("http://h/a", 2), 2: ("http://h/b", 2)}
    assert {r.id: (r.url, r.n_urls) for r in ST.read_store(spark, store)[0].collect()} == want
    ST.compact(spark, store)
    for epoch in (1, 0):
        merge(pages.filter("page_id > 2" if epoch else "page_id <= 2"), epoch)
    nodes, aliases = ST.read_store(spark, store)
    assert {r.id: (r.url, r.n_urls) for r in nodes.collect()} == want
    assert sorted((r.page_id, r.node_id) for r in aliases.collect()) == [(1, 1), (2, 2), (3, 1), (4, 2)]
    merge(pages.limit(0), 2)  # an empty micro-batch
    assert ST.read_store(spark, store)[1].count() == 4


def test_dedup_within_watermark(spark):
    from siftweb.plans import catalog as C
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    src = tempfile.mkdtemp(prefix="siftweb-docs-")
    docs.coalesce(1).write.parquet(f"{src}/d0")
    stream = spark.readStream.schema(docs.schema).parquet(f"{src}/d*/*.parquet")
    nodes = C.doc_nodes(spark, SF001, stream).withColumn(
        "ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60))  # a document a minute
    out, ck = ST.scratch(spark, "wm-out"), ST.scratch(spark, "wm-ckpt")
    ST.run_to_table(ST.dedup_content(nodes, event_time="ts", delay="1 hour")
                    .select("content_hash", "id"), out, ck)
    got = spark.read.parquet(out)
    distinct = C.doc_nodes(spark, SF001).select("content_hash").distinct().count()
    # copies more than an hour apart may both be kept; never fewer than distinct
    assert got.select("content_hash").distinct().count() == distinct
    assert distinct <= got.count() <= docs.count()


def test_arriving_files_follow_the_table(spark):
    from siftweb.plans import catalog
    rows = spark.range(0, 4000, 1, 20).withColumnRenamed("id", "page_id")  # 20 splits
    folder, files = catalog.arriving(spark, rows, "page_id")
    back = spark.read.parquet(folder)
    assert back.count() == 4000 and len(back.inputFiles()) == 20 and files == 5
    small = spark.range(0, 100, 1, 1).withColumnRenamed("id", "page_id")
    folder, files = catalog.arriving(spark, small, "page_id")
    assert len(spark.read.parquet(folder).inputFiles()) == 4 and files == 1


def test_several_files_a_split_fill_a_batch(spark):
    from siftweb.plans import catalog
    rows = spark.range(0, 4000, 1, 20).withColumnRenamed("id", "doc_id")  # 20 splits
    folder, files = catalog.arriving(spark, rows, "doc_id", catalog.FILES_A_SPLIT)
    back = spark.read.parquet(folder)
    assert back.count() == 4000 and len(back.inputFiles()) == 80 and files == 20
