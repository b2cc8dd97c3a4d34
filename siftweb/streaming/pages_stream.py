"""Structured Streaming jobs over arriving pages.

Pages land as files (Parquet) in a folder; the same narrow projection
as the batch path turns them into nodes (T1).  Content and URL dedup keep
"seen" state in the state store (T2, T3); ``foreachBatch`` merges each
micro-batch into the node store (T4); a restarted job resumes from its
checkpoint and skips what the store already holds (T5).  All writes are
idempotent per epoch, so a replayed micro-batch after a failure
overwrites its own output instead of adding rows twice.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftweb.functions.urls import normalize
from siftweb.operators import dedup as D
from siftweb.operators import nodes as N
from siftweb.session import scratch_path
from siftweb.sources.nodestore import exists

PAGES_SCHEMA = "page_id BIGINT, url STRING, html STRING"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return scratch_path(spark, name)


def read_pages_stream(spark: SparkSession, path: str, schema: str = PAGES_SCHEMA,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def parse_stream(pages: DataFrame) -> DataFrame:
    """The batch page -> node projection, unchanged, on a stream."""
    return N.parse_pages(pages)


def dedup_content(nodes: DataFrame, event_time: str | None = None,
                  delay: str = "1 hour") -> DataFrame:
    """Drop content already seen.  Without an event-time column the state
    is unbounded (every hash ever seen); with one, state older than the
    watermark is dropped."""
    if event_time:
        return (nodes.withWatermark(event_time, delay)
                .dropDuplicatesWithinWatermark(["content_hash"]))
    return nodes.dropDuplicates(["content_hash"])


def dedup_links(nodes: DataFrame) -> DataFrame:
    """Each out-link URL reported once across the whole stream."""
    links = nodes.select(F.explode("out_links").alias("url"))
    return links.dropDuplicates(["url"])


def run_to_table(df: DataFrame, out: str, ckpt: str, mode: str = "append") -> None:
    """Run a streaming frame over everything available, into Parquet."""
    q = (df.writeStream.format("parquet").outputMode(mode)
         .option("checkpointLocation", ckpt).option("path", out)
         .trigger(availableNow=True).start())
    q.awaitTermination()


#: Defaults of the store's layout.  Choose the buckets so that one of them
#: (store size / buckets) is a task's worth of hashes, and the writers so that
#: buckets * writers tasks write a micro-batch.
STORE_BUCKETS, BUCKET_WRITERS = 64, 1


def hash_bucket(col: str = "content_hash", buckets: int = STORE_BUCKETS):
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")


class StoreMerger:
    """T4: foreachBatch sink merging each micro-batch into the node store.

    Layout: ``{store}/nodes/batch=R-N/bucket=B`` and
    ``{store}/aliases/batch=R-N``, where R names the job (its checkpoint),
    N is the micro-batch id and B a hash bucket of the content hash.  A
    batch adds nodes only for content the store does not hold yet (the
    first page wins, as in batch D1); every page URL goes to the aliases,
    pointing at the stored or the new node.  The lookup of stored content
    reads only the buckets the batch's pages fall into (directory pruning),
    so a small micro-batch does not scan the whole store.  A replayed
    micro-batch overwrites its own folders and ignores them when looking up
    stored content; one that ``compact`` has taken in since is skipped.
    """

    def __init__(self, store: str, run: str, buckets: int = STORE_BUCKETS, writers: int = BUCKET_WRITERS):
        self.store = store.rstrip("/")
        self.run = run
        self.buckets, self.writers = buckets, writers

    def _stored(self, spark: SparkSession, skip: str, buckets: list[int]) -> DataFrame | None:
        if not exists(spark, f"{self.store}/nodes"):
            return None
        df = spark.read.parquet(f"{self.store}/nodes")
        return (df.filter((F.col("batch") != skip) & F.col("bucket").isin(buckets))
                .select("content_hash", F.col("id").alias("node_id")))

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        tag = f"{self.run}-{epoch:010d}"
        if exists(spark, f"{self.store}/done/{tag}"):  # complete, and compacted since
            return
        page_nodes = (N.parse_pages(batch)
                      .withColumn("bucket", hash_bucket(buckets=self.buckets)).persist())
        buckets = [r["bucket"] for r in page_nodes.select("bucket").distinct().collect()]
        if not buckets:
            page_nodes.unpersist()
            return
        stored = self._stored(spark, tag, buckets)
        fresh = page_nodes.drop("bucket")
        if stored is not None:
            fresh = fresh.join(stored.select("content_hash"), "content_hash", "left_anti")
        nodes, _ = D.merge_duplicates(fresh)
        # ``writers`` files per bucket folder: rows are clustered by bucket and salt first.
        (nodes.withColumn("bucket", hash_bucket(buckets=self.buckets))
         .repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(self.writers)))
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.store}/nodes/batch={tag}"))
        # With its schema: a batch of known content alone adds no node and leaves no file to read one from.
        known = spark.read.schema(nodes.schema).parquet(f"{self.store}/nodes/batch={tag}").select(
            "content_hash", F.col("id").alias("node_id"))
        if stored is not None:
            known = known.unionByName(stored)
        aliases = (page_nodes.select("url", F.col("id").alias("page_id"), "content_hash")
                   .join(known, "content_hash").select("url", "node_id", "page_id"))
        aliases.write.mode("overwrite").parquet(f"{self.store}/aliases/batch={tag}")
        page_nodes.unpersist()


def merge_stream(spark: SparkSession, pages: DataFrame, store: str, ckpt: str,
                 known_urls: DataFrame | None = None, buckets: int = STORE_BUCKETS,
                 writers: int = BUCKET_WRITERS) -> None:
    """T4/T5: run the store merge over everything available.

    ``known_urls`` (the aliases of a store being resumed) removes pages
    already processed before they are parsed (stream-static anti join); both
    sides are normalized here, as nodes' URLs are."""
    if known_urls is not None:
        known = known_urls.select(normalize(F.col("url")).alias("_known")).distinct()
        pages = pages.join(known, normalize(F.col("url")) == F.col("_known"), "left_anti")
    run = hashlib.sha1(ckpt.encode()).hexdigest()[:10]
    q = (pages.writeStream.foreachBatch(StoreMerger(store, run, buckets, writers))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()


def read_store(spark: SparkSession, store: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, aliases).  ``n_urls`` is counted from the aliases, for a later
    micro-batch may add URLs to a node that an earlier one wrote."""
    aliases = spark.read.parquet(f"{store.rstrip('/')}/aliases").drop("batch")
    counts = aliases.groupBy(F.col("node_id").alias("id")).agg(F.count(F.lit(1)).alias("n_urls"))
    nodes = spark.read.parquet(f"{store.rstrip('/')}/nodes").drop("batch", "bucket", "n_urls").join(counts, "id")
    return nodes.select(*N.NODE_COLUMNS), aliases


def compact(spark: SparkSession, store: str, files_per_bucket: int = BUCKET_WRITERS) -> None:
    """Put all micro-batches of a store into one folder.  Run it while no
    stream writes.  The new folder is complete before the old ones go; a crash
    in between leaves rows twice, which running it again mends (rows are
    distinct by id and by alias).  Complete micro-batches are marked under
    ``{store}/done``, so that a replay of one adds nothing."""
    root = store.rstrip("/")
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for table, key in (("nodes", ["id"]), ("aliases", ["page_id"])):
        path = Path(f"{root}/{table}")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        old = [f.getPath() for f in fs.listStatus(path) if f.getPath().getName().startswith("batch=")]
        rows = spark.read.parquet(f"{root}/{table}").drop("batch").dropDuplicates(key)
        tag = f"compact-{scratch_path(spark, 'x').rsplit('-', 1)[1]}"
        if table == "nodes":
            rows = rows.repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(files_per_bucket)))
            rows.write.partitionBy("bucket").parquet(f"{root}/{table}/batch={tag}")
        else:
            rows.write.parquet(f"{root}/{table}/batch={tag}")
        for p in old:
            if table == "aliases" and fs.exists(Path(p, "_SUCCESS")):  # what a micro-batch writes last
                fs.create(Path(f"{root}/done/{p.getName().removeprefix('batch=')}"), True).close()
        for p in old:
            fs.delete(p, True)
