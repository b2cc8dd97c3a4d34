"""Node store on Parquet.

The store is a Parquet dataset with the node layout of
``operators.nodes``; lists are real arrays.  ``pack``/``unpack`` convert
to and from the separator-joined text layout of the original store.
Upserts are a join plus a union.  ``save`` first writes the whole new
table to a sibling folder, so a failure while it is being computed leaves
the store untouched; only the final copy replaces the store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftweb.operators.nodes import NODE_COLUMNS
from siftweb.session import scratch_path

# Fixed value: the separator joining list items in the packed layout.
SEPARATOR = "<=_|_=>"
_SEP_RE = "\\Q" + SEPARATOR + "\\E"

# Spark numbers the rows of a partition below this many bits.
_PLACE_BITS = 33

PACKED_LIST_COLUMNS = ("content", "out_links")


def scan(spark: SparkSession, path: str, with_content: bool = True) -> DataFrame:
    """Read the store; without content the column is never read
    (Parquet column pruning)."""
    df = spark.read.parquet(path)
    cols = [c for c in NODE_COLUMNS if with_content or c != "content"]
    return df.select(*cols)


def pack(nodes: DataFrame) -> DataFrame:
    """Lists -> separator-joined text (content stays null when null)."""
    out = nodes
    for c in PACKED_LIST_COLUMNS:
        if c in nodes.columns:
            out = out.withColumn(c, F.array_join(F.col(c), SEPARATOR))
    return out


def unpack(packed: DataFrame) -> DataFrame:
    """Separator-joined text -> lists.  Empty out links come back as
    ``['']``, as in the original store."""
    out = packed
    for c in PACKED_LIST_COLUMNS:
        if c in packed.columns:
            out = out.withColumn(c, F.split(F.col(c), _SEP_RE, -1))
    return out


def assign_ids(df: DataFrame, order_cols: list[str], start: int | DataFrame = 0,
               id_col: str = "id") -> DataFrame:
    """Dense ids start+1, start+2, ... in ``order_cols`` order.

    No one-partition window: the rows are range-partitioned by the sort key,
    sorted, and written once with their place (partition, row in it) to the
    shared scratch folder.  The partitions' row counts come from that very
    file, so rows and counts cannot belong to different shuffles; the shift
    by all earlier partitions is a table with one row per partition.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ids")
    placed = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols) \
        .withColumn("_place", F.monotonically_increasing_id())
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path).withColumn("_part", F.shiftright("_place", _PLACE_BITS))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    base = (start.first()[0] or 0) if isinstance(start, DataFrame) else start
    return (placed.join(before, "_part")
            .withColumn(id_col, F.lit(base) + F.col("_before") + F.col("_place")
                        - F.shiftleft("_part", _PLACE_BITS) + 1)
            .drop("_part", "_place", "_before"))


def last_updates(updates: DataFrame, order_by: str | None = None) -> DataFrame:
    """One update per id: the fields of the last row by ``order_by`` (by
    content hash and URL if there is no such column) and the last content
    that is not null."""
    order = F.struct(*([order_by] if order_by else []), "content_hash", "url")
    fields = [c for c in NODE_COLUMNS if c not in ("id", "content")]
    last = updates.groupBy("id").agg(
        F.max_by(F.struct(*fields), order).alias("_f"),
        F.max_by("content", F.when(F.col("content").isNotNull(), order)).alias("content"))
    return last.select("id", "content", "_f.*").select(*NODE_COLUMNS)


def upsert(store: DataFrame, batch: DataFrame, order_by: str | None = None,
           buckets: int | None = None) -> DataFrame:
    """S7 (+S8): rows with an id update that node, taking every field from
    the batch (even nulls) except content, which a null keeps; an id that the
    batch names several times takes the last of its rows; rows without an id
    are inserted with fresh ids after the largest stored id.  With ``buckets``, the
updates (one per id by then) are dealt like a store of so many buckets."""
    cols = NODE_COLUMNS
    updates = last_updates(batch.filter(F.col("id").isNotNull()), order_by)
    if buckets:
        updates = updates.repartition(buckets, "id")
    inserts = batch.filter(F.col("id").isNull())
    old = store.select(*cols)
    upd = updates.select(*[F.col(c).alias("n_" + c) for c in cols])
    merged = old.join(upd, old["id"] == upd["n_id"], "left")
    kept = merged.select(*[
        (F.coalesce(F.col("n_content"), F.col("content")) if c == "content"
         else F.when(F.col("n_id").isNotNull(), F.col("n_" + c)).otherwise(F.col(c))).alias(c)
        for c in cols])
    max_id = store.agg(F.max("id"))
    new_rows = assign_ids(inserts.drop("id"), ["content_hash", "url"], max_id).select(*cols)
    return kept.unionByName(new_rows.repartition(buckets, "id") if buckets else new_rows)


def new_store(batch: DataFrame, order_by: str | None = None) -> DataFrame:
    """The batch alone, rows without an id numbered after the largest id it holds."""
    keep = last_updates(batch.filter(F.col("id").isNotNull()), order_by)
    inserts = batch.filter(F.col("id").isNull()).drop("id")
    fresh = assign_ids(inserts, ["content_hash", "url"], batch.agg(F.max("id")))
    return keep.unionByName(fresh.select(*NODE_COLUMNS))


def exists(spark: SparkSession, path: str) -> bool:
    """The path is there, in whatever file system it names."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def save(spark: SparkSession, path: str, batch: DataFrame, clear: bool = False,
         order_by: str | None = None) -> DataFrame:
    """Clear (the batch alone, rows without an id numbered after the
    largest id it holds) or upsert into the existing store.  The result is
    written to ``path`` and read back.  A store that is there but cannot be
    read raises; only a missing path counts as no store yet."""
    if clear or not exists(spark, path):
        result = new_store(batch, order_by)
    else:
        result = upsert(spark.read.parquet(path), batch, order_by)
    tmp = path.rstrip("/") + ".next"
    result.write.mode("overwrite").parquet(tmp)
    written = spark.read.parquet(tmp)
    written.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
