"""The node store as a bucketed catalog table.

The table is bucketed by id, with one file per bucket and write.  An upsert
deals its updates to the same buckets, so the store is joined where it lies:
no Exchange on its side, whatever its size, and the kept rows are written
bucket by bucket as they come.  Only the batch is shuffled.

The new table is written whole beside the old one, under a name of its own, and
two renames put it in its place.  A write that fails leaves the old table as it
was; ``recover`` (called by every ``save``) takes back a switch that was cut off
between the renames.  One writer at a time: the catalog has no lock.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftweb.sources.nodestore import NODE_COLUMNS, new_store, upsert

#: Default buckets of a new table.  Choose them so that a bucket (store size /
#: buckets) is a task's worth of rows; an upsert keeps the table's number.
BUCKETS = 64


def bucket_count(spark: SparkSession, table: str) -> int:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == "Num Buckets").first()
    if described is None:
        raise ValueError(f"{table} is not bucketed")
    return int(described["data_type"])


def _last(table: str) -> str:
    return f"{table}__last"


def recover(spark: SparkSession, table: str) -> None:
    """The table as it was before a ``save`` that did not end."""
    last = _last(table)
    if spark.catalog.tableExists(last) and not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {last} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {last}")


def save(spark: SparkSession, table: str, batch: DataFrame, clear: bool = False,
         order_by: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Clear, or upsert into the table if it is there; the table after it.
    ``buckets`` is for a new or cleared table."""
    recover(spark, table)
    following = f"{table}__{uuid.uuid4().hex[:12]}"
    old = spark.catalog.tableExists(table)
    if old and not clear:
        buckets = bucket_count(spark, table)
        rows = upsert(spark.table(table), batch, order_by, buckets)
    else:
        rows = new_store(batch, order_by).repartition(buckets, "id")
    rows.select(*NODE_COLUMNS).write.bucketBy(buckets, "id").sortBy("id").saveAsTable(following)
    if old:
        spark.sql(f"ALTER TABLE {table} RENAME TO {_last(table)}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {_last(table)}")
    return spark.table(table)
