import uuid

import pytest
from pyspark.sql import functions as F

from siftweb.sources import bucketstore, nodestore

COLS = ("id long, url string, n_urls long, content array<string>, out_links array<string>, "
        "language string, importance double, title string, content_hash string")


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*nodestore.NODE_COLUMNS).collect())


def stored(spark, n=40, buckets=4):
    table = f"store_{uuid.uuid4().hex[:12]}"
    batch = spark.range(1, n + 1).select(
        "id", F.format_string("u%d", "id").alias("url"), F.lit(1).cast("long").alias("n_urls"),
        F.array(F.lit("text")).alias("content"), F.array().cast("array<string>").alias("out_links"), F.lit("de").alias("language"),
        F.lit(-1.0).alias("importance"), F.lit("t").alias("title"), F.format_string("h%d", "id").alias("content_hash"))
    return table, bucketstore.save(spark, table, batch, clear=True, buckets=buckets), batch


CHANGES = [(2, "u2", 1, None, [], "de", 0.5, "t2", "h2"), (2, "v2", 1, ["x"], [], None, 0.1, "t2", "h0"),
           (99, "not stored", 1, None, [], "de", 0.5, "t", "h"),
           (None, "new", 1, ["c"], [], "en", -1.0, "t3", "h3"), (None, None, 1, None, None, None, None, None, "h4")]


def test_same_rows_as_the_plain_upsert(spark):
    table, store, batch = stored(spark)
    changes = spark.createDataFrame(CHANGES, COLS)
    want = rows_of(nodestore.upsert(batch, changes))
    got = bucketstore.save(spark, table, changes)
    assert rows_of(got) == want and len(want) == 42
    assert bucketstore.bucket_count(spark, table) == 4
    assert rows_of(bucketstore.save(spark, table, spark.createDataFrame([], COLS))) == want
    assert rows_of(bucketstore.save(spark, table, batch.limit(0), clear=True)) == []


def test_store_side_is_not_shuffled(spark):
    _, store, batch = stored(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = nodestore.upsert(store, batch.withColumn("content", F.lit(None).cast("array<string>")), buckets=4)
        plan = merged._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = next(i for i, line in enumerate(plan) if "Bucketed: true" in line)
    depth = len(plan[scan]) - len(plan[scan].lstrip(" :+-"))
    above = []
    for line in reversed(plan[:scan]):
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            depth = at
            above.append(line)
    assert any("SortMergeJoin" in line for line in above)
    assert not any("Exchange" in line for line in above)


def test_failed_write_leaves_the_table(spark):
    table, store, _ = stored(spark)
    before = rows_of(store)
    broken = spark.createDataFrame(CHANGES[:1], COLS).withColumn("title", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception):
        bucketstore.save(spark, table, broken)
    assert rows_of(spark.table(table)) == before


def test_switch_cut_off_between_the_renames(spark):
    table, store, _ = stored(spark)
    before = rows_of(store)
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__last")
    bucketstore.recover(spark, table)
    assert rows_of(spark.table(table)) == before
    spark.sql(f"CREATE TABLE {table}__last AS SELECT 1 AS x")
    bucketstore.recover(spark, table)
    assert rows_of(spark.table(table)) == before and not spark.catalog.tableExists(f"{table}__last")


def test_table_without_buckets_raises(spark):
    table = f"plain_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE TABLE {table} AS SELECT 1 AS id")
    with pytest.raises(ValueError):
        bucketstore.bucket_count(spark, table)
