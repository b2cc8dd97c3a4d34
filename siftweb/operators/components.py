"""Connected components of a links table, and merging nodes over them.

``components`` contracts the links by alternating large and small stars until
they are stars around each component's smallest id.  Every step is joins and
partial aggregations over links, never over a component, so a hub that a third
of all rows share is one pre-aggregated minimum.  A chain of n nodes takes
about log n rounds.  Each round is written under the shared scratch folder,
which cuts the lineage; what reaches the driver is one checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftweb.session import scratch_path


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every id that a link names; the component is its
    smallest id.  Null ends link nothing; self-links name their id."""
    spark = links.sparkSession
    path, step = scratch_path(spark, "components"), 0

    def written(df: DataFrame) -> DataFrame:
        nonlocal step
        step += 1
        df.write.parquet(f"{path}/{step}")
        return spark.read.schema(df.schema).parquet(f"{path}/{step}")

    ends = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull())
    every = written(ends.distinct())
    edges, seen = every.filter("hi <> lo"), None
    while True:
        # Large star: each id's larger neighbours go to its smallest one (or itself).
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select("hi", F.least("hi", "m").alias("m"))
        large = written(both.join(least, "hi").filter("lo > hi")
                        .select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct())
        # Small star: each id and its smaller neighbours go to the smallest of them.
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = written(small.unionByName(low.select("hi", F.col("m").alias("lo"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    ids = every.select(F.col("hi").alias("id")).unionByName(every.select(F.col("lo").alias("id"))).distinct()
    return ids.join(edges.select(F.col("hi").alias("id"), F.col("lo").alias("component")), "id", "left") \
        .select("id", F.coalesce("component", "id").alias("component"))


def merge_by_urls(urls: DataFrame) -> DataFrame:
    """(node_id, component): nodes that share any URL are one, also over others.

    ``urls(url, node_id)``.  Each URL links its nodes to the smallest of them, a
    link a row; null URLs link nothing, and null node ids are left out."""
    known = urls.filter(F.col("node_id").isNotNull()).select("url", "node_id")
    first = known.filter(F.col("url").isNotNull()).groupBy("url").agg(F.min("node_id").alias("a"))
    links = known.join(first, "url", "left").select(F.coalesce("a", "node_id").alias("a"), F.col("node_id").alias("b"))
    return components(links).select(F.col("id").alias("node_id"), "component")
