"""Link graph building (G1-G11) as joins and aggregations.

Every operator is a DataFrame -> DataFrame step.  Lookups that the
crawler did with in-memory dictionaries are equi-joins here; Spark picks
broadcast or sort-merge at run time (AQE), and splits skewed partitions
(a hub page linked from a third of the web stays a partial aggregation
plus a skew-split join, never one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftweb.functions.urls import LinkConstraint
from siftweb.session import scratch_path


def explode_links(nodes: DataFrame, id_col: str = "id") -> DataFrame:
    """G1: one row per out link: (src, pos, link)."""
    return nodes.select(F.col(id_col).alias("src"),
                        F.posexplode("out_links").alias("pos", "link"))


def node_aliases(nodes: DataFrame, id_col: str = "id") -> DataFrame:
    """All (url, node_id) pairs of page-level nodes (one URL per node)."""
    return nodes.select("url", F.col(id_col).alias("node_id"))


def url_index(aliases: DataFrame) -> DataFrame:
    """Url -> node; when two nodes claim one URL the later (larger id)
    wins.  ``max`` aggregates partially on the map side, so a URL claimed by
    millions of rows is still a cheap reduce."""
    return aliases.groupBy("url").agg(F.max("node_id").alias("node_id"))


def resolve_links(links: DataFrame, index: DataFrame) -> DataFrame:
    """Link -> target node; links to unknown URLs are dropped."""
    return (links.join(index, links["link"] == index["url"], "inner")
            .select("src", "pos", "link", F.col("node_id").alias("dst")))


def find_by_content_hash(nodes: DataFrame, probes: DataFrame) -> DataFrame:
    """For each probe content_hash, the first node (smallest id) with it."""
    first = nodes.groupBy("content_hash").agg(F.min("id").alias("node_id"))
    return probes.join(first, "content_hash", "left")


def out_counts(resolved: DataFrame) -> DataFrame:
    """Resolved out-link count per node, duplicates and self-links counted."""
    return resolved.groupBy("src").agg(F.count(F.lit(1)).alias("out_count"))


def weighted_edges(resolved: DataFrame) -> DataFrame:
    """One edge per distinct (src, dst), weight 1/out_count.

    Duplicate links raise out_count but add one edge only, so a row can sum
    to less than 1 (kept on purpose; rank renormalizes every step).
    """
    per_pair = resolved.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    counts = per_pair.groupBy("src").agg(F.sum("n").alias("out_count"))
    return (per_pair.join(counts, "src")
            .select("src", "dst", (F.lit(1.0) / F.col("out_count")).alias("weight")))


def dangling_nodes(nodes: DataFrame, edges: DataFrame, id_col: str = "id") -> DataFrame:
    """Nodes without any resolved out link."""
    return nodes.join(edges.select(F.col("src").alias(id_col)).distinct(), id_col, "left_anti")


def frontier(nodes: DataFrame, aliases: DataFrame) -> DataFrame:
    """Valid out links whose URL is not known yet (restart links).

    Links are made distinct first (map-side combine), so a URL linked from
    a third of all pages is one row per task before the anti join."""
    links = explode_links(nodes).select(F.col("link").alias("url")).distinct()
    return links.join(aliases.select("url"), "url", "left_anti")


def shared_url_groups(aliases: DataFrame) -> DataFrame:
    """Nodes that share a URL, as (url, node_id, same_as): one row per URL
    and node, same_as the URL's smallest node, for URLs of several nodes.
    Linear in the aliases and lossless: two nodes share a URL if and only if
    they have rows of that URL."""
    first = aliases.groupBy("url").agg(F.min("node_id").alias("same_as"), F.max("node_id").alias("last")) \
        .filter("same_as < last").drop("last")
    return aliases.select("url", "node_id").distinct().join(first, "url")


def with_ids(nodes: DataFrame) -> DataFrame:
    """Only nodes with an id take part in ranking."""
    return nodes.filter(F.col("id").isNotNull())


def page_graph(nodes: DataFrame, keep_unfetched: bool = False):
    """Graph over page-level nodes.

    Returns (vertices(id), resolved links(src, pos, link, dst)).  With
    ``keep_unfetched`` every link target is a vertex keyed by its URL
    (ids are URLs then); otherwise ids are node ids and links to pages not
    in the table are dropped (G3).
    """
    nodes = with_ids(nodes)
    links = explode_links(nodes)
    if keep_unfetched:
        vertices = (nodes.select(F.col("url").alias("id"))
                    .union(links.select(F.col("link").alias("id"))).distinct())
        # The source URL is on the same row as its links: no join needed.
        resolved = (nodes.select(F.col("url").alias("src"),
                                 F.posexplode("out_links").alias("pos", "link"))
                    .withColumn("dst", F.col("link")))
        return vertices, resolved
    index = url_index(node_aliases(nodes))
    return nodes.select("id"), resolve_links(links, index)


def supplier_part_graph(lineitem: DataFrame):
    """A graph with cycles and duplicate edges from lineitem: supplier <->
    part for every line, both directions from one scan.
    Returns (vertices(id), resolved links(src, dst)) with string ids."""
    s = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    p = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    ends = F.array(F.struct(s.alias("src"), p.alias("dst")), F.struct(p.alias("src"), s.alias("dst")))
    resolved = lineitem.select(F.explode(ends).alias("e")).select("e.src", "e.dst")
    vertices = resolved.select(F.col("src").alias("id")).distinct()
    return vertices, resolved


def reachability(spark: SparkSession, edges: DataFrame, start: DataFrame,
                 max_depth: int | None = None, max_sites: int = 0,
                 constraint: LinkConstraint | None = None) -> DataFrame:
    """Breadth-first reach from ``start(id)`` over ``edges(src, dst)``.

    Each vertex is reported once with its smallest depth.  One level per
    driver iteration: frontier join edges, minus everything visited.  Edges
    and levels are Parquet folders under the shared checkpoint folder, one
    folder per level, so nothing is written twice, lineage stays short and a
    lost executor recomputes one level only; both sides of each join are
    shuffled from files, so the planner can split a hub's edges.
    ``constraint`` normalizes URL ids at the start and drops those that it
    does not accept (the start rules of a crawl).  ``max_sites`` > 0 caps the
    crawl: the level that crosses the cap keeps its smallest ids only (a top-n
    on that level, the cap being the feature).
    """
    path = scratch_path(spark, "reach")
    edges.select("src", "dst").distinct().write.parquet(f"{path}/edges")
    adj = spark.read.parquet(f"{path}/edges")
    first = start.select("id").distinct()
    if constraint is not None:
        first = constraint_start(first, constraint)
    first.withColumn("depth", F.lit(0)).write.parquet(f"{path}/levels/level=0")
    depth = 0
    while max_depth is None or depth < max_depth:
        visited = spark.read.parquet(f"{path}/levels")
        current = visited.filter(F.col("level") == depth)
        depth += 1
        nxt = (current.select(F.col("id").alias("src"))
               .join(adj, "src")
               .select(F.col("dst").alias("id")).distinct()
               .join(visited.select("id"), "id", "left_anti"))
        if max_sites > 0:
            room = max_sites - visited.count()
            if room <= 0:
                break
            nxt = nxt.orderBy("id").limit(room)
        level = f"{path}/levels/level={depth}"
        nxt.withColumn("depth", F.lit(depth)).write.parquet(level)
        if spark.read.parquet(level).isEmpty():
            break
    visited = spark.read.parquet(f"{path}/levels").select("id", "depth")
    return visited.orderBy("depth", "id").limit(max_sites) if max_sites > 0 else visited


def constraint_start(start: DataFrame, constraint: LinkConstraint) -> DataFrame:
    """Start URLs as the crawl takes them up: accepted, normalized, distinct."""
    return start.filter(constraint.accepts(F.col("id"))).select(constraint.normalize(F.col("id")).alias("id")) \
        .filter("id is not null").distinct()
