"""Content dedup and crawl bookkeeping.

Pages with equal content become one node.  The node keeps the fields of
its first page (smallest page_id) and every URL goes to the alias table,
so a content hash shared by a third of all pages is still a partial
aggregation (min, count) plus a skew-split join, never one huge row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftweb.operators.nodes import NODE_COLUMNS


def merge_duplicates(page_nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, aliases).

    ``page_nodes`` is the page-level node table (id = page_id), best a
    written table: it is read once for the hashes and once for the fields.
    Page ids are unique.  Nodes get
    the id and fields of the first page with that content; ``n_urls`` counts
    all its pages.  ``aliases(url, node_id, page_id)`` lists every page URL
    with the node it merged into.
    """
    first = page_nodes.groupBy("content_hash").agg(F.min("id").alias("node_id"), F.count(F.lit(1)).alias("n_urls"))
    # Only ids and counts are aggregated; the fields come with the first page.
    canon = first.select("content_hash", "node_id", "n_urls")
    nodes = (page_nodes.drop("n_urls").join(canon.select(F.col("node_id").alias("id"), "n_urls"), "id")
             .select(*NODE_COLUMNS))
    aliases = (page_nodes.select("url", F.col("id").alias("page_id"), "content_hash")
               .join(canon, "content_hash").select("url", "node_id", "page_id"))
    return nodes, aliases


def distinct_links(links: DataFrame, col: str = "link") -> DataFrame:
    """Each (normalized) link handled once."""
    return links.select(F.col(col).alias("url")).distinct()


def site_cap(nodes: DataFrame, max_sites: int) -> DataFrame:
    """D3: keep the first ``max_sites`` nodes (0 = no cap), by id."""
    if max_sites <= 0:
        return nodes
    return nodes.orderBy("id").limit(max_sites)


def crawl_counts(nodes: DataFrame, aliases: DataFrame) -> DataFrame:
    """Sites processed, net size, restart links of total out links.

    One pass over the links: each is marked known/unknown by a left join to
    the distinct alias URLs, then counted with count_if.
    """
    links = nodes.select(F.explode("out_links").alias("url"))
    known = aliases.select("url").distinct().withColumn("known", F.lit(True))
    marked = links.join(known, "url", "left")
    link_stats = marked.agg(
        F.count(F.lit(1)).alias("total_out_links"),
        F.count_if(F.col("known").isNull()).alias("restart_links"),
    )
    node_stats = nodes.agg(F.count(F.lit(1)).alias("net_size"),
                           F.sum("n_urls").alias("sites_processed"))
    return node_stats.crossJoin(link_stats)
