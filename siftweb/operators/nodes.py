"""Pages -> nodes (P12, P13): one projection over the pages table.

Node layout (one row per node, no unbounded arrays):

    id BIGINT, url STRING (first URL), n_urls BIGINT, content ARRAY<STRING>,
    out_links ARRAY<STRING>, language STRING, importance DOUBLE (-1 = unranked),
    title STRING, content_hash STRING

Every URL a node is known under lives in a separate alias table
``aliases(url, node_id, page_id)`` (see ``dedup.merge_duplicates``), so a
node that collects many URLs never turns into one huge row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftweb.functions import html as H
from siftweb.functions.urls import LinkConstraint, resolve_all

UNRANKED = -1.0

NODE_COLUMNS = ["id", "url", "n_urls", "content", "out_links", "language",
                "importance", "title", "content_hash"]


def valid_pages(pages: DataFrame) -> DataFrame:
    """Keep pages that are HTML documents with a body."""
    return pages.filter(H.is_valid_html(H.clean_html(F.col("html"))))


def parse_pages(pages: DataFrame, constraint: LinkConstraint | None = None,
                strict_script_links: bool = True) -> DataFrame:
    """One node row per valid page (id = page_id, one URL).

    Narrow transformations only: no shuffle, so it runs wherever the page
    scan runs and streams unchanged (T1).
    """
    constraint = constraint or LinkConstraint()
    # Cleaned once; validity, segments, title and anchors read that column.
    staged = (pages.select("page_id", "url", "html", H.clean_html(F.col("html")).alias("_clean"))
              .filter(H.is_valid_html(F.col("_clean"))))
    links = H.raw_links(F.col("html"), F.col("_clean"), strict_script_links)
    nodes = staged.select(
        F.col("page_id").alias("id"),
        constraint.normalize(F.col("url")).alias("url"),
        F.lit(1).cast("bigint").alias("n_urls"),
        H.segments(F.col("_clean")).alias("content"),
        constraint.valid_links(resolve_all(F.col("url"), links)).alias("out_links"),
        H.language(F.col("_clean")).alias("language"),
        F.lit(UNRANKED).alias("importance"),
        H.title(F.col("_clean")).alias("title"),
    )
    return nodes.withColumn("content_hash", H.content_hash(F.col("content")))


def node_validity(nodes: DataFrame):
    """A node needs a URL, and an id or some content."""
    return F.col("url").isNotNull() & (
        F.col("id").isNotNull()
        | (F.col("content").isNotNull() & (F.size("content") > 0)))


def split_valid(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid nodes, quarantined nodes)."""
    ok = node_validity(nodes)
    return nodes.filter(ok), nodes.filter(~ok | ok.isNull())
