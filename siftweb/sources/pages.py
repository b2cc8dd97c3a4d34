"""Page sources (S1): fetched pages as a ``pages(page_id, url, html)`` table.

Pages may come as a table in any format Spark reads, or as a folder of raw
HTML files (one file per page, the file URI standing in for the page URL
unless a url column is supplied).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftweb.functions.charset import text_of

PAGE_COLUMNS = ["page_id", "url", "html"]


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A pages table stored as parquet / orc / json / csv / avro."""
    reader = spark.read.format(fmt).options(**options)
    if fmt == "json":
        reader = reader.schema("page_id BIGINT, url STRING, html STRING")
    return reader.load(path).select(*PAGE_COLUMNS)


def decode_pages(raw: DataFrame, content_type: str | None = None) -> DataFrame:
    """Pages from ``raw(page_id, url, content BINARY)``: each page's own charset
    is found in its bytes (see ``functions.charset``), or in the column of HTTP
    content types named by ``content_type``.  Null bytes give a null page."""
    header = F.col(content_type) if content_type else None
    return raw.select("page_id", "url", text_of(F.col("content"), header).alias("html"))


def read_html_files(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """One page per file under ``path`` (globs allowed).

    ``binaryFile`` reads each file whole; the bytes are decoded with the charset
    found in each file, or with ``encoding``.  page_id is a 64-bit hash of the file path (stable across
    runs, no global numbering); url is the file path.
    """
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.xxhash64("path").alias("page_id"),
        F.col("path").alias("url"),
        (F.decode(F.col("content"), encoding) if encoding else text_of(F.col("content"))).alias("html"))
