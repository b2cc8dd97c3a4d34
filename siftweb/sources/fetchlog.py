"""Fetch outcomes.

Pages arrive already fetched (``pages`` table, or a stream of files).  A
fetch log ``(url, status, error_kind)`` is classified the way the crawler
treated download results: a body, a retry later, or never again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Error kinds that mean "never again"; every other failure
# is retried.
NEVER_KINDS = ["remote_disconnect", "unencodable_url"]

# How the demo maps the events table to fetch results,
# event_type -> (status, error_kind).
EVENT_FETCH_MAP = {
    "view": (200, ""),
    "click": (200, ""),
    "purchase": (404, "http"),
    "signup": (503, "http"),
    "error": (None, "timeout"),
}


def classify(status: Column, error_kind: Column) -> Column:
    """S2: 'body' | 'never' | 'retry'."""
    kind = F.coalesce(error_kind, F.lit(""))
    return (
        F.when(kind.isin(NEVER_KINDS), F.lit("never"))
        .when(kind == "timeout", F.lit("retry"))
        .when((F.floor(status / 100) == 4), F.lit("never"))
        .when((kind == "") & status.between(200, 399), F.lit("body"))
        .otherwise(F.lit("retry"))
    )


def events_as_fetch_log(events: DataFrame, *keep: str) -> DataFrame:
    """Stand-in fetch log from the events table (one fetch per event), with the columns ``keep``."""
    status = F.lit(None).cast("int")
    kind = F.lit(None).cast("string")
    for et, (st, ek) in EVENT_FETCH_MAP.items():
        status = F.when(F.col("event_type") == et, F.lit(st).cast("int")).otherwise(status)
        kind = F.when(F.col("event_type") == et, F.lit(ek)).otherwise(kind)
    return events.select(
        "event_id",
        F.concat(F.lit("http://user"), F.col("user_id").cast("string"), F.lit(".example.org/")).alias("url"),
        status.alias("status"), kind.alias("error_kind"), *keep)


def fetch_outcomes(fetch_log: DataFrame) -> DataFrame:
    return fetch_log.withColumn("outcome", classify(F.col("status"), F.col("error_kind")))
