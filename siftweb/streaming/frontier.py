"""Crawl frontier with retries, as keyed stream state.

Fetches arrive as a stream ``(url, fetched_at, outcome)``, the outcome being
'body', 'never' or 'retry' (``fetchlog.classify``).  The stream gives back

* for each URL its first 'body' or 'never', once no earlier fetch can arrive:
  such a URL never comes back;
* each 'retry' that is its URL's latest fetch when the delay is over: the URL
  comes back at ``due_us``.  A retry with another one in the delay after it,
  or with a 'body' or 'never' up to its end, does not.

Time is event time: a row is given back when the watermark (latest fetch less
``disorder``) has passed it, so what comes out depends neither on micro-batches
nor on the order of rows within ``disorder``.  Fetches later than that are late
and dropped by the watermark.

State of a URL is bounded: its first final fetch, and for each span of one
delay that is still open the first and the last retry.  That is enough: within
a span only the last retry can stand, and only the first one of the next span
can follow it within the delay.  The same summary is taken of every Arrow batch
before the shuffle, so a URL with a third of all fetches sends a few rows a batch.

URLs are kept in pages, by their hash: a page is one state row and one call of the
Python function a micro-batch, which costs some milliseconds whatever it holds.
Choose ``pages`` when a stream starts, about one for every thousand URLs
(``URLS_PER_PAGE``); a page is read and written whole when one of its URLs is.

Defined cases: rows with a null url, time or outcome, or with another outcome,
take no part; retries at one time are one; of a 'body' and a 'never' at one time
the 'body' counts; an empty stream gives nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

PARTIAL = "url string, outcome string, span long, first long, last long"
#: A page: the columns of ``Visits.state`` for each of its URLs.
STATE = ("urls array<string>, finals array<long>, outcomes array<string>, tolds array<boolean>, "
         "spans array<array<long>>, firsts array<array<long>>, lasts array<array<long>>")
OUT = "url string, outcome string, fetched_us long, due_us long"
FINAL = ("body", "never")
PAGES, URLS_PER_PAGE = 1024, 1000


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per URL, outcome and span of a batch."""
    for batch in batches:
        groups = pa.Table.from_batches([batch]).group_by(["url", "outcome", "span"]).aggregate(
            [("at", "min"), ("at", "max")])
        named = groups.select(["url", "outcome", "span", "at_min", "at_max"]).rename_columns(
            ["url", "outcome", "span", "first", "last"])
        yield from named.combine_chunks().to_batches()


class Visits:
    """What is known of one URL's fetches."""

    def __init__(self, final=None, outcome=None, told=False, spans=(), firsts=(), lasts=()):
        self.final, self.outcome, self.told = final, outcome, told
        self.open = {s: (a, b) for s, a, b in zip(spans, firsts, lasts)}

    def add(self, outcome: str, span: int, first: int, last: int) -> None:
        if outcome == "retry":
            a, b = self.open.get(span, (first, last))
            self.open[span] = (min(a, first), max(b, last))
        elif self.final is None or (first, outcome) < (self.final, self.outcome):
            self.final, self.outcome = first, outcome

    def pass_to(self, now: int, delay: int) -> list[tuple]:
        """(outcome, fetched_us, due_us) of all that lies before ``now``; forgets it."""
        rows = []
        for span in sorted(self.open):
            last = self.open[span][1]
            due = last + delay
            if self.final is not None and self.final <= due and self.final < now:
                del self.open[span]  # and so are all later ones
            elif due < now:
                if span + 1 not in self.open or self.open[span + 1][0] > due:
                    rows.append(("retry", last, due))
                del self.open[span]
        if self.final is not None and self.final < now and not self.told:
            rows.append((self.outcome, self.final, None))
            self.told = True
        return rows

    def next_time(self, delay: int) -> int | None:
        """When there is more to say."""
        times = [b + delay for _, b in self.open.values()]
        if self.final is not None and not self.told:
            times.append(self.final)
        return min(times, default=None)

    def state(self) -> tuple:
        spans = sorted(self.open)
        return (self.final, self.outcome, self.told, spans,
                [self.open[s][0] for s in spans], [self.open[s][1] for s in spans])


def _step(delay: int):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        page = {url: Visits(*kept) for url, *kept in zip(*state.get)} if state.exists else {}
        if not state.hasTimedOut:
            for frame in frames:
                columns = (frame[c].tolist() for c in ("url", "outcome", "span", "first", "last"))
                for url, outcome, span, first, last in zip(*columns):
                    if (visits := page.get(url)) is None:
                        visits = page[url] = Visits()
                    visits.add(outcome, span, first, last)
        # Whole milliseconds, as the watermark; a time in the millisecond of the watermark is not past.
        mark = max(state.getCurrentWatermarkMs(), 0)
        rows = [(url, *row) for url, visits in page.items() for row in visits.pass_to(mark * 1000, delay)]
        state.update(tuple(map(list, zip(*((url, *visits.state()) for url, visits in page.items())))))
        then = min((t for visits in page.values() if (t := visits.next_time(delay)) is not None), default=None)
        if then is not None:
            state.setTimeoutTimestamp(max(then // 1000, mark, 1))
        if rows:
            yield pd.DataFrame({"url": [r[0] for r in rows], "outcome": [r[1] for r in rows],
                                "fetched_us": pd.array([r[2] for r in rows], "Int64"),
                                "due_us": pd.array([r[3] for r in rows], "Int64")})
    return run


def frontier(fetches: DataFrame, delay_seconds: int, disorder: str, pages: int = PAGES) -> DataFrame:
    """Final outcomes and due retries of a stream ``(url, fetched_at, outcome)``:
    url, outcome, fetched_us, due_us (null for 'body' and 'never').  ``pages`` stays
    the same over restarts of a stream."""
    delay = int(delay_seconds) * 1_000_000
    if delay <= 0:
        raise ValueError("delay_seconds must be positive")
    if pages <= 0:
        raise ValueError("pages must be positive")
    at = F.unix_micros(F.col("fetched_at").cast("timestamp"))
    known = (fetches.filter(F.col("url").isNotNull() & F.col("fetched_at").isNotNull()
                            & F.col("outcome").isin("retry", *FINAL))
             .select("url", "outcome", at.alias("at"),
                     F.when(F.col("outcome") == "retry", F.floor(at / delay)).otherwise(0).cast("long").alias("span")))
    summaries = (known.mapInArrow(_summaries, PARTIAL)
                 .withColumn("seen", F.timestamp_micros("last")).withWatermark("seen", disorder))
    paged = summaries.withColumn("page", F.pmod(F.xxhash64("url"), F.lit(pages)))
    return paged.groupBy("page").applyInPandasWithState(
        _step(delay), OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
