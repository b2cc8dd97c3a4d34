import datetime as dt
import random

import pytest

from siftweb.streaming import frontier as FR
from siftweb.streaming import pages_stream as ST

SCHEMA = "url string, fetched_at timestamp, outcome string"
START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
HOUR = 3600 * 10 ** 6


def at(us):
    return START + dt.timedelta(microseconds=us)


def expected(rows, delay_us, disorder_us):
    """Fetch by fetch, without spans or watermark steps."""
    rows = [r for r in rows if r[0] is not None and r[1] is not None and r[2] in ("body", "never", "retry")]
    mark = (max(r[1] for r in rows) // 1000 - disorder_us // 1000) * 1000
    out = set()
    for url in {r[0] for r in rows}:
        mine = [(t, o) for u, t, o in rows if u == url]
        final = min([x for x in mine if x[1] != "retry"], default=None)
        if final and final[0] < mark:
            out.add((url, final[1], final[0], None))
        for t in {t for t, o in mine if o == "retry"}:
            due = t + delay_us
            if due < mark and not any(t < x <= due for x, o in mine if o == "retry") and not (final and final[0] <= due):
                out.add((url, "retry", t, due))
    return out


def run(spark, batches, delay_s, disorder, out=None, ck=None):
    folder = ST.scratch(spark, "frontier-in")
    add(spark, folder, batches)
    out, ck = out or ST.scratch(spark, "frontier-out"), ck or ST.scratch(spark, "frontier-ck")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
    ST.run_to_table(FR.frontier(stream.parquet(folder), delay_s, disorder), out, ck)
    return folder, out, ck


def add(spark, folder, batches):
    for rows in batches:
        made = [(u, None if t is None else at(t), o) for u, t, o in rows]
        spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def result(spark, out):
    base = int(START.timestamp()) * 10 ** 6
    rows = spark.read.schema(FR.OUT).parquet(out).collect()
    found = [(r.url, r.outcome, r.fetched_us - base, None if r.due_us is None else r.due_us - base) for r in rows]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("seed", [1, 2])
def test_frontier_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    # Times on a coarse grid tie often and meet the ends of spans and delays exactly.
    rows = [(f"u{rnd.choice([0, 0, 0, rnd.randrange(12)])}", rnd.randrange(0, 400) * HOUR // 4 + rnd.choice([0, 0, 1, 999]),
             rnd.choices(["retry", "body", "never"], [20, 1, 1])[0]) for _ in range(300)]
    rows += [(None, HOUR, "body"), ("u1", None, "body"), ("u1", 0, None), ("u1", 0, "other")]
    # Rows come up to ten hours out of order.
    rows.sort(key=lambda r: (r[1] or 0) + rnd.randrange(0, 10 * HOUR))
    batches = [rows[i: i + 80] for i in range(0, len(rows), 80)]
    _, out, _ = run(spark, batches, 6 * 3600, "10 hours")
    want = expected(rows, 6 * HOUR, 10 * HOUR)
    assert {o for _, o, *_ in want} >= {"retry"} and any(o != "retry" for _, o, *_ in want)
    assert result(spark, out) == want


def test_never_stays_away_and_a_restart_goes_on(spark):
    first = [("dead", 0, "never"), ("slow", 0, "retry"), ("good", 0, "retry"), ("good", HOUR, "body")]
    later = [("dead", 5 * HOUR, "retry"), ("slow", 6 * HOUR, "retry"), ("good", 6 * HOUR, "retry")]
    folder, out, ck = run(spark, [first], 2 * 3600, "1 hour")
    add(spark, folder, [later, [("clock", 30 * HOUR, "body")]])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    ST.run_to_table(FR.frontier(stream, 2 * 3600, "1 hour"), out, ck)
    assert result(spark, out) == {("dead", "never", 0, None), ("good", "body", HOUR, None),
                                  ("slow", "retry", 0, 2 * HOUR), ("slow", "retry", 6 * HOUR, 8 * HOUR)}


def test_empty_stream_and_state_bound(spark):
    _, out, _ = run(spark, [[]], 60, "1 minute")
    assert spark.read.schema(FR.OUT).parquet(out).count() == 0
    with pytest.raises(ValueError):
        FR.frontier(spark.createDataFrame([], SCHEMA), 0, "1 minute")
    v = FR.Visits()
    for t in range(10_000):  # ten thousand retries in ten delays
        v.add("retry", t // 1000, t, t)
    assert len(v.open) == 10
    assert v.pass_to(10 ** 6, 1000) == [("retry", 9999, 10999)] and not v.open
    assert not any(isinstance(x, list) and x for x in v.state())


def test_hot_url_is_summed_up_before_the_shuffle(spark):
    import pyarrow as pa
    n = 10_000
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["hot"] * n), pa.array(["retry"] * n), pa.array(range(n), pa.int64()),
         pa.array([t // 5000 for t in range(n)], pa.int64())], names=["url", "outcome", "at", "span"])
    rows = [r for b in FR._summaries(iter([batch])) for r in b.to_pylist()]
    assert sorted((r["span"], r["first"], r["last"]) for r in rows) == [(0, 0, 4999), (1, 5000, 9999)]


def test_a_call_takes_many_urls(spark):
    """3,000 URLs in 4 pages: with a call for each URL and batch this took minutes."""
    from pyspark.sql import functions as F
    folder, out, ck = (ST.scratch(spark, f"frontier-{n}") for n in ("in", "out", "ck"))
    every = spark.range(3000).select(F.concat(F.lit("u"), "id").alias("url"), F.lit(at(0)).alias("fetched_at"),
                                     F.when(F.col("id") % 3 == 0, "body").otherwise("retry").alias("outcome"))
    every.coalesce(1).write.parquet(folder)
    add(spark, folder, [[("clock", 30 * HOUR, "body")]])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    ST.run_to_table(FR.frontier(stream, 3600, "1 hour", pages=4), out, ck)
    assert result(spark, out) == {(f"u{i}", "retry" if i % 3 else "body", 0, HOUR if i % 3 else None) for i in range(3000)}
    states = spark.read.format("statestore").load(ck)
    assert states.count() <= 4 + 1 and states.selectExpr("value").count() > 0
