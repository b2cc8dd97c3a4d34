"""Headline timings at $BENCH_SF_DIR (default /root/testdata/sf0.1).

Runs each headline query to completion (Spark's no-op sink: the whole
plan executes, nothing is collected) and prints one JSON line.  Each query
is run once on sf0.001 first (JVM warm-up, generated-code cache).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from siftweb.plans import catalog  # noqa: E402
from siftweb.session import build_session  # noqa: E402

HEADLINE = {
    "page_extraction": "p12_page_nodes",
    "content_dedup": "d1_merge_duplicates",
    "graph_build": "g6_weighted_edges",
    "rank_one_step": "r2_r4_power_step",
    "rank_ten_steps": "r10_teleport_rank",
    "language_guess": "d6_guess_language",
    "single_search": "q21_q22_search",
    "batch_search": "q23_batch_search",
    "streaming_dedup": "t2_stream_content_dedup",
    "streaming_store_merge": "t4_stream_store_merge",
}


def run(spark, name: str, sf: str) -> float:
    t0 = time.perf_counter()
    df = catalog.REGISTRY[name](spark, sf)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, int(cpus)))
    # Warm-up: each headline query once on the smallest data set, so the
    # timed runs measure steady-state work, not JVM start and code generation.
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for name in HEADLINE.values():
            run(spark, name, warm)
    times = {}
    for label, name in HEADLINE.items():
        times[label] = round(run(spark, name, sf), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/")).replace("sf", "")}))


if __name__ == "__main__":
    main()
