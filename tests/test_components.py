"""Connected components against union-find: chains, hubs, random links."""

import random

from siftweb.operators import components as C


def brute(links):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        if a is not None and b is not None:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def found(spark, links):
    rows = C.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len({r.id for r in rows}) == len(rows)
    return {r.id: r.component for r in rows}


def test_chain_and_hub(spark):
    rng = random.Random(1)
    ids = list(range(1000))
    rng.shuffle(ids)
    chain = list(zip(ids, ids[1:]))  # 1,000 nodes in a row
    hub = [(5000, 6000 + i) for i in range(1500)] + [(8000, 7400), (8000, 9000)]  # most rows share one id
    odd = [(20000, 20000), (None, 3), (3, None), (None, None), (8000, 9000)]
    links = chain + hub + odd
    rng.shuffle(links)
    assert found(spark, links) == brute(links)


def test_random_links(spark):
    rng = random.Random(2)
    links = [(rng.randrange(-400, 400), rng.randrange(400)) for _ in range(300)]
    assert found(spark, links) == brute(links)
    assert found(spark, links[:0]) == {}


def test_nodes_that_share_urls(spark):
    rows = [("u1", 1), ("u2", 1), ("u2", 2), ("u3", 2), ("u3", 3), ("u4", 4), (None, 5), (None, 6), ("u5", None), ("u4", 4)]
    got = {r.node_id: r.component for r in C.merge_by_urls(spark.createDataFrame(rows, "url string, node_id long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6}
