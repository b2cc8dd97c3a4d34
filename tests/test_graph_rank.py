import pytest

from siftweb.operators import graph as G
from siftweb.operators import rank as R


# Small graphs: ids, links, and one step without teleport written out by hand.
GRAPHS = {
    "cycle": ([1, 2, 3], [(1, 2), (2, 3), (3, 1)],
              lambda x: {1: x[3], 2: x[1], 3: x[2]}),
    "star": ([0, 1, 2, 3], [(1, 0), (2, 0), (3, 0), (0, 1)],
             lambda x: {0: x[1] + x[2] + x[3], 1: x[0], 2: 0, 3: 0}),
    "dangling": ([1, 2, 3], [(1, 2), (2, 3)],
                 lambda x: {1: x[3] / 3, 2: x[1] + x[3] / 3, 3: x[2] + x[3] / 3}),
    # 1 has three links but two targets, so a third of its rank is lost.
    "duplicate_and_self": ([1, 2, 3], [(1, 2), (1, 2), (1, 3), (2, 2), (2, 1), (3, 1)],
                           lambda x: {1: x[2] / 2 + x[3], 2: x[1] / 3 + x[2] / 2, 3: x[1] / 3}),
    "hub": (list(range(40)), [(0, d) for d in range(1, 40)] + [(d, 0) for d in range(1, 40)] + [(5, 6), (5, 6)],
            lambda x: {0: sum(x[d] for d in range(1, 40)) - x[5] * 2 / 3, 6: x[0] / 39 + x[5] / 3}
            | {d: x[0] / 39 for d in range(1, 40) if d != 6}),
}


def by_hand(name, teleport, steps):
    ids, _, step = GRAPHS[name]
    x = dict.fromkeys(ids, 1 / len(ids))
    for _ in range(steps):
        y = {k: (1 - teleport) * v + teleport / len(ids) for k, v in step(x).items()}
        x = {k: v / sum(y.values()) for k, v in y.items()}
    return x


@pytest.mark.parametrize("name", sorted(GRAPHS))
@pytest.mark.parametrize("teleport", [0.0, 0.1])
def test_rank_matches_dense(spark, name, teleport):
    ids, links, _ = GRAPHS[name]
    v = spark.createDataFrame([(i,) for i in ids], "id long")
    e = spark.createDataFrame(links, "src long, dst long")
    res = R.rank(spark, v, e, teleport=teleport, eps=0.0, max_iter=7)
    got = {r.id: r.rank for r in res.ranks.collect()}
    exp = by_hand(name, teleport, 7)
    for k in ids:
        assert got[k] == pytest.approx(exp[k], abs=1e-12)
    assert sum(got.values()) == pytest.approx(1.0)
    assert all(x >= 0 for x in got.values())
    assert len(res.history) == 7


def test_rank_converges_and_history(spark):
    ids, links, _ = GRAPHS["cycle"]
    v = spark.createDataFrame([(i,) for i in ids], "id long")
    e = spark.createDataFrame(links, "src long, dst long")
    res = R.rank(spark, v, e, teleport=0.0)
    # uniform start is already the fixed point of a cycle: stops at step 0
    assert len(res.history) == 1 and res.history[0][2] < 1e-8
    assert res.history_df(spark).count() == 1


def test_empty_graph_is_noop(spark):
    v = spark.createDataFrame([], "id long")
    e = spark.createDataFrame([], "src long, dst long")
    res = R.rank(spark, v, e)
    assert res.ranks.count() == 0 and res.history == []


def test_graph_operators(spark):
    nodes = spark.createDataFrame(
        [(1, "http://a/1", ["http://a/2", "http://a/2", "http://x/none"]),
         (2, "http://a/2", ["http://a/1", "http://a/2"]),
         (3, "http://a/3", [])],
        "id long, url string, out_links array<string>")
    verts, resolved = G.page_graph(nodes)
    edges = {(r.src, r.dst): r.weight for r in G.weighted_edges(resolved).collect()}
    assert edges == {(1, 2): 1.0 / 2, (2, 1): 0.5, (2, 2): 0.5}
    counts = {r.src: r.out_count for r in G.out_counts(resolved).collect()}
    assert counts == {1: 2, 2: 2}
    dang = [r.id for r in G.dangling_nodes(verts, G.weighted_edges(resolved)).collect()]
    assert dang == [3]
    front = [r.url for r in G.frontier(nodes, G.node_aliases(nodes)).collect()]
    assert front == ["http://x/none"]


def test_url_index_later_wins_and_shared(spark):
    al = spark.createDataFrame([("u1", 1), ("u1", 5), ("u2", 2), ("u3", 5), ("u3", 7)],
                               "url string, node_id long")
    idx = {r.url: r.node_id for r in G.url_index(al).collect()}
    assert idx == {"u1": 5, "u2": 2, "u3": 7}
    same = {(r.url, r.node_id): r.same_as for r in G.shared_url_groups(al).collect()}
    assert same == {("u1", 1): 1, ("u1", 5): 1, ("u3", 5): 5, ("u3", 7): 5}
    twice = spark.createDataFrame([("u1", 1), ("u1", 5), ("u2", 2), ("u2", 5), ("u4", 9), ("u4", 9)], "url string, node_id long")
    assert {(r.url, r.node_id, r.same_as) for r in G.shared_url_groups(twice).collect()} == {
        ("u1", 1, 1), ("u1", 5, 1), ("u2", 2, 2), ("u2", 5, 2)}


def test_reachability(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")],
                              "src string, dst string")
    start = spark.createDataFrame([("a",)], "id string")
    got = {r.id: r.depth for r in G.reachability(spark, e, start).collect()}
    assert got == {"a": 0, "b": 1, "c": 2, "d": 3}


def test_hub_salting_keeps_result(spark):
    ids, links, _ = GRAPHS["hub"]
    v = spark.createDataFrame([(i,) for i in ids], "id long")
    e = spark.createDataFrame(links, "src long, dst long")
    res = R.rank(spark, v, e, teleport=0.1, eps=0.0, max_iter=5, salt_min_edges=3)
    got = {r.id: r.rank for r in res.ranks.collect()}
    exp = by_hand("hub", 0.1, 5)
    for k in ids:
        assert got[k] == pytest.approx(exp[k], abs=1e-12)


def test_reachability_cap(spark):
    e = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d"), ("c", "e")], "src string, dst string")
    start = spark.createDataFrame([("a",)], "id string")
    got = {r.id: r.depth for r in G.reachability(spark, e, start, max_sites=4).collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 2}


def test_edges_lie_in_a_grid(spark):
    """Partial sums a step: one a target and row of the grid; ranks sent: one a source and column."""
    from pyspark.sql import functions as F
    n = 200
    pairs = spark.range(n * n).selectExpr(f"id % {n} as src", f"id div {n} as dst")
    rows, columns = R.grid_for(16)
    keys = R.cell_keys(spark, rows * columns)
    assert (rows, columns) == (4, 4) and len(set(keys)) == 16
    for hubs in (None, spark.createDataFrame([(7,)], "hub long")):
        cells = R.place(pairs, hubs, rows, columns, keys).withColumn("at", F.spark_partition_id()).persist()
        assert cells.count() == n * n
        assert cells.select("at", "cell").distinct().count() == cells.select("at").distinct().count() == 16
        assert cells.select("at", "dst").distinct().count() == rows * n
        assert cells.filter("src <> 7").select("at", "src").distinct().count() == columns * (n - 1)
        assert cells.filter("src = 7").select("at").distinct().count() == (columns if hubs is None else 16)
        cells.unpersist()


def test_ids_of_another_type_than_links(spark):
    ids, links, _ = GRAPHS["hub"]
    v = spark.createDataFrame([(i,) for i in ids], "id int")
    e = spark.createDataFrame(links, "src long, dst long")
    exp = by_hand("hub", 0.1, 3)
    got = R.rank(spark, v, e, teleport=0.1, eps=0.0, max_iter=3).ranks.collect()
    assert {r.id: r.rank for r in got} == {k: pytest.approx(exp[k], abs=1e-12) for k in ids}


def test_step_leaves_the_edges_in_place(spark):
    from pyspark.sql import functions as F
    keys = R.cell_keys(spark, 4)
    edges = R.place(spark.range(100).selectExpr("id as src", "id * 7 % 100 as dst"), None, 2, 2, keys)
    sent = spark.range(100).select("id", R._cell(keys, 2, F.col("id") % 2, F.col("id") % 2).alias("to")).repartition(4, "to")
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    with R._joined_in_place(spark):
        step = sent.hint("merge").join(edges, (sent["to"] == edges["cell"]) & (sent["id"] == edges["src"]))
        assert "ENSURE_REQUIREMENTS" not in step._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get(name) == before


def test_step_gathers_nothing_on_the_driver(spark):
    """However small the vector is, a step joins it in place, in one task a cell."""
    keys = R.cell_keys(spark, 4)
    edges = R.place(spark.range(100).selectExpr("id as src", "id * 7 % 100 as dst"), None, 2, 2, keys)
    edges = edges.persist()
    xs = spark.range(100).selectExpr("id", "0.01 as share", f"explode(array({', '.join(map(str, keys))})) as to") \
        .repartition(4, "to")
    with R._joined_in_place(spark):
        got = R.contributions(xs, edges, 4)
        assert sorted((r["dst"], float(r["c"])) for r in got.collect()) == [(i, 0.01) for i in range(100)]
        plan = got._jdf.queryExecution().toString()
        assert "Broadcast" not in plan and got.rdd.getNumPartitions() == 4
    edges.unpersist()
