"""Iterative rank (R1-R11): power method with teleport, as a DataFrame loop.

Edges lie in a grid of cells, rows by source and columns by target, one cell
a partition, sorted and cached once.  Per step a rank goes to the cells of its
row, and a cell gives one partial sum for each of its targets: of a graph with
n vertices in R x C cells at most (R + C) * n rows move, not one for each edge.
An edge's weight depends on its source only and is kept with the vertex.
Dangling rows are never densified: their mass is one scalar spread over
all vertices.  One action per step yields L1 norm, L2 change and dangling
mass together; every ``checkpoint_every`` steps the rank vector is written
to the shared checkpoint folder to cut lineage.
"""

from __future__ import annotations

import math
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftweb.operators import graph as G
from siftweb.session import checkpoint_dir, scratch_path

# Defaults of the rank loop.
DEFAULT_EPS = 1e-8
DEFAULT_MAX_ITER = 100


@dataclass
class RankResult:
    ranks: DataFrame                 # (id, rank), sums to 1
    history: list = field(default_factory=list)   # (step, l1, diff)

    def history_df(self, spark: SparkSession) -> DataFrame:
        """Convergence history as a DataFrame."""
        return spark.createDataFrame(self.history, "step int, l1 double, diff double")


ROWS_PER_PARTITION = 16_000_000


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Partitions for a table of ``rows`` rows: about 16M rows each, at least
    the cluster's parallelism (so a small graph does not run hundreds of tiny
    tasks per step)."""
    return max(1, spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_PARTITION))


def grid_for(parts: int) -> tuple[int, int]:
    """Rows and columns of a grid of at least ``parts`` cells, as square as can be."""
    rows = math.isqrt(parts)
    return rows, -(-parts // rows)


def cell_keys(spark: SparkSession, cells: int) -> list[int]:
    """One key a cell, which ``repartition(cells, key)`` deals to a partition of its own."""
    keys: dict[int, int] = {}
    start = 0
    while len(keys) < cells:
        ids = spark.range(start, start + 16 * cells).select(F.col("id").cast("int").alias("key"))
        for r in ids.select("key", F.pmod(F.hash("key"), F.lit(cells)).alias("at")).collect():
            keys.setdefault(r["at"], r["key"])
        start += 16 * cells
    return [keys[i] for i in range(cells)]


@contextmanager
def _joined_in_place(spark: SparkSession):
    """Both sides lie by cell, which is one of the two join keys: without this
    setting the planner deals the edges anew by both keys in every step."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _cell(keys: list[int], columns: int, row: Column, column: Column) -> Column:
    return F.get(F.array(*[F.lit(k) for k in keys]), row * F.lit(columns) + column)


def _line(of: Column, lines: int, seed: int) -> Column:
    """Row (seed 0) or column (1) of the grid for an id, or the row for a hub's target (2)."""
    return F.pmod(F.xxhash64(F.lit(seed), of), F.lit(lines)).cast("int")


def place(pairs: DataFrame, hubs: DataFrame | None, rows: int, columns: int, keys: list[int]) -> DataFrame:
    """``pairs(src, dst)`` dealt to the cells of a grid, one cell a partition:
    src, dst, cell, sorted by source.  ``hubs(hub)`` are spread over all rows."""
    row = _line(F.col("src"), rows, 0)
    if hubs is not None:
        pairs = pairs.join(F.broadcast(hubs), pairs["src"] == hubs["hub"], "left")
        row = F.when(F.col("hub").isNull(), row).otherwise(_line(F.col("dst"), rows, 2))
    return (pairs.select("src", "dst", _cell(keys, columns, row, _line(F.col("dst"), columns, 1)).alias("cell"))
            .repartition(rows * columns, "cell").sortWithinPartitions("cell", "src"))


def contributions(xs: DataFrame, edges: DataFrame, parts: int) -> DataFrame:
    """(dst, c): what each target gets of the shares in ``xs(id, share, to)``.

    Merge joins, so that a step does not gather the vector on the driver for a
    broadcast.  A cell sums up its targets where it lies; the sums then come to
    the vector's own partitions, so no step has more tasks than the grid has cells."""
    return (xs.hint("merge").join(edges, (xs["to"] == edges["cell"]) & (xs["id"] == edges["src"]))
            .groupBy("cell", "dst").agg(F.sum("share").alias("s"))
            .repartition(parts, "dst").groupBy("dst").agg(F.sum("s").alias("c")))


def rank(spark: SparkSession, vertices: DataFrame, resolved: DataFrame,
         teleport: float = 0.0, eps: float = DEFAULT_EPS,
         max_iter: int = DEFAULT_MAX_ITER, checkpoint_every: int = 5,
         salt_min_edges: int = 100_000) -> RankResult:
    """Rank ``vertices(id)`` over ``resolved(src, dst)`` links.

    ``teleport`` p is clamped to [0, 1]; a step is ``(1-p)·M x + p/n``.
    Stops when the L1 norm falls below ``eps`` (previous vector kept), when
    the L2 change falls below ``eps``, or after ``max_iter`` steps.
    """
    p = min(1.0, max(0.0, float(teleport)))
    checkpoint_dir(spark)
    # Inputs are written to the checkpoint folder once, so the loop's plans
    # start from files, not from whatever produced the graph.
    path = scratch_path(spark, "rank")
    resolved.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/edges")
    pairs = spark.read.parquet(f"{path}/edges")
    # Duplicate links raise a source's out count but add one edge only.
    deg = pairs.groupBy("src").agg(F.count(F.lit(1)).alias("deg"), (F.lit(1.0) / F.sum("n")).alias("weight"))
    deg.write.parquet(f"{path}/sources")
    deg = spark.read.parquet(f"{path}/sources")
    dstats = deg.agg(F.sum("deg").alias("m"), F.max("deg").alias("top")).first()
    n_edges, top = dstats["m"] or 0, dstats["top"] or 0
    rows, columns = grid_for(partitions_for(spark, n_edges))
    parts = rows * columns
    keys = cell_keys(spark, parts)
    # Hub sources are dealt over all rows of the grid by target, so that no
    # single task joins a third of all edges; only hub rows of the rank vector
    # go to all cells.  The hub table is bounded: a source is a hub when it
    # holds more than ``target`` edges, so there are at most
    # n_edges / target <= 4 * partitions of them.
    target = max(salt_min_edges, -(-n_edges // (4 * parts)))
    hubs = None
    if top > target:
        hub_rows = deg.filter(F.col("deg") > target).select(F.col("src").alias("hub")).collect()
        hubs = spark.createDataFrame(hub_rows, "hub " + pairs.schema["src"].dataType.simpleString())
    edges = place(pairs, hubs, rows, columns, keys).persist(StorageLevel.MEMORY_AND_DISK)
    verts = (vertices.select("id").distinct().join(deg.select(F.col("src").alias("id"), "weight").hint("merge"), "id", "left")
             .checkpoint())
    vstats = verts.agg(F.count(F.lit(1)).alias("n"),
                       F.count_if(F.col("weight").isNull()).alias("nd")).first()
    n, n_dangling = vstats["n"], vstats["nd"]
    if n == 0:
        return RankResult(verts.select("id", F.lit(None).cast("double").alias("rank")), [])

    # Uniform start; x is kept as (id, weight, raw) with x = raw * scale.
    x = (verts.select("id", "weight", F.lit(1.0 / n).alias("raw"))
         .repartition(parts, "id").persist(StorageLevel.MEMORY_AND_DISK))
    scale = 1.0
    dangling_mass = n_dangling / n
    history = []
    prev = x
    with _joined_in_place(spark):
        for step in range(max_iter):
            xs = x.filter(F.col("weight").isNotNull())
            # An int and a long hash differently, though they join.
            in_rows = F.array(_line(F.col("id").cast(pairs.schema["src"].dataType), rows, 0))
            if hubs is not None:
                xs = xs.join(F.broadcast(hubs), xs["id"] == hubs["hub"], "left")
                in_rows = F.when(F.col("hub").isNull(), in_rows).otherwise(F.sequence(F.lit(0), F.lit(rows - 1)))
            xs = xs.select("id", (F.col("raw") * F.col("weight")).alias("share"), F.explode(in_rows).alias("row"))
            xs = xs.select("id", "share", F.explode(F.transform(
                F.sequence(F.lit(0), F.lit(columns - 1)), lambda c: _cell(keys, columns, F.col("row"), c))).alias("to")).repartition(parts, "to")
            contrib = contributions(xs, edges, parts)
            mx = F.coalesce(F.col("c"), F.lit(0.0)) * F.lit(scale) + F.lit(dangling_mass / n)
            both = (x.join(contrib.hint("merge"), x["id"] == contrib["dst"], "left")
                    .select("id", "weight", (F.col("raw") * F.lit(scale)).alias("x"),
                            ((1.0 - p) * mx + p / n).alias("y")))
            if (step + 1) % checkpoint_every == 0:
                both = both.checkpoint()
            else:
                both = both.persist(StorageLevel.MEMORY_AND_DISK)
            st = both.agg(
                F.sum(F.abs("y")).alias("l1"),
                F.sum(F.col("x") * F.col("x")).alias("xx"),
                F.sum(F.col("x") * F.col("y")).alias("xy"),
                F.sum(F.col("y") * F.col("y")).alias("yy"),
                F.sum(F.when(F.col("weight").isNull(), F.col("y")).otherwise(0.0)).alias("dy"),
            ).first()
            l1 = st["l1"] or 0.0
            if l1 < eps:                      # R5: heading to the null vector
                history.append((step, float(l1), None))
                both.unpersist()
                break
            diff2 = st["xx"] - 2.0 * st["xy"] / l1 + st["yy"] / (l1 * l1)   # R6
            if diff2 < 1e-10 * st["xx"]:      # too close for the expanded square
                step_by = F.col("y") / F.lit(l1) - F.col("x")
                diff2 = both.agg(F.sum(step_by * step_by)).first()[0] or 0.0
            diff = math.sqrt(max(diff2, 0.0))
            history.append((step, float(l1), float(diff)))
            prev.unpersist()
            prev = both
            x = both.select("id", "weight", F.col("y").alias("raw"))
            scale = 1.0 / l1                  # R4: renormalize lazily
            dangling_mass = (st["dy"] or 0.0) / l1   # R3
            if diff < eps:
                break
    x.select("id", (F.col("raw") * F.lit(scale)).alias("rank")).write.parquet(f"{path}/ranks")
    x.unpersist()
    prev.unpersist()
    edges.unpersist()
    return RankResult(spark.read.parquet(f"{path}/ranks"), history)


def apply_importance(nodes: DataFrame, ranks: DataFrame, id_col: str = "id") -> DataFrame:
    """Clamp ranks to [0, 1] and write them on the nodes as importance."""
    r = ranks.select(F.col("id").alias(id_col),
                     F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("rank"))).alias("_r"))
    return (nodes.join(r, id_col, "left")
            .withColumn("importance", F.coalesce(F.col("_r"), F.col("importance")))
            .drop("_r"))


def rank_nodes(spark: SparkSession, nodes: DataFrame, teleport: float = 0.0,
               eps: float = DEFAULT_EPS, max_iter: int = DEFAULT_MAX_ITER) -> DataFrame:
    """Full ranking of a node table (strict page graph); an empty
    graph leaves the nodes unchanged."""
    vertices, resolved = G.page_graph(nodes)
    result = rank(spark, vertices, resolved.select("src", "dst"), teleport, eps, max_iter)
    return apply_importance(nodes, result.ranks)
