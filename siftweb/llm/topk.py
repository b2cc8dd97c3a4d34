"""Exact maximum-inner-product top-k by norm-bucketed retrieval.

Candidates are grouped by length (norm), buckets of about 9 % width; a
bucket is cut into blocks of about ``block`` rows, so a bucket that holds a
third of all rows is many blocks.  Queries form blocks of their own.

1. Every query block meets the blocks of the longest vectors until about
   ``seed_rows`` rows are covered; a query's k-th score there is a lower
   bound for its final k-th score.
2. Every query block meets each other block.  With bound b, query length
   |q| and bucket length l, the local cosine threshold is b / (|q| l).
   Above 1 the query skips the block.  High thresholds use coordinate
   pruning (inner product on the query block's heaviest coordinates plus a
   Cauchy-Schwarz bound on the rest), low ones length pruning.  Survivors
   are verified with exact integer products.
3. The at most k rows per (query, block) are cut to k per query.

Defined cases: vectors that are null or hold null or non-finite components
take no part; only vectors with equal numbers of components meet; rows that
repeat a vec_id count once, with the smallest vector; ties go to the smaller
vec_id; a null vec_id takes no part; an empty table gives no rows; other
columns are ignored.  Scores are exact while they fit 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftweb.session import scratch_path

BLOCK, QUERY_BLOCK, SEED_ROWS = 2048, 512, 4096
#: Cosine threshold from which coordinate pruning pays; coordinates it uses.
STEEP, FOCUS = 0.5, 12
_NONE = -(2 ** 63)
#: Bucket of zero vectors.
ZERO = -20000


def quantised(vectors: DataFrame, scale: int = 64, is_query: Column | None = None) -> DataFrame:
    """(vec_id, v array<long>, norm, dim, query) of the vectors that take part."""
    x = F.col("embedding")
    sound = F.forall(x, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a.cast("double")) < float("inf")))
    ints = vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull()).filter(sound).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda a: F.floor(a.cast("double") * F.lit(float(scale))).cast("long")).alias("v"),
        F.coalesce(F.lit(False) if is_query is None else is_query, F.lit(False)).alias("query"))
    one = ints.groupBy("vec_id").agg(F.min("v").alias("v"), F.max("query").alias("query"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, a: s + a.cast("double") * a.cast("double")))
    return one.select("vec_id", "v", F.size("v").alias("dim"), norm.alias("norm"), "query")


def _gathered(cut: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One row per block: its rows as an array, its largest norm."""
    extra = [F.col("bound")] if "bound" in cut.columns else []
    return cut.groupBy(*keys).agg(F.collect_list(F.struct("vec_id", "v", *extra)).alias(name),
                                  F.max("norm").alias(f"{name}_norm"))


def _part(n) -> Column:
    return F.pmod(F.xxhash64("vec_id"), n).cast("int")


def _query_blocks(rows: DataFrame) -> DataFrame:
    """Queries in blocks of about QUERY_BLOCK; the join table has one row per dim."""
    n = rows.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("_n"))
    return _gathered(rows.join(F.broadcast(n), "dim").withColumn("_qpart", _part(F.col("_n"))),
                     ["dim", "_qpart"], "q")


def _matrix(cell: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    ids = cell.field("vec_id").to_numpy(zero_copy_only=False)
    m = cell.field("v").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
    order = np.argsort(ids, kind="stable")
    names = [f.name for f in cell.type]
    bound = cell.field("bound").to_numpy(zero_copy_only=False)[order] if "bound" in names else None
    return ids[order], m[order], bound


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if top < 2.0 ** 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def _alive(q: np.ndarray, x: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Mask of (query, candidate) pairs that can reach the query's bound."""
    qf, xf = q.astype(np.float64), x.astype(np.float64)
    qn, xn = np.sqrt((qf ** 2).sum(1)), np.sqrt((xf ** 2).sum(1))
    slack = 1e-9 * (1 + np.outer(qn, xn))
    b = np.where(bound == _NONE, -np.inf, bound.astype(np.float64))
    local = b / np.maximum(qn * xn.max(initial=0), 1e-300)
    alive = np.outer(qn, xn) + slack >= b[:, None]  # length pruning
    steep = (local >= STEEP) & (local <= 1)
    if steep.any() and q.shape[1] > FOCUS:
        f = np.argsort(-(qf[steep] ** 2).sum(0))[:FOCUS]
        qr = np.sqrt(np.maximum(qn[steep] ** 2 - (qf[steep][:, f] ** 2).sum(1), 0))
        xr = np.sqrt(np.maximum(xn ** 2 - (xf[:, f] ** 2).sum(1), 0))
        alive[steep] &= qf[steep][:, f] @ xf[:, f].T + np.outer(qr, xr) + slack[steep] >= b[steep, None]
    return alive


def _meet(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                qi, q, bound = _matrix(batch.column("q")[i].values)
                xi, x, _ = _matrix(batch.column("x")[i].values)
                bound = np.full(len(qi), _NONE) if bound is None else bound
                alive = _alive(q, x, bound)
                rows = np.flatnonzero(alive.any(1))
                if not len(rows):
                    continue
                cols = np.flatnonzero(alive[rows].any(0))
                s = _scores(q[rows], x[cols])
                ok = alive[np.ix_(rows, cols)] & (s >= bound[rows, None]) & (qi[rows, None] != xi[None, cols])
                out_q, out_x, out_s = [], [], []
                for r in range(len(rows)):
                    hit = np.flatnonzero(ok[r])
                    hit = hit[np.argsort(-s[r, hit], kind="stable")[:k]]  # ids ascend: ties to the smaller
                    out_q.append(np.full(len(hit), qi[rows[r]]))
                    out_x.append(xi[cols[hit]])
                    out_s.append(s[r, hit])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c), pa.int64()) for c in (out_q, out_x, out_s)],
                    names=["query_id", "vec_id", "score"])
    return run


def _pairs(q: DataFrame, plan: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Query blocks meet the candidate blocks that ``plan`` lists per bucket
    (parts lo..hi), by an equi-join on (dim, bucket, part)."""
    both = q.join(F.broadcast(plan.filter("lo <= hi")), "dim")
    if "low" in q.columns:  # nobody in the query block can reach its bound there
        most = F.when(F.col("bucket") == ZERO, F.lit(0.0)).otherwise(F.pow(F.lit(2.0), (F.col("bucket") + 1) / 8))
        both = both.filter(F.col("low").isNull() | (F.col("q_norm") * most * 1.000001 + 1 >= F.col("low")))
    both = both.withColumn("_part", F.explode(F.sequence("lo", "hi"))).drop("lo", "hi")
    return both.join(blocks, ["dim", "bucket", "_part"]).select("q", "x") \
        .mapInArrow(_meet(k), "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows that ``is_query`` (over the
    columns of ``vectors``) picks, against every row but the query's own."""
    spark = vectors.sparkSession
    path = scratch_path(spark, "topk")
    bucket = F.when(F.col("norm") > 0, F.floor(F.log2("norm") * 8)).otherwise(F.lit(ZERO)).cast("int")
    quantised(vectors, scale, is_query).withColumn("bucket", bucket).write.parquet(f"{path}/v")
    rows = spark.read.parquet(f"{path}/v")
    # One row per (dim, bucket): at most 17,000 buckets of a double's range.
    w = Window.partitionBy("dim").orderBy(F.desc("bucket"))
    sizes = rows.groupBy("dim", "bucket").agg(F.count("*").alias("n")).withColumn(
        "before", F.sum("n").over(w) - F.col("n")).withColumn("parts", F.ceil(F.col("n") / BLOCK).cast("int"))
    seeds = F.greatest(F.lit(0), F.least("parts", F.ceil((F.lit(SEED_ROWS) - F.col("before")) / BLOCK))).cast("int")
    sizes.select("dim", "bucket", "parts", seeds.alias("seeds")).write.parquet(f"{path}/n")
    sizes = spark.read.parquet(f"{path}/n")
    cut = rows.join(F.broadcast(sizes), ["dim", "bucket"]).withColumn("_part", _part(F.col("parts")))
    blocks = _gathered(cut, ["dim", "bucket", "_part"], "x").drop("x_norm")
    queries = rows.filter("query")

    plan = sizes.select("dim", "bucket", F.lit(0).alias("lo"), (F.col("seeds") - 1).alias("hi"))
    _pairs(_query_blocks(queries), plan, blocks, k).write.parquet(f"{path}/s")
    first = spark.read.parquet(f"{path}/s")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    bound = first.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") == k) \
        .select(F.col("query_id").alias("vec_id"), F.col("score").alias("bound"))
    known = queries.join(bound, "vec_id", "left").withColumn("bound", F.coalesce("bound", F.lit(_NONE)))
    least = F.array_min(F.transform("q", lambda e: e["bound"]))
    qb = _query_blocks(known).withColumn("low", F.when(least > _NONE, least))
    plan = sizes.select("dim", "bucket", F.col("seeds").alias("lo"), (F.col("parts") - 1).alias("hi"))
    rest = _pairs(qb, plan, blocks, k)
    return first.unionByName(rest).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
