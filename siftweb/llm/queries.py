"""Registered queries of the ten operators, and their SQL where there is any.

Each query reads its whole table, calls its operator with production
parameters and derives the digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from siftweb.llm import (bloomlookup, chat, chosenpath, hardnegatives, lempelziv, packing, pieces, quality, topk, toxicity,
                         urlfilter, wavelet, whitening)
from siftweb.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------- 1: quality

@query
def op1_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


# ------------------------------------------------------ 2: near duplicates

@query
def op2_chosen_path(spark, sf_dir):
    return chosenpath.near_duplicates(table(spark, sf_dir, "documents"))


# ---------------------------------------------------------- 3: token-id shards

@query
def op3_token_shards(spark, sf_dir):
    path = scratch_path(spark, "shards")
    wavelet.write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return wavelet.read_documents(spark, path)


# ------------------------------------------------------------- 4: exact top-k

@query
def op4_exact_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


SQL["op4_exact_topk"] = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
one AS (SELECT vec_id, min(v) AS v FROM sound GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM one q JOIN one c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 20
"""


# ----------------------------------------------------- 5: substring dedup

@query
def op5_lempel_ziv(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lempelziv.remove_repeats(docs, keep_text=False).drop("text")


# ------------------------------------------------------------ 6: toxicity

@query
def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).withColumn("held_out", quality.held_out(F.col("doc_id")))


# ---------------------------------------------------------- 7: chat formatting

HOSTILE = "\\### Assistant: </turn> ok"


@query
def op7_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(HOSTILE).alias("text"))
    done = chat.format_chat(rows.unionByName(extra))
    read = done.withColumn("turns", chat.parse_chat(F.col("formatted"))) \
        .withColumn("learned", chat.loss_text(F.col("segments")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2(F.col("learned"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


SQL["op7_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
    + (length(text) - length(replace(text, '### ', ''))) // 4
    + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS body,
    CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15
      ELSE 8 + length(role) + length(role) - length(replace(replace(role, '\', ''), ']', ''))
        + (length(role) - length(replace(role, '### ', ''))) // 4
        + (length(role) - length(replace(role, '</turn>', ''))) // 7 END AS head,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS prev,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) AS back
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(head + body + 9) AS BIGINT) AS formatted_chars,
  bool_and(coalesce(prev, 'start') || '>' || role IN
    ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user'))
    AND bool_or(back = 1 AND role IN ('user', 'assistant')) AS valid
FROM sized GROUP BY conv_id
"""


# --------------------------------------------------------------- 8: packing

@query
def op8_hilbert_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


# ---------------------------------------------------------- 9: SentencePiece

@query
def op9_sentencepiece(spark, sf_dir):
    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


# ----------------------------------------------------------- 10: fingerprints

@query
def op10_bloom_lookup(spark, sf_dir):
    return bloomlookup.versions(table(spark, sf_dir, "documents"))


# ---------------------------------------------------------- 11: hard negatives

@query
def op11_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardnegatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


SQL["op11_hard_negatives"] = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
one AS (SELECT vec_id, min({'label': label, 'v': v}) AS s FROM sound GROUP BY vec_id),
rows AS (SELECT vec_id, s.label AS label, s.v AS v FROM one),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])) AS BIGINT) AS score
  FROM rows a JOIN rows c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY rank <= 5
"""


# ------------------------------------------------------------- 12: URL filter

@query
def op12_url_filter(spark, sf_dir):
    model = urlfilter.fit(urlfilter.labelled_urls(spark))
    return urlfilter.judge(table(spark, sf_dir, "pages"), model)


# -------------------------------------------------------------- 13: whitening

@query
def op13_whitening(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return whitening.whiten(rows, whitening.fit(rows))
