"""The training-corpus pipeline: five stages, each one operator of siftweb.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet under the shared scratch folder and reads it back as the next
stage's docs.  All stages but the last return the columns of ``documents``.

1. toxicity: drops documents whose probability of being toxic is 0.5 or more.
2. quality: drops documents whose quality score is below 0.5.
3. near_dedup: keeps the smallest doc_id of each group of near copies.
4. substring_dedup: cuts windows of 50 words that start in a document with a
   smaller doc_id; ``n_chars`` becomes the length of what is left.  Documents
   that lose every word stay as empty texts.
5. packing: sequences of 2048 token ids along the Hilbert curve, one row per
   piece of a document.

The classifiers learn from ``labels`` and the documents that reach their
stage.  Defined cases: null texts count as empty; an empty table gives no
rows; the stages' operators define the rest.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftweb.llm import chosenpath, lempelziv, packing, quality, toxicity
from siftweb.session import scratch_path


#: Documents reach the Python workers in batches of about this many bytes, so that
#: what a batch takes in the JVM and in a worker does not grow with the texts.
BATCH_BYTES = 2 << 20


def _bound_batches(spark: SparkSession) -> None:
    """For the session, where it names no bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bound_batches(spark)
    return toxicity.keep_clean(docs, toxicity.fit(docs, _labels(spark, sf_dir)))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bound_batches(spark)
    return quality.keep_good(docs, quality.fit(docs, _labels(spark, sf_dir)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bound_batches(spark)
    return chosenpath.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bound_batches(spark)
    # The row travels whole beside its text, so the operator's columns replace none of its own.
    done = lempelziv.remove_repeats(docs.select("doc_id", "text", F.struct("*").alias("row")))

    def column(name: str):
        old = F.col("row").getField(name)
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            return F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema[name].dataType)).otherwise(old)
        return old
    return done.select(*[column(c).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bound_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]

#: SQL cannot express the classifiers; tests check the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
