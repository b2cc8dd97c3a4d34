"""Session, table and checkpoint helpers shared by every job."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "siftweb") -> SparkSession:
    """Local session for tests and the bench; a cluster passes its own conf.

    AQE stays on so small shuffles coalesce and skewed joins split at run
    time; the UI is off (no server is opened).
    """
    master = master or os.environ.get("SIFTWEB_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Tests and local runs: driver and tasks are one process, so its own disk is shared.
    if not spark.conf.get("spark.checkpoint.dir", None) and re.match(r"local(\[|$)", spark.sparkContext.master):
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoint")
    return spark


# Settings for a large cluster (hundreds of TB, ~1000 executors).  Shuffle
# partitions start high and AQE coalesces them to ~256 MB; text-heavy page
# files are split at 64 MB so a regex-heavy task stays short; skewed joins
# are split by AQE; broadcasts are size-checked by the planner (10 MB).
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def apply_cluster_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Set CLUSTER_CONF (plus overrides) on a cluster session.  The
    checkpoint folder is not set here: it comes from the cluster."""
    for k, v in {**CLUSTER_CONF, **(overrides or {})}.items():
        if not spark.conf.isModifiable(k):
            raise ValueError(f"{k} is fixed when the session starts; set it there")
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The setting is read from the session, never invented here: a folder of
    the driver's own disk would be out of the executors' sight.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        raise RuntimeError("spark.checkpoint.dir is not set; name a folder that the driver "
                           "and all executors share when the session is built")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (already-fetched pages and friends)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
