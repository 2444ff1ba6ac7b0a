"""Session helpers: a local session for tests and the bench, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a production job should also carry (cluster managers set memory and cores).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Starting point for a large cluster (~100 TB inputs, ~1000 executors). Scans are cut into
# 256 MB splits; shuffles start wide (tens of thousands of partitions, so no reducer holds more
# than a few hundred MB even for the widest stage) and AQE coalesces them to ~256 MB or splits
# skewed ones. Broadcasts are capped by size; larger sides fall back to shuffle joins.
CLUSTER_CONF = {
    **SCALE_CONF,
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def local_session(cores: int | str = 8, app: str = "feedmetrics", shuffle_partitions: int | None = None,
                  event_log_dir: str | None = None) -> SparkSession:
    """A local-mode session for tests and the bench (UI off, UTC, AQE on)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
         .config("spark.driver.memory", os.environ.get("FEEDMETRICS_DRIVER_MEMORY", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Root of the shared folder for checkpoints and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``. Where it is unset, a private temporary folder is
    created if the master is local (as in tests); any other master raises, since executors
    would not see the driver's folder. The folder is also registered as the checkpoint folder
    of the SparkContext when none is.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # e.g. Spark Connect: the server owns the context and its checkpoint folder
        sc = None
    d = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not d:
        if not spark.conf.get("spark.master", "").startswith("local[") and spark.conf.get("spark.master", "") != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="feedmetrics-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new, unused path under the shared work folder (one per run; never reused)."""
    return f"{work_dir(spark)}/feedmetrics/{kind}-{uuid.uuid4().hex}"


def stored_rows(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written as Parquet under the shared work folder and read back: made once, however often it is read."""
    path = fresh_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
