"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Sizes are per-cluster knobs: on a large cluster raise
# shuffle partitions so that one reducer handles roughly 128-256 MB.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Catalyst broadcasts a join side only when its estimated size is under this bound
    # and AQE re-checks it with runtime sizes; larger sides fall back to sort-merge.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # Ordered operators checkpoint to the shared folder on every run; delete those files
    # once their RDD is garbage-collected, so a long-lived session does not fill it.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tidemark",
                  extra: dict | None = None, driver_memory: str = "8g") -> SparkSession:
    """A session for tests, benchmarks and local runs.

    On a cluster, submit with your own settings instead; the library only reads them.
    """
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory  # local mode: the driver JVM is the executor
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder of the session.

    The folder named by ``spark.checkpoint.dir`` (or set on the context) is used as is.
    Only a local-mode session without one gets a fresh scratch folder; a cluster session
    without a shared folder is an error, because a machine-local folder would not survive
    the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    raise RuntimeError(
        "set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS); ordered operators "
        "checkpoint their range-partitioned input there")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
