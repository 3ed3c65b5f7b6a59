"""Spark session helpers.

The library never creates a session on its own inside a job; callers pass one in.
``build_session`` is a convenience for scripts and tests, ``ensure_checkpoint_dir``
is called by operators that cut lineage with ``DataFrame.checkpoint()``.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job benefits from: adaptive execution (runtime re-planning, skew-join
# splitting, partition coalescing), exact session time zone, no UI server.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # column statistics of landed tables estimate what a filter leaves; a filtered side also cuts the other by a
    # Bloom filter before it is shuffled
    "spark.sql.cbo.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # a join on the bucketing id and one more column needs no shuffle either
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
}


def cluster_conf(shuffled_tb: float, executors: int, cores_per_executor: int = 4) -> dict[str, str]:
    """Settings for a large run (e.g. ~100 TB over ~1000 executors).

    ``shuffled_tb`` is what the largest shuffle moves after filters and column pruning, not
    what is scanned. Shuffle partitions start at about one per 256 MB of it (at least 3 per
    core) and AQE coalesces them to the advisory size afterwards, so
    small stages do not pay for the large ones. Scan splits of 256 MB keep the task
    count of a 100 TB scan near 400k. Skewed partitions over 1 GB (and 5x the median)
    are split by AQE.
    """
    cores = max(1, executors * cores_per_executor)
    partitions = max(3 * cores, int(shuffled_tb * 1024 * 1024 / 256))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.cbo.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.session.timeZone": "UTC",
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "statera", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the reliable checkpoint folder of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that one is used.
    Only a local-mode session without the setting (tests, laptops) gets a private
    folder of its own. A cluster session without the setting is an error: a
    machine-local folder would not survive the loss of an executor. A remote (Spark
    Connect) session has no driver context here; its server's setting applies.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: checkpoint folder is configured on the server
        return None
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="statera-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a folder shared by the cluster")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables (e.g. landed relations) next to the
    session's reliable checkpoint folder - on a cluster that is the shared folder named
    in ``spark.checkpoint.dir``, in a local test session the private one."""
    import uuid

    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("no checkpoint folder known for this session")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a parquet table in the shared folder and read back, until the driver ends: cuts the lineage at
    files that survive a lost executor, and gives the planner true sizes."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)
