"""Spark session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. The session zone is pinned to UTC so that no
# timestamp is silently re-zoned; all local-time work goes through explicit
# convert_timezone calls (see functions.timecols).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # no Python call-site capture on every Column call (driver-side planning cost only)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Additional settings for a large cluster (many executors, ~100 TB of series).
CLUSTER_CONF = {
    # scan splits: many small per-building files are packed into ~256 MB splits
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.files.openCostInBytes": str(4 * 1024 * 1024),
    # shuffle partitions sized at run time from the measured map output
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    # join and scan pruning
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
    # executor loss: retry tasks and stages, move shuffle blocks off decommissioning executors
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.storage.decommission.rddBlocks.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "loadshift",
                shuffle_partitions: int | None = None, extra: dict | None = None,
                cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session with the core settings.

    On a cluster pass ``master=None`` (spark-submit decides) and ``cluster=True``;
    size ``shuffle_partitions`` to the shuffled bytes / ~256 MB (AQE coalesces
    small partitions and splits skewed ones at run time).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(CORE_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a folder every executor can reach; it is
    read, never overridden, and a missing setting is an error. Only in local
    mode (tests, single machine) is a fresh scratch folder created when unset.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = jdir.get() if jdir.isDefined() else None
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        d = tempfile.mkdtemp(prefix="loadshift-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"

