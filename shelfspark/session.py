"""Session factory and run-level settings.

ANSI mode stays on (Spark 4 default) so bad casts fail loudly, the session
zone is UTC (timestamps in the sources carry no zone), and AQE is on so
shuffle partition counts and skewed joins are re-planned at run time.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Shuffle partitions are only a starting point:
# AQE coalesces small ones and splits skewed ones at run time. A task sorts and
# joins up to ten times in memory what it reads compressed, so many partitions
# are merged to 32 MB at most: a task's memory does not grow with the tables.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "600",
    "spark.sql.files.maxPartitionBytes": "128m",
    # broadcast only what a finished shuffle has measured to be small: the driver builds the
    # table, several at once. Sizes planned from files count compressed bytes, far
    # fewer than the driver would hold, so they suffice for tiny tables only.
    "spark.sql.autoBroadcastJoinThreshold": str(256 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(4 * 1024 * 1024),
    # joins move rows to all of their keys, unless a query sets it otherwise
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "shelfspark", checkpoint: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the warehouse defaults.

    On a cluster ``master`` stays None so spark-submit decides; tests pass
    ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", os.environ.get("SHELF_DRIVER_MEM", "12g"))
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if checkpoint:
        builder = builder.config("spark.checkpoint.dir", checkpoint)
    # checkpoint files of DataFrames that are no longer referenced are removed
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the SQL settings to a session created by someone else (the driver)."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on an existing session: keep theirs
                pass


def join_within_partitions(spark: SparkSession) -> None:
    """Rows that lie by some of a join's keys (product) need not move again to be joined by all (product and day)."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    A cluster names it in ``spark.checkpoint.dir``; without it only a local
    session gets a fresh scratch folder, any other master is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="shelfspark-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"
