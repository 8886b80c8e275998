"""Spark session settings used by tests, the bench and local runs.

On a cluster the session comes from the platform; only options that are unset
are filled in here, and the number of shuffle partitions is set only when a
caller (tests, bench) asks for it.  ``spark.checkpoint.dir`` must name a shared
folder.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Wide projections (many label columns) generate long loops; let the JIT
    # compile them instead of interpreting (HotSpot skips methods > 8 KB).
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "monthwise", extra: dict | None = None) -> SparkSession:
    """Return the running session with unset options filled in, or create one."""
    wanted = {**_LOCAL_DEFAULTS, **(extra or {})}
    spark = SparkSession.getActiveSession()
    if spark is None:
        builder = SparkSession.builder.appName(app)
        if master:
            builder = builder.master(master)
        wanted["spark.driver.memory"] = os.environ.get("MONTHWISE_DRIVER_MEM", "16g")
        if shuffle_partitions is not None:
            wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        spark = builder.config(map=wanted).getOrCreate()
    else:
        for key, value in wanted.items():
            if key.startswith("spark.sql.") and spark.conf.get(key, None) is None:
                spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def join_on_stored_partitioning(spark: SparkSession) -> None:
    """Let joins on several keys use a partitioning by one of them.

    Facts are partitioned (or stored) by record number; joins on record, audit and contact need no other exchange.  By
    default Spark deals both sides again by all keys of such a join.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; executors and driver must both reach it."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured
