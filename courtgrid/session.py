"""Spark session settings shared by jobs, tests and the bench.

Everything runs in UTC: stored instants are UTC and zone conversions are
explicit per row (see ``functions.scalars``).  AQE is on so shuffle
partition counts, join strategies and skewed partitions are re-planned at
run time from real sizes.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library needs, whatever the cluster.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# Settings applied when the session is built (static confs).
BUILD_CONF = {
    # Checkpoint files of DataFrames no longer referenced are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "courtgrid",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return a session with the library's settings.

    ``master`` is only set when given (on a cluster the launcher sets it).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(REQUIRED_CONF)
    conf.update(BUILD_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only if unset.

    On a cluster the shared folder comes from the session configuration.  A
    local scratch folder is only chosen when nothing is configured (tests,
    local runs).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}: executors do not see local ones")
        configured = tempfile.mkdtemp(prefix="courtgrid-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench."""
    return build_session(
        master=f"local[{cores}]",
        shuffle_partitions=shuffle_partitions,
        extra={
            "spark.driver.memory": "16g",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
            "spark.ui.showConsoleProgress": "false",
        },
    )
