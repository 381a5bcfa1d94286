"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session running the reports should carry. AQE re-plans at
# runtime: it coalesces small shuffle partitions, turns a join into a broadcast
# only when the measured size of one side is under the threshold, and splits
# skewed join partitions.
#
# The broadcast thresholds are kept at dimension size (2 MB, static estimate
# and runtime measurement alike). A side bigger than that goes through a
# shuffle join, where AQE splits skewed partitions. With Spark's 10 MB default
# a fact-sized side that happens to be small at a test scale gets broadcast
# and the (possibly single-split) other side is streamed by very few tasks.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "2MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "2MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "tillroll",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the recommended settings.

    On a cluster leave ``master`` unset so the launcher decides; pass
    ``local[N]`` only for local runs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def is_single_machine(master: str) -> bool:
    """Whether driver and tasks share one process, and so one disk."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def configured_shared_dir(spark: SparkSession) -> str | None:
    """``spark.checkpoint.dir``, or else the session's checkpoint folder."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return configured or spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and written tables.

    Read from ``spark.checkpoint.dir``. Only when it is unset and the session
    runs in one process (tests, local runs) is a fresh local folder created and
    registered. On a cluster a folder of the driver's own disk would hold only
    part of what executors write, so an unset folder is an error there.
    """
    configured = configured_shared_dir(spark)
    if not configured:
        if not is_single_machine(spark.sparkContext.master):
            raise RuntimeError(
                "no shared folder: set spark.checkpoint.dir to one that the driver and all "
                "executors can reach, or give explicit paths (fact_path, checkpoint_dir)"
            )
        configured = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system (used for tables of this run only)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def any_path(spark: SparkSession, pattern: str) -> bool:
    """Whether a path of the shared file system matches the pattern."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
