"""Spark session settings and the shared working folder.

Everything in the library takes an existing ``SparkSession``; this module
only helps scripts and tests build one with settings that suit the jobs:

* AQE on, so shuffle partitions are coalesced at run time, joins switch to
  broadcast only when the *measured* side is below the threshold, and skewed
  join partitions are split.
* The shuffle partition count comes from the caller: ``local[8]`` wants ~8,
  a 1000-executor cluster reading 100 TB wants tens of thousands (AQE then
  coalesces toward ``advisoryPartitionSizeInBytes``).
* The Spark UI is off (no server).
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_CHECKPOINT_LOCK = threading.Lock()  # staging threads may ask at once


def build_session(
    master: str | None = "local[8]",
    app_name: str = "crashlens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with AQE and a sensible partition count."""
    builder = SparkSession.builder.appName(app_name)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Checkpoint files go when the DataFrame that needs them is gone.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # No UI to show it, so keep little query history in the driver's
        # status store (plans of wide tables make each entry large).
        "spark.sql.ui.retainedExecutions": "50",
        "spark.ui.retainedJobs": "100",
        "spark.ui.retainedStages": "200",
        "spark.ui.retainedTasks": "10000",
    }
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            # Container hosts may resolve their own name to an unreachable
            # address; loopback keeps large task results reachable.
            conf["spark.driver.host"] = "127.0.0.1"
            conf["spark.driver.bindAddress"] = "127.0.0.1"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # Spark Connect has no SparkContext
        return False


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must name storage every executor can reach
    (HDFS, S3, ...). Only a local-mode session (tests, bench) with no setting
    gets a fresh folder of its own, which is then also registered as the
    RDD checkpoint folder so ``DataFrame.checkpoint()`` works.
    """
    with _CHECKPOINT_LOCK:
        value = spark.conf.get(CHECKPOINT_KEY, None)
        if not value:
            try:
                value = spark.sparkContext.getCheckpointDir()
            except Exception:
                value = None
        if value:
            if value.startswith("file:") and not _is_local(spark):
                raise RuntimeError(f"{CHECKPOINT_KEY} is {value}, a folder of one machine; it must be a shared one")
            return value.rstrip("/")
        if not _is_local(spark):
            raise RuntimeError(
                f"{CHECKPOINT_KEY} is not set; point it at a shared folder (HDFS/S3) "
                "so staged tables and checkpoints survive executor loss"
            )
        value = tempfile.mkdtemp(prefix="crashlens-ckpt-")
        spark.sparkContext.setCheckpointDir(value)
        return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder for one written table."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, through the file system it lies in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
