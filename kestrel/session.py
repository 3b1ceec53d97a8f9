"""Session construction and the shared folders the jobs may write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every kestrel job relies on.  Broadcasts are decided by size:
# a side whose files lie below the threshold is broadcast at once, and AQE
# converts a join to a broadcast join at runtime when a shuffle stage is
# measured below the adaptive threshold.  AQE also coalesces tiny shuffle
# partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "16m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, app: str = "kestrel",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with kestrel's defaults.

    ``master`` is only set when given; on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    The cluster names the folder in ``spark.checkpoint.dir``; it must be a
    shared file system every executor can reach.  Only a local-mode session
    (tests) gets a fresh temporary folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for it")
    folder = tempfile.mkdtemp(prefix="kestrel-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/kestrel-{name}-{uuid.uuid4().hex}"


def local_session_for_tests(cores: int | str = "*",
                            shuffle_partitions: int = 8) -> SparkSession:
    """The small local session the tests and the bench use."""
    return build_session(master=f"local[{cores}]", app="kestrel-local",
                         shuffle_partitions=shuffle_partitions,
                         conf={"spark.driver.memory": os.environ.get(
                             "KESTREL_DRIVER_MEMORY", "8g")})
