"""Session construction and cluster-facing settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# Settings every job relies on.  The session zone is pinned because window
# bounds and the yyyyMMdd / HH partition columns must not depend on the host.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Partition sizing for cluster runs (applied when no master is given, i.e.
# under spark-submit).  At ~100 TB: 256 MB input splits keep the scan at about
# 400k tasks; shuffles start with many partitions and AQE coalesces them to
# ~256 MB each (by size, not by maximum parallelism), so no shuffle partition
# outgrows executor memory; a partition 5x the median and over 512 MB is
# split by the skew-join rule.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
}


def build_session(master: str | None = None, app: str = "livestats",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    On a cluster ``master`` stays ``None`` so that spark-submit decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if not master:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.master.startswith("local"):
        ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster sets this to shared storage, and it is used as is.  Only when
    it is unset on a local master (tests) is a scratch folder created, since a
    cluster's machines don't share one; there the call fails.  The folder is
    given to the context (``setCheckpointDir``), never written into the
    session conf, which Spark does not allow at runtime.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_FALLBACK.get("path")
    try:
        sc = spark.sparkContext
    except (AttributeError, PySparkException):  # no driver-side context (Spark Connect)
        sc = None
    if not path:
        if sc is None or not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = _LOCAL_FALLBACK["path"] = tempfile.mkdtemp(prefix="livestats-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


_LOCAL_FALLBACK: dict[str, str] = {}


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """Per-query streaming checkpoint location under the shared folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "streams", name)
