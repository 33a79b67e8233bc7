"""Session construction and shared-storage scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every tessera job relies on.  AQE re-plans joins from runtime sizes
# (the size check behind every broadcast we do not hint), coalesces small
# shuffle partitions and splits skewed sort-merge-join partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Spark removes checkpoints that no plan refers to any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with tessera's defaults.

    On a cluster, leave ``master`` unset and size ``shuffle_partitions`` to the
    data (roughly input bytes / 128 MB); locally it defaults to the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _context_dir(spark: SparkSession) -> str | None:
    """The folder a caller gave to ``sc.setCheckpointDir``."""
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - a Spark Connect client has no context
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster sets it (a shared folder), or the caller by
    ``sc.setCheckpointDir``; only in local mode (tests, a laptop) is a private
    temp folder created and registered when both are unset.  On a cluster (``local-cluster`` included) an unset value
    is an error, never a local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or _context_dir(spark)
    if not d:
        master = spark.conf.get("spark.master", "") or ""
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/...) "
                             "that every executor can reach")
        # Local mode only (tests, a laptop): one process, so a temp folder is shared.
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    # Keep the SparkContext's notion in sync so DataFrame.checkpoint() works
    # (a Spark Connect client has no local context; its server reads the conf).
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001
        return d
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location for a written intermediate table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-scratch/{name}-{uuid.uuid4().hex}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
