"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, partitions: int = 8, app: str = "vaultline") -> SparkSession:
    """A session configured for this pipeline (AQE on, UTC, no UI).

    On a cluster, leave ``master`` as None and size
    ``spark.sql.shuffle.partitions`` to ~128-256 MB of shuffle data per
    partition; AQE coalesces small partitions and splits skewed join ones.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # checkpoint files are removed once their DataFrame is gone
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # no Python call-site capture on every DataFrame call (driver-side
        # cost only; error messages lose the Python line)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master  # local-cluster has executors of its own
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting is always used when present.  Only a local
    session without one (tests) gets a private temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
        configured = tempfile.mkdtemp(prefix="vaultline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/vaultline-work/{name}-{uuid.uuid4().hex[:12]}"


def local_test_session(partitions: int = 8) -> SparkSession:
    os.environ.setdefault("PYSPARK_PYTHON", "python")
    return get_spark("local[8]", partitions, "vaultline-tests")
