"""Session construction and the shared scratch folder.

Intermediate tables (staged rows for outlier tuning, the one-pass gold
aggregate, landing targets in tests) are written under the folder the
cluster names in ``spark.checkpoint.dir``.  That folder must be on shared
storage (HDFS, S3, ...) so a lost executor never takes staged data with
it.  Only a local-mode session without that setting (tests, the bench)
gets a private folder under the system temp directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(
    master: str | None = None,
    app_name: str = "tripflow",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings every job here relies on.

    AQE re-plans at run time: it coalesces the small post-aggregation
    partitions, splits skewed shuffle partitions and turns joins into
    broadcasts only when the runtime size is below the threshold.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.parquet.filterPushdown": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master  # local-cluster[...] has executors of its own
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    Read from ``spark.checkpoint.dir``; set a private one only when it is
    unset and the session runs in local mode.  On a cluster without the
    setting this raises instead of silently using a machine-local path.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; point it at shared storage "
            "(e.g. hdfs:///tmp/tripflow) so staged tables survive executor loss"
        )
    # spark.checkpoint.dir is a core setting (read-only once the session
    # runs), so the private folder goes to the context only
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tripflow-scratch-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the scratch root (never reused)."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def env_float(name: str, default: float) -> float:
    value = os.environ.get(name)
    return float(value) if value not in (None, "") else default
