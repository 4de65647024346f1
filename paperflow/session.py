"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def build_session(master: str | None = None, app_name: str = "paperflow",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution on; the cluster's own settings win elsewhere."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder; a cluster
    without the setting is an error, since executors share no local disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="paperflow-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{scratch_root(spark)}/paperflow/{label}-{uuid.uuid4().hex}"

