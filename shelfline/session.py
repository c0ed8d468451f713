"""Where a job may write its intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the session's ``spark.checkpoint.dir``.

    Only a local-mode session without that setting falls back to a temporary
    folder; on a cluster a machine-local folder would be lost with its executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = sc.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="shelfline-")
    return _local_dirs[app]


def new_dir(spark: SparkSession, name: str) -> str:
    """A path below :func:`shared_dir` that no earlier run has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
