"""Session settings the jobs rely on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own_folder: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of every job.

    Times are read and shown in UTC.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in `spark.checkpoint.dir`.

    Without that setting a local session gets a temporary folder; a cluster
    session is refused, since a machine-local folder would lose data there.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        application = context.applicationId
        if application not in _own_folder:
            _own_folder[application] = tempfile.mkdtemp(prefix="granulake-")
        named = _own_folder[application]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def working_path(spark: SparkSession, label: str) -> str:
    """A new path inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/granulake/{label}-{uuid.uuid4().hex[:12]}"
