"""Session builder and the shared folder for data that has to outlive a job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_folders: dict[str, str] = {}


def build_session(
    app_name: str = "tripmill",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with a fixed UTC zone and adaptive execution.

    Time keys are wall-clock text, so a zone with clock changes would print
    some of them an hour off; UTC has none.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def new_folder(spark: SparkSession, label: str) -> str:
    """Name of a fresh folder under ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors would each write to a disk of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _local_folders:
            _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="run-")
        base = _local_folders[context.applicationId]
    return f"{base.rstrip('/')}/tripmill/{label}-{uuid.uuid4().hex}"
