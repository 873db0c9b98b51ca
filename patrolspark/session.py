"""Session factory and shared-folder helpers.

Every calendar rule in this package reads the session time zone, so the
factory pins it to UTC.  Parallelism is left to adaptive query execution:
no fixed partition counts anywhere in the library.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A JSON key given twice keeps its last value (as the original system's
    # JSON reader did) instead of making the message unparsable.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
}
# SQL settings the library relies on; re-applied on an existing session.
RUNTIME_KEYS = ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode",
                "spark.sql.variant.allowDuplicateKeys")


def get_session(master: str | None = None, app_name: str = "patrolspark",
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and dynamic overwrite."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate may hand back an existing session: make sure the SQL-level
    # settings hold even then.
    pin(spark)
    return spark


def pin(spark: SparkSession) -> None:
    """Apply the SQL settings the library's semantics depend on."""
    for k in RUNTIME_KEYS:
        spark.conf.set(k, DEFAULT_CONF[k])


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    On a cluster this is a shared file system path set by the operator.  Only
    a local master without one gets a temporary folder; elsewhere that is an
    error, because executors would each write to their own disk.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="patrolspark-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared folder for one run's output."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/patrolspark/{name}-{uuid.uuid4().hex}"


__all__ = ["get_session", "pin", "shared_dir", "scratch_path", "DEFAULT_CONF"]
