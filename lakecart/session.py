"""Session defaults and shared scratch locations.

Scratch data (landed CSV, silver/gold tables built by query keys, checkpoints)
always lives under the cluster's shared ``spark.checkpoint.dir``.  A temporary
folder stands in for it only on a ``local`` master, where one machine is all
there is; on any other master a missing setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the library relies on (see README "Session settings").
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # Zone-less timestamps, like the warehouse's TIMESTAMP type.
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    # Keep the bronze `dt` partition value a string.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "lakecart", **extra: str) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; tests pass
    ``local[*]``.  ``extra`` overrides any default.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", **SESSION_DEFAULTS, **extra}
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_sql_defaults(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_sql_defaults(spark: SparkSession) -> None:
    """Set the runtime SQL options on an existing session (driver-provided sessions)."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)


def is_local(master: str) -> bool:
    """True where driver and executors are one process (``local``, ``local[..]``)."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, setting one only if the session has none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="lakecart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused directory for one build, beside the checkpoints.

    Directories are not deleted by the library: a returned DataFrame may still
    read from them.  Clean the scratch root with the cluster's retention policy.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    return f"{base}/lakecart-scratch/{name}-{uuid.uuid4().hex[:12]}"
