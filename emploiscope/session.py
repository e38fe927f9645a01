"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# ANSI: bad numbers fail instead of turning into NULL. UTC: timestamps are instants.
# AQE picks broadcast or shuffle joins from measured sizes, splits skewed join
# partitions and sizes shuffle partitions at run time. The group-limit threshold lets a
# per-group cap above Spark's default of 1000 still cut rows before the shuffle.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
}

# Static settings, only possible on a new session: without call-site capture, building a
# plan from Python takes a third of the time.
ON_START = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app_name: str = "emploiscope", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the required settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED, **ON_START, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_required(spark: SparkSession) -> SparkSession:
    """Put the required runtime settings on a session someone else created."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor must reach."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
