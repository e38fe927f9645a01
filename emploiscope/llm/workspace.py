"""Working tables in the folder all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local-mode session without it gets a folder that ends with the process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    root = tempfile.mkdtemp(prefix="emploiscope-llm-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


# Rows and bytes that go to a Python worker at once: texts may be long, so both are bounded.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def bounded_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to ``BATCHES``; a session that has set smaller ones keeps them."""
    for key, most in BATCHES.items():
        now = spark.conf.get(key).removesuffix("b")
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(key, str(most))


class Workspace:
    """One run's folder under the shared root. A saved table cuts the lineage and outlives lost executors."""

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        bounded_batches(spark)
        self.spark = spark
        self.folder = f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
        self._count = 0

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self.folder}/{self._count:03d}-{name}"

    def save(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        path = self.path(name)
        df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Keys up to this number are sent to every task: at most some tens of megabytes.
BROADCAST_KEYS = 500_000


def without(docs: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The rows of ``docs`` whose ``on`` is not in the saved table ``keys``; few keys are broadcast, many are joined by shuffle."""
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    return docs.join(keys, on, "left_anti")
