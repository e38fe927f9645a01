"""Skipping a heavy source whose newest snapshot is recent."""

from __future__ import annotations

import datetime
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: days during which a snapshot counts as recent.
SKIP_IF_RECENT_DAYS = 30

log = logging.getLogger(__name__)


def snapshot_age(df: DataFrame, date_column: str, as_of: datetime.date, threshold: int = SKIP_IF_RECENT_DAYS) -> DataFrame:
    """One row ``(newest, age_days, skip)`` for an append-only table; all NULL/false if empty."""
    newest = df.agg(F.max(F.col(date_column)).cast("date").alias("newest"))
    age = F.datediff(F.lit(as_of), "newest").cast("bigint")
    return newest.select("newest", age.alias("age_days"), F.coalesce(age < threshold, F.lit(False)).alias("skip"))


def file_age_days(spark: SparkSession, path: str, now: datetime.datetime) -> int | None:
    """Whole days since the newest file under ``path`` changed; None when there is none.

    The binaryFile source answers from file status alone when content is not selected.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    seconds = F.max("modificationTime").cast("double")
    newest = files.agg(seconds.alias("newest")).first()["newest"]
    return None if newest is None else int((now.timestamp() - newest) // 86400)


def should_skip(spark: SparkSession, path: str, now: datetime.datetime, threshold: int = SKIP_IF_RECENT_DAYS) -> bool:
    """True only when the newest snapshot is younger than ``threshold`` days.

    A failing check never blocks the ingestion: it is logged and the answer is False.
    """
    try:
        age = file_age_days(spark, path, now)
    except Exception:
        log.warning("freshness check failed for %s, proceeding", path, exc_info=True)
        return False
    return age is not None and age < threshold
