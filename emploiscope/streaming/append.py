"""Appending newly landed files to a raw table, each file once.

The daily append (one dated JSON file per run) as a file stream that stops when it has
caught up. The checkpoint records which files are done, so a run lost half-way resumes
without loading a file twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from emploiscope.sources.sink import INGESTION_DATE

# The date folder of ``root/prefix/YYYY-MM-DD/file``.
_DATE_FOLDER = "/([0-9]{4}-[0-9]{2}-[0-9]{2})/"


def append_new_files(
    spark: SparkSession,
    landing: str,
    columns: Iterable[str],
    rows: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
) -> StreamingQuery:
    """Start appending the JSON files under ``landing/YYYY-MM-DD/`` not loaded yet.

    ``columns`` are the top-level fields read as text. ``rows`` turns them row by row into
    raw columns and keeps ``_ingestion_date``, the date of the landing folder, by which the
    files of ``target`` are laid out. Nothing else may write to ``target``. The query ends by
    itself; wait with ``awaitTermination()``.
    """
    schema = StructType([StructField(name, StringType()) for name in columns])
    source = spark.readStream.schema(schema).option("mode", "FAILFAST").option("recursiveFileLookup", "true")
    files = source.json(landing)
    landed = F.regexp_extract("_metadata.file_path", _DATE_FOLDER, 1).cast("date")
    return (
        rows(files.select("*", landed.alias(INGESTION_DATE)))
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(INGESTION_DATE)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
