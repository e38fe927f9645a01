"""The newest row of every offer as a table of its own, kept up to date from new snapshots only.

The state holds one row per key. A run reads the raw partitions whose files are not those it has
absorbed before: new dates, late ones, and dates that were loaded again. A date whose files were
replaced may have lost rows; only the keys whose newest row came from it are then looked up in the
other dates.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emploiscope.operators.latest import latest_snapshot
from emploiscope.sources.sink import INGESTION_DATE, load_table, table_location

_ABSORBED = "_absorbed"


def partition_files(raw: DataFrame) -> dict[str, list[str]]:
    """The files of every date of a table partitioned by ``_ingestion_date``, from its listing, no job."""
    files = defaultdict(list)
    for path in raw.inputFiles():
        date = unquote(path.rsplit(f"/{INGESTION_DATE}=", 1)[1].split("/", 1)[0])
        files[date].append(path.rsplit("/", 1)[1])
    return {date: sorted(names) for date, names in files.items()}


def changes(before: dict[str, list[str]], now: dict[str, list[str]]) -> tuple[list[str], list[str]]:
    """Dates with files not seen before, and dates that lost files they had."""
    new = sorted(date for date, files in now.items() if set(files) - set(before.get(date, ())))
    replaced = sorted(date for date, files in before.items() if set(files) - set(now.get(date, ())))
    return new, replaced


def advanced(state: DataFrame | None, raw: DataFrame, key: str, then: Sequence[str], new: Sequence[str], replaced: Sequence[str]) -> DataFrame:
    """The state after the dates ``new`` and ``replaced`` of ``raw`` have changed; a lazy plan.

    Without ``replaced`` it reads the dates ``new`` and nothing else of ``raw``.
    """
    def of(dates: Sequence[str]) -> DataFrame:
        return raw.filter(F.col(INGESTION_DATE).isin([F.lit(d).cast("date") for d in dates]))

    if state is None:
        return latest_snapshot(raw, key, INGESTION_DATE, then)
    gone = F.col(INGESTION_DATE).isin([F.lit(d).cast("date") for d in replaced]) if replaced else F.lit(False)
    rows = state.filter(~gone).unionByName(of(sorted({*new, *replaced})))
    if replaced:
        orphans = state.filter(gone).select(key)
        others = raw.filter(~F.col(INGESTION_DATE).isin([F.lit(d).cast("date") for d in sorted({*new, *replaced})]))
        rows = rows.unionByName(others.join(orphans, key, "left_semi"))
    return latest_snapshot(rows, key, INGESTION_DATE, then)


def absorb(spark: SparkSession, raw: DataFrame, table: str, key: str, then: Sequence[str] = (), location: str | None = None) -> list[str]:
    """Bring the state ``table`` up to date with ``raw``; the dates that were read again.

    The record of the files it has absorbed lies in the state's own folder, so that both change in
    one step. ``then`` settles rows of one key and date, as in ``latest_snapshot``.
    """
    now = partition_files(raw)
    known = spark.catalog.tableExists(table)
    before = absorbed(spark, table) if known else {}
    new, replaced = changes(before, now)
    if known and not new and not replaced:
        return []
    rows = advanced(spark.table(table) if known else None, raw, key, then, new, replaced)
    record = spark.createDataFrame([(date, file) for date, files in now.items() for file in files], "date string, file string")
    load_table(rows, table, location=location, beside=lambda version: record.write.parquet(f"{version}/{_ABSORBED}"))
    return sorted({*new, *replaced})


def absorbed(spark: SparkSession, table: str) -> dict[str, list[str]]:
    """The files of every date that the state of ``table`` has absorbed: a listing, so the driver holds it."""
    files = defaultdict(list)
    for row in spark.read.parquet(f"{table_location(spark, table)}/{_ABSORBED}").collect():
        files[row["date"]].append(row["file"])
    return {date: sorted(names) for date, names in files.items()}
