"""Writing tables and files: dispositions, date partitions, clustering, dated landing paths."""

from __future__ import annotations

import contextlib
import datetime
import re
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emploiscope.sources.scan import scan

# Write dispositions.
MODE_BY_DISPOSITION = {"WRITE_TRUNCATE": "overwrite", "WRITE_APPEND": "append"}

INGESTION_DATE = "_ingestion_date"
# A narrow column that settles which of several equal-dated rows of a key is read.
ROW_HASH = "_row_hash"


def write_mode(disposition: str) -> str:
    if disposition not in MODE_BY_DISPOSITION:
        raise ValueError(f"Unknown write disposition {disposition!r}: expected one of {', '.join(MODE_BY_DISPOSITION)}")
    return MODE_BY_DISPOSITION[disposition]


def stamp(df: DataFrame, run_date: datetime.date, row_hash: bool = False) -> DataFrame:
    """Add ``_ingestion_date``, and ``_row_hash`` if asked. The date is given, never read from a clock, so reruns agree."""
    hashed = df.withColumn(ROW_HASH, F.xxhash64(*df.columns)) if row_hash else df
    return hashed.withColumn(INGESTION_DATE, F.lit(run_date))


def _filesystem(spark: SparkSession, path: str):
    """Hadoop's view of ``path`` and of the file system it is on."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _swap(spark: SparkSession, written: str, path: str) -> None:
    """Put the complete folder ``written`` in the place of ``path``; what was there goes last."""
    files, new = _filesystem(spark, written)
    _, here = _filesystem(spark, path)
    _, aside = _filesystem(spark, f"{path}.old-{uuid.uuid4().hex}")
    replaced = files.exists(here)
    if replaced and not files.rename(here, aside):
        raise OSError(f"Could not move {path} aside")
    files.mkdirs(here.getParent())
    if not files.rename(new, here):
        if replaced:
            files.rename(aside, here)
        raise OSError(f"Could not move {written} to {path}")
    if replaced:
        files.delete(aside, True)


def _replace(writer: DataFrameWriter, spark: SparkSession, path: str, skip_if_empty: bool) -> bool:
    """Write beside ``path`` and swap at the end: a failed job leaves the old rows as they were.

    Emptiness is read from what was written, so the plan runs once.
    """
    path = path.rstrip("/")
    written = f"{path}.new-{uuid.uuid4().hex}"
    files, new = _filesystem(spark, written)
    try:
        writer.save(written)
        if skip_if_empty and spark.read.parquet(written).isEmpty():
            return False
        _swap(spark, written, path)
    finally:
        files.delete(new, True)
    return True


def cluster(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Range-partition and sort by ``columns`` so Parquet min/max statistics skip row groups.

    The input partition id is the last range key: it spreads one very frequent value over
    many tasks, and being the same on every attempt it survives a lost executor.
    """
    salted = df.withColumn("_spread", F.spark_partition_id())
    ranged = salted.repartitionByRange(*columns, "_spread")
    return ranged.sortWithinPartitions(*columns).drop("_spread")


def _writer(
    df: DataFrame,
    disposition: str,
    partition_by: Sequence[str],
    cluster_by: Sequence[str],
    rebalance: bool,
) -> DataFrameWriter:
    mode = write_mode(disposition)
    if cluster_by:
        df = cluster(df, [*partition_by, *cluster_by])
    elif rebalance and partition_by:
        # AQE gathers rows per partition value and splits the large ones again.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format("parquet").mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer


def load_path(
    df: DataFrame,
    path: str,
    disposition: str = "WRITE_TRUNCATE",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    rebalance: bool = False,
    skip_if_empty: bool = False,
) -> bool:
    """Write ``df`` as Parquet files; False when skipped because it has no rows.

    ``rebalance`` suits input holding many partition values; a daily append holds one and
    is written from where it is, without a shuffle. A replace takes effect when it is complete.
    """
    writer = _writer(df, disposition, partition_by, cluster_by, rebalance)
    if disposition == "WRITE_TRUNCATE":
        return _replace(writer, df.sparkSession, path, skip_if_empty)
    if skip_if_empty and df.isEmpty():
        return False
    writer.save(path)
    return True


def load_table(
    df: DataFrame,
    table: str,
    disposition: str = "WRITE_TRUNCATE",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    rebalance: bool = False,
    skip_if_empty: bool = False,
    location: str | None = None,
    beside: Callable[[str], object] | None = None,
) -> bool:
    """The same for a catalog table ``<layer>.<name>``, in ``location`` or the layer's own folder.

    A view of that name is refused, and stays as it is.

    ``beside`` may add hidden files to the folder of a replaced table before it takes effect.
    """
    spark = df.sparkSession
    writer = _writer(df, disposition, partition_by, cluster_by, rebalance)
    layer, _, name = table.rpartition(".")
    if layer:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "VIEW":
        raise ValueError(f"{table} is a view; drop it before a table takes its name")
    if disposition == "WRITE_TRUNCATE":
        base = location or f"{spark.catalog.getDatabase(layer or spark.catalog.currentDatabase()).locationUri.rstrip('/')}/{name}"
        return _replace_table(writer, df, table, base.rstrip("/"), partition_by, skip_if_empty, beside)
    if skip_if_empty and df.isEmpty():
        return False
    with _partitions_by_listing(spark):
        known = spark.catalog.tableExists(table)
        (writer.option("path", location) if location and not known else writer).saveAsTable(table)
    return True


@contextlib.contextmanager
def _partitions_by_listing(spark: SparkSession) -> Iterator[None]:
    """Tables made inside find their partitions in their location, so that a change of location is all a replace needs."""
    key = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _details(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def _bare(path: str) -> str:
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def table_location(spark: SparkSession, table: str) -> str:
    """The folder that ``table`` reads now."""
    return _bare(_details(spark, table)["Location"])


def _replace_table(
    writer: DataFrameWriter,
    df: DataFrame,
    table: str,
    base: str,
    partition_by: Sequence[str],
    skip_if_empty: bool,
    beside: Callable[[str], object] | None,
) -> bool:
    """Write a new version folder under ``base`` (hidden from who reads ``base`` itself), then let the table read it: one change in the catalog.

    Until then readers see the old rows, from then on the new ones. Nothing is renamed or copied.
    The version before stays until the next replace, for readers that have begun; older ones go.
    """
    spark = df.sparkSession
    version = f"{base}/_version-{uuid.uuid4().hex}"
    files, folder = _filesystem(spark, version)
    before = table_location(spark, table) if spark.catalog.tableExists(table) else None
    try:
        writer.save(version)
        if skip_if_empty and spark.read.schema(df.schema).parquet(version).isEmpty():
            files.delete(folder, True)
            return False
        if beside:
            beside(version)
        _point_table(spark, table, version, df, partition_by)
    except BaseException:
        if not spark.catalog.tableExists(table) or table_location(spark, table) != _bare(version):
            files.delete(folder, True)
        raise
    _forget_versions(spark, base, {_bare(version), before})
    return True


def _forget_versions(spark: SparkSession, base: str, kept: set[str | None]) -> None:
    """Delete what is under ``base`` but for the folders ``kept``; nothing while ``base`` itself is one of them."""
    if _bare(base) in kept:
        return
    files, here = _filesystem(spark, base)
    for child in files.listStatus(here):
        if _bare(child.getPath().toString()) not in kept:
            files.delete(child.getPath(), True)


def _point_table(spark: SparkSession, table: str, path: str, df: DataFrame, partition_by: Sequence[str]) -> None:
    """Let ``table`` read the complete files of ``path``.

    A table of the same columns changes its location in one step. One whose columns differ, or whose
    partitions are listed in the catalog (made before this library did otherwise), is made anew.
    """
    if spark.catalog.tableExists(table):
        known = _details(spark, table)
        old = [(f.name, f.dataType) for f in spark.table(table).schema]
        order = [f for f in df.schema if f.name not in partition_by] + [f for f in df.schema if f.name in partition_by]
        if old == [(f.name, f.dataType) for f in order] and known.get("Partition Provider") != "Catalog":
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        if known.get("Type") == "MANAGED":
            # Dropping it takes its folder along: an empty one.
            empty = f"{path}.dropped"
            files, folder = _filesystem(spark, empty)
            files.mkdirs(folder)
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{empty}'")
        spark.sql(f"DROP TABLE {table}")
    with _partitions_by_listing(spark):
        parts = f"PARTITIONED BY ({', '.join(f'`{name}`' for name in partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {table} ({df._jdf.schema().toDDL()}) USING parquet {parts} LOCATION '{path}'")


def load_run(
    df: DataFrame, table: str, run_date: datetime.date, partition_by: Sequence[str] = (INGESTION_DATE,), location: str | None = None
) -> int:
    """Append one day's run so that running it again replaces what it wrote before; returns its rows.

    The run's own date is overwritten and other dates are not touched; a run without rows leaves its
    date without rows. A file ``_runs/<date>`` beside the partitions records the rows of the run when
    it is complete: a date without one is unfinished, and running it again mends it.
    """
    spark = df.sparkSession
    if partition_by[0] != INGESTION_DATE or len(partition_by) != 1:
        raise ValueError(f"A run is appended to a table partitioned by {INGESTION_DATE}")
    if not spark.catalog.tableExists(table):
        load_table(df.limit(0), table, "WRITE_APPEND", partition_by, location=location)
    here = _details(spark, table)["Location"]
    files, record = _filesystem(spark, f"{here}/_runs/{run_date.isoformat()}")
    files.delete(record, False)
    counted = Observation()
    columns = spark.table(table).columns
    rows = df.filter(F.col(INGESTION_DATE) == F.lit(run_date)).select(*columns).observe(counted, F.count("*").alias("rows"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(here)
    n = int(counted.get["rows"])
    if n == 0:
        files.delete(_filesystem(spark, f"{here}/{INGESTION_DATE}={run_date.isoformat()}")[1], True)
    out = files.create(record, True)
    out.write(bytearray(str(n), "ascii"))
    out.close()
    if _details(spark, table).get("Partition Provider") == "Catalog":
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    return n


def finished_runs(spark: SparkSession, table: str) -> dict[str, int]:
    """The recorded runs of ``table``: date and rows."""
    files, folder = _filesystem(spark, f"{_details(spark, table)['Location']}/_runs")
    if not files.exists(folder):
        return {}
    return {s.getPath().getName(): int(bytes(files.open(s.getPath()).readAllBytes())) for s in files.listStatus(folder)}


def load_file_to_table(
    spark: SparkSession,
    path: str,
    layer: str,
    table: str,
    disposition: str = "WRITE_TRUNCATE",
    schema: StructType | None = None,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    location: str | None = None,
) -> None:
    """Load one landed file into ``layer.table``; arguments are checked before any job runs."""
    write_mode(disposition)
    load_table(
        scan(spark, path, schema),
        f"{layer}.{table}",
        disposition,
        partition_by=partition_by,
        cluster_by=cluster_by,
        location=location,
    )


def landing_path(root: str, prefix: str, run_date: datetime.date, filename: str) -> str:
    """``root/prefix/YYYY-MM-DD/filename``."""
    return f"{root.rstrip('/')}/{prefix}/{run_date.isoformat()}/{filename}"


def export_jsonl(df: DataFrame, path: str, disposition: str = "WRITE_TRUNCATE") -> str:
    """One JSON object per line, UTF-8 unescaped, NULL fields kept."""
    df.write.mode(write_mode(disposition)).option("ignoreNullFields", "false").json(path)
    return path
