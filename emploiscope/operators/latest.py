"""One row, or the first k rows, per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows per key in ``order``.

    Spark limits each key to k rows inside every map task before the shuffle (for k up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``), so a key holding a third of the table
    reaches its reducer as at most k rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= k).drop("_rank")


def latest_snapshot(df: DataFrame, key: str, snapshot: str, then: Sequence[str] = ()) -> DataFrame:
    """The row of the newest snapshot per ``key``.

    Ties (a snapshot loaded twice in a day) go to the largest of ``then``. End ``then`` with a
    narrow column that settles the rest, such as a row hash stamped at load time: a reader scans
    the key, the order and what it selects, and nothing else.
    """
    return first_per_key(df, [key], [F.col(c).desc() for c in (snapshot, *then)])


def last_wins(df: DataFrame, key: str, sequence: str, then: Sequence[str] = ()) -> DataFrame:
    """The last occurrence of each key in fetch order; equal places go to the largest of ``then``."""
    return first_per_key(df, [key], [F.col(c).desc() for c in (sequence, *then)])


def cap_per_group(df: DataFrame, groups: Sequence[str], sequence: str, k: int, spread: int = 1024) -> DataFrame:
    """The first ``k`` rows per group in source order, for few groups of any size.

    Input partitions are dealt over ``spread`` sub-groups, each cut to k, before the groups
    are cut: a group that fills half the table is ranked by many tasks, and the last step
    sees at most ``spread * k`` rows of it. Equal places go by a hash of the row, so the same rows
    are kept on every run.
    """
    order = [F.col(sequence), F.xxhash64(*df.columns)]
    dealt = df.withColumn("_spread", F.pmod(F.spark_partition_id(), F.lit(spread)))
    return first_per_key(first_per_key(dealt, [*groups, "_spread"], order, k).drop("_spread"), groups, order, k)
