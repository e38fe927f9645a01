"""Left joins that add names from reference tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_names(df: DataFrame, reference: DataFrame, key: Column, reference_key: str, names: Mapping[str, str]) -> DataFrame:
    """``df`` plus ``{new column: reference column}`` from the row whose key equals ``key``.

    Rows without a match keep NULLs. There is no broadcast hint: Spark broadcasts the
    reference only while its size is under ``spark.sql.autoBroadcastJoinThreshold`` (checked
    again at run time), and otherwise shuffles, splitting skewed keys.
    """
    side = reference.select(F.col(reference_key).alias("_key"), *(F.col(old).alias(new) for new, old in names.items()))
    return df.join(side, key == F.col("_key"), "left").drop("_key")


def unique_lookup(reference: DataFrame, key: Column, columns: Sequence[str]) -> DataFrame:
    """One row per ``_key``: of several rows sharing it, the one with the smallest ``columns``."""
    smallest = F.min(F.struct(*columns)).alias("_row")
    return reference.groupBy(key.alias("_key")).agg(smallest).select("_key", *(F.col("_row")[c].alias(c) for c in columns))
