"""Exact medians of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A bucket is a pair, both parts rising with the value: its place in the group's range, and its
# magnitude. The first splits values that lie close together far from zero, the second splits
# a range that a few large values stretch. A group has at most as many buckets as the sum of both.
_PLACES = 65536
_BUCKETS_PER_DOUBLING = 64


def _finite(value: Column) -> Column:
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def _bucket(value: Column, low: Column, high: Column) -> Column:
    """NULL for NULL; infinities at the ends, NaN above all, as Spark and most databases order it."""
    place = F.when(high > low, F.floor((value / 2 - low / 2) / (high / 2 - low / 2) * (_PLACES - 1))).otherwise(0)
    magnitude = F.floor(F.log2(F.abs(value)) * _BUCKETS_PER_DOUBLING) + 1100 * _BUCKETS_PER_DOUBLING
    magnitude = F.when(value == 0, 0).when(value < 0, -magnitude).otherwise(magnitude)
    ends = F.when(F.isnan(value), _PLACES + 1).when(value == float("inf"), _PLACES).when(value == float("-inf"), -1)
    finite = _finite(value).isNotNull()
    pair = F.struct(
        F.when(finite, place).otherwise(ends).cast("bigint").alias("place"), F.when(finite, magnitude).otherwise(0).cast("bigint").alias("magnitude")
    )
    return F.when(value.isNotNull(), pair)


def median_profile(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    rows: str = "n_rows",
    valued: str = "n_values",
    median: str = "median",
    weight: str | None = None,
) -> DataFrame:
    """Per ``keys``: rows, rows with a non-NULL ``value``, and the exact median of those.

    With ``weight``, a row of ``df`` stands for that many rows.

    Equal values are counted before anything is grouped by key, and that one table feeds
    the rest. Counts per value bucket (a bounded number per key) locate the one or two
    buckets holding the middle ranks; only the values of those buckets are sorted, so a task
    holds a whole group only if its distinct values are within 1/65536 of the group's range of
    each other. NaN counts as a value above infinity.
    """
    number = F.col(value).cast("double").alias("_value")
    times = F.sum("_weight") if weight else F.count("*")
    weights = [F.col(weight).alias("_weight")] if weight else []
    counts = df.select(*keys, number, *weights).groupBy(*keys, "_value").agg(times.alias("_count"))
    finite = _finite(F.col("_value"))
    ranges = counts.groupBy(*keys).agg(F.min(finite).alias("_low"), F.max(finite).alias("_high"))
    ranges = ranges.select(*(F.col(key).alias(f"_of{i}") for i, key in enumerate(keys)), "_low", "_high")
    of = F.lit(True)
    for i, key in enumerate(keys):
        of = of & counts[key].eqNullSafe(ranges[f"_of{i}"])
    counts = counts.join(ranges, of).select(
        *keys, "_value", "_count", _bucket(F.col("_value"), F.col("_low"), F.col("_high")).alias("_bucket")
    )

    # Buckets in value order; rows without a value are the NULL bucket and get no rank.
    by_key = Window.partitionBy(*keys)
    upto = by_key.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked_size = F.when(F.col("_bucket").isNotNull(), F.col("_size"))
    buckets = counts.groupBy(*keys, "_bucket").agg(F.sum("_count").alias("_size"))
    buckets = buckets.select(
        *(F.col(key).alias(f"_key{i}") for i, key in enumerate(keys)),
        F.col("_bucket").alias("_in"),
        (F.sum(ranked_size).over(upto) - F.col("_size")).alias("_before"),
        F.col("_size"),
        F.sum("_size").over(by_key).alias(rows),
        F.coalesce(F.sum(ranked_size).over(by_key), F.lit(0).cast("bigint")).alias(valued),
    )
    low, high = F.shiftright(F.col(valued) + 1, 1), F.shiftright(F.col(valued) + 2, 1)
    holds_middle = (F.col("_before") < high) & (F.col("_before") + F.col("_size") >= low)
    # A group without values keeps its NULL bucket so that it is not lost.
    middle = buckets.filter(F.when(F.col("_in").isNull(), F.col(valued) == 0).otherwise(holds_middle))

    same = counts["_bucket"].eqNullSafe(middle["_in"])
    for i, key in enumerate(keys):
        same = same & counts[key].eqNullSafe(middle[f"_key{i}"])
    # The middle buckets of a key follow each other, so one running count spans both.
    inside = Window.partitionBy(*keys)
    running = F.sum("_count").over(inside.orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = F.min("_before").over(inside) + running
    candidates = counts.join(middle, same).select(
        *keys, "_value", rows, valued, last.alias("_last"), (last - F.col("_count") + 1).alias("_first")
    )

    def at(rank: Column) -> Column:
        return F.max(F.when(rank.between(F.col("_first"), F.col("_last")), F.col("_value")))

    picked = candidates.groupBy(*keys, rows, valued).agg(at(low).alias("_lower"), at(high).alias("_upper"))
    return picked.select(*keys, rows, valued, ((F.col("_lower") + F.col("_upper")) / 2.0).alias(median))
