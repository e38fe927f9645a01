"""The request grid (job code x département) and its coverage."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emploiscope.operators.latest import cap_per_group

# Job codes and départements requested, and the most rows one request returns.
ROME_CODES = ["M1805", "M1810", "M1806", "M1801"]
# Corsica (20) counts as 2A and 2B.
DEPARTEMENTS = (
    [f"{number:02d}" for number in range(1, 20)] + ["2A", "2B"] + [f"{number:02d}" for number in range(21, 96)] + ["971", "972", "973", "974", "976"]
)
MAX_OFFERS = 1150


def request_grid(spark: SparkSession, romes: Sequence[str] = ROME_CODES, departements: Sequence[str] = DEPARTEMENTS) -> DataFrame:
    """Every (rome, departement) combination, built from two short lists."""
    one = spark.range(1).select(F.explode(F.array(*map(F.lit, romes))).alias("rome"))
    return one.select("rome", F.explode(F.array(*map(F.lit, departements))).alias("departement"))


def concat_fetches(fetches: Sequence[DataFrame]) -> DataFrame:
    """The rows of all combinations in one table, columns matched by name."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), fetches)


def cap_offers(offers: DataFrame, sequence: str, k: int = MAX_OFFERS, cell: Sequence[str] = ("rome", "departement")) -> DataFrame:
    """The first ``k`` offers of every grid cell in source order."""
    return cap_per_group(offers, list(cell), sequence, k)


def grid_coverage(grid: DataFrame, offers: DataFrame, cap: int = MAX_OFFERS) -> DataFrame:
    """Offers per grid cell, zero included, and whether the cell reached the cap.

    Offers are counted before the join, so what is joined is one row per cell.
    """
    counts = offers.groupBy("rome", "departement").agg(F.count("*").alias("n_found"))
    joined = grid.join(counts, ["rome", "departement"], "left")
    found = F.coalesce("n_found", F.lit(0).cast("bigint"))
    return joined.select("rome", "departement", found.alias("n_offers"), (found >= cap).alias("at_cap"))
