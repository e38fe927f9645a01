"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emploiscope.llm.workspace import Workspace


def _nearest(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of every ``u``; partial minima leave a hot node with one row per task."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = _nearest(both).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = _nearest(edges)
    moved = edges.join(smallest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(smallest.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
    return row[0], row[1]


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``; a component is named by its smallest node.

    Links whose ends are equal or null are passed over; an empty table gives an empty table. Each
    round is written, so a lost executor repeats one round at most. The number of rounds is about
    the logarithm of the longest path.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = work.save(edges, "edges")
    state = _state(edges)
    while True:
        edges = work.save(_small_star(_large_star(edges)), "stars")
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
