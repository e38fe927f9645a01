"""Boosted trees fitted on every row of a table, however many there are.

Rows meet the driver only as sums of gradients per node, feature and bin, one job for each level of a
tree. Sums are of whole units, so order and partitions don't change the forest; a table of at most
``DRIVER_ROWS`` rows is summed at once by the same function and gives the same forest without the jobs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emploiscope.llm.dom_boost import BINS, DEPTH, RATE, TREES, Forest
from emploiscope.llm.text import gives_back

DRIVER_ROWS = 50_000
UNIT = float(1 << 30)
INNER = 2**DEPTH - 1

Tree = tuple[np.ndarray, np.ndarray]  # feature and threshold by node, as far as it has grown
Sums = Callable[[Forest, Tree, int, list[int]], np.ndarray]


def boost_table(examples: DataFrame, width: int) -> Forest | None:
    """A forest for rows of ``label, features`` (0 or 1, ``width`` numbers), saved ones; None without both labels.

    Gradient boosting for log loss with Newton leaf values, on quantile bins, as ``dom_boost.boost``.
    """
    cuts = [i / BINS for i in range(1, BINS)]
    quantiles = [F.percentile(F.col("features")[f].cast("double"), F.array(*map(F.lit, cuts))).alias(str(f)) for f in range(width)]
    found = examples.agg(F.count("*").alias("n"), F.sum(F.col("label").cast("bigint")).alias("right"), *quantiles).first()
    if not found["n"] or found["right"] in (0, found["n"]):
        return None
    edges = [np.unique(found[str(f)]) for f in range(width)]
    sums = _at_once(examples, edges) if found["n"] <= DRIVER_ROWS else _by_tasks(examples, edges)
    share = min(max(found["right"] / found["n"], 1e-3), 1 - 1e-3)
    forest = Forest(float(np.log(share / (1 - share))), np.zeros((0, INNER), np.int64), np.zeros((0, INNER)), np.zeros((0, INNER + 1)))
    random = np.random.default_rng(11)
    for _ in range(TREES):
        # Half of the features to a tree, so that none stands in for all others.
        offered = sorted(random.choice(width, -(-width // 2), replace=False).tolist())
        tree = np.zeros(INNER, dtype=np.int64), np.full(INNER, np.inf)
        for level in range(DEPTH):
            _split(tree, level, offered, edges, sums(forest, tree, level, offered))
        gradient, hessian = sums(forest, tree, DEPTH, [])[:, :, 0, 0] / UNIT
        value = RATE * gradient / (hessian + 1)
        forest = Forest(forest.base, np.vstack([forest.feature, tree[0]]), np.vstack([forest.threshold, tree[1]]), np.vstack([forest.value, value]))
    return forest


def _split(tree: Tree, level: int, offered: list[int], edges: list[np.ndarray], total: np.ndarray) -> None:
    """Divide the nodes of ``level`` where that gains most; of equal gains the first feature and bin."""
    g, h = total.cumsum(axis=3) / UNIT
    gl, hl, gt, ht = g[:, :, :-1], h[:, :, :-1], g[:, :, -1:], h[:, :, -1:]
    gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
    for i, f in enumerate(offered):
        gain[:, i, len(edges[f]) :] = -1  # there is no edge
    for k in range(2**level):
        i, at = np.unravel_index(gain[k].argmax(), gain[k].shape)
        if gain[k, i, at] > 1e-9:
            tree[0][2**level - 1 + k], tree[1][2**level - 1 + k] = offered[i], edges[offered[i]][at]


def _sums(x: np.ndarray, y: np.ndarray, forest: Forest, tree: Tree, level: int, offered: list[int], edges: list[np.ndarray]) -> np.ndarray:
    """Units of gradient and hessian by node of ``level``, offered feature and bin; without features by node alone."""
    p = 1 / (1 + np.exp(-forest.log_odds(x)))
    units = [np.rint((y - p) * UNIT), np.rint(np.maximum(p * (1 - p), 1e-6) * UNIT)]
    node, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
    for _ in range(level):
        node = 2 * node + 1 + (x[rows, tree[0][node]] > tree[1][node])
    node -= 2**level - 1
    out = np.zeros((2, 2**level, max(1, len(offered)), BINS), dtype=np.int64)
    for i in range(out.shape[2]):
        bins = np.searchsorted(edges[offered[i]], x[:, offered[i]], side="left") if offered else 0
        for part, unit in enumerate(units):
            out[part, :, i] = np.bincount(node * BINS + bins, unit, 2**level * BINS).reshape(2**level, BINS)
    return out


def _matrix(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    labels = batch.column("label").to_numpy().astype(np.float64)
    return np.stack(batch.column("features").to_numpy(zero_copy_only=False)).astype(np.float64) if len(labels) else np.zeros((0, 0)), labels


def _at_once(examples: DataFrame, edges: list[np.ndarray]) -> Sums:
    x, y = _matrix(examples.select("label", "features").toArrow().combine_chunks().to_batches()[0])
    return lambda forest, tree, level, offered: _sums(x, y, forest, tree, level, offered, edges)


def _by_tasks(examples: DataFrame, edges: list[np.ndarray]) -> Sums:
    def total(forest: Forest, tree: Tree, level: int, offered: list[int]) -> np.ndarray:
        @gives_back
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = sum(_sums(*_matrix(batch), forest, tree, level, offered, edges) for batch in batches if len(batch))
            if not isinstance(parts, int):
                flat = parts.reshape(2, -1)
                cells = np.flatnonzero(flat.any(axis=0))
                yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(flat[0, cells]), pa.array(flat[1, cells])], names=["cell", "g", "h"])

        out = np.zeros((2, 2**level, max(1, len(offered)), BINS), dtype=np.int64)
        flat = out.reshape(2, -1)
        parts = examples.select("label", "features").mapInArrow(run, "cell int, g bigint, h bigint")
        for row in parts.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
            flat[:, row["cell"]] = row["g"], row["h"]
        return out

    return total
