"""Byte-balanced shards of indivisible groups, by Karmarkar-Karp differencing.

Documents with equal texts form a group and go to one shard. Differencing needs all items in one
place, so its input is bounded first: a group heavier than 1 / (2 * ``BUNDLES``) of all bytes is an
item of its own (fewer than 2 * ``BUNDLES`` of them can exist), and all lighter groups travel in
``BUNDLES`` bundles chosen by the hash of their text. At most 3 * ``BUNDLES`` rows reach the driver,
whatever the size of the corpus; groups, sizes, places and slots are computed by Spark.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emploiscope.llm.workspace import Workspace

BUNDLES = 6144
SLOT_ROWS = 50_000
ROW_BYTES = 8


def difference(sizes: Sequence[int], shards: int) -> list[int]:
    """The shard of every item.

    Every item starts as a partial partition that holds it in one part and nothing in the others.
    The two partial partitions with the largest spread between their heaviest and lightest part are
    combined again and again, the heaviest part of one with the lightest of the other, until one is
    left. Equal spreads are taken in the order of the items.
    """
    # A part is (bytes, node); a node is an item or two nodes, so that combining costs no copying.
    nodes: list[tuple[int, int] | None] = [None] * len(sizes)
    heap = []
    for item, size in enumerate(sizes):
        heap.append((-size, item, [(0, -1)] * (shards - 1) + [(size, item)]))
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        parts = []
        for (x, i), (y, j) in zip(a, reversed(b), strict=True):
            if i < 0 or j < 0:
                parts.append((x + y, max(i, j)))
            else:
                nodes.append((i, j))
                parts.append((x + y, len(nodes) - 1))
        parts.sort()
        least = parts[0][0]
        parts = [(size - least, node) for size, node in parts]
        heapq.heappush(heap, (-parts[-1][0], serial, parts))
        serial += 1
    out = [0] * len(sizes)
    for shard, (_, root) in enumerate(heap[0][2] if heap else []):
        pending = [root] if root >= 0 else []
        while pending:
            node = pending.pop()
            if nodes[node] is None:
                out[node] = shard
            else:
                pending += nodes[node]
    return out


def shard_documents(docs: DataFrame, shards: int = 24, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and the columns of ``carry``, per row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 8 for the row. The law is ``bytes``: shards are as equal
    in size as indivisible groups allow, so a group heavier than a shard's share has a shard almost
    to itself. ``slot`` counts from 0 without gaps in each shard; repeated rows get a slot each.
    Null and empty texts have no bytes, checksum 0, and form one group. Null doc_ids are carried.
    ``grown_shard`` is null under this law. Columns not in ``carry`` are ignored, so their names
    cannot clash; a name in ``carry`` that the result uses itself is refused. An empty table gives
    an empty table.
    """
    own = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    if clash := set(carry) & set(own):
        raise ValueError(f"columns of the result can't be carried: {sorted(clash)}")
    work = Workspace(docs.sparkSession, "shards")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("group"),
        *carry,
    )
    sizes = rows.select("doc_id", "size", "text_crc32", "group")
    rows = work.save(sizes, "rows") if not carry else rows
    groups = work.save(rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups")
    total, count = groups.agg(F.sum("bytes"), F.sum("n")).head()
    heavy = groups.filter(F.col("bytes") > F.lit((total or 0) // (2 * BUNDLES))).select("group", F.col("group").alias("item"))
    bundle = F.pmod(F.xxhash64("group"), F.lit(BUNDLES)).cast("string")
    item = F.coalesce("item", bundle)
    items = groups.join(F.broadcast(heavy), "group", "left").groupBy(item.alias("item")).agg(F.sum("bytes").alias("bytes"))
    listed = sorted(items.collect(), key=lambda r: (-r["bytes"], r["item"]))
    places = list(zip([r["item"] for r in listed], difference([r["bytes"] for r in listed], shards), strict=True))
    shard_of = work.save(docs.sparkSession.createDataFrame(places, "item string, shard int"), "items")
    placed = rows.join(F.broadcast(heavy), "group", "left").withColumn("item", item).join(F.broadcast(shard_of), "item")
    return _slots(placed, shards, count or 0, carry, work)


def _slots(placed: DataFrame, shards: int, count: int, carry: Sequence[str], work: Workspace) -> DataFrame:
    """Gapless slots without a task that holds a shard: each shard is numbered in pieces, laid end to end."""
    pieces = max(1, -(-count // (shards * SLOT_ROWS)))
    placed = placed.withColumn("piece", F.pmod(F.xxhash64("doc_id", "group"), F.lit(pieces)))
    placed = work.save(placed.select("doc_id", "size", "text_crc32", "group", "shard", "piece", *carry), "placed")
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    begin = placed.groupBy("shard", "piece").agg(F.count("*").alias("n")).withColumn("begin", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = Window.partitionBy("shard", "piece").orderBy("doc_id", "group")
    numbered = placed.withColumn("at", F.row_number().over(inside) - 1).join(begin.select("shard", "piece", "begin"), ["shard", "piece"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("begin") + F.col("at")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *carry
    )
