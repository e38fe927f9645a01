"""The prefix trie of conversations, with subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns. Its name is the smallest conversation that begins with
it, together with its depth; so names are exact, and only the grouping of equal prefixes goes by a
fingerprint (two 64-bit hashes of place, role and text of every turn, summed).

Totals: round by round, all leaves are raked into their parents and half of every unary chain is
spliced out, each spliced node into its parent; the rounds needed grow with the logarithm of the
depth, and every round is a few joins on node names. What was removed is then put back in reverse
order: a raked node's total is what it had gathered, a spliced one's adds the total of the child
it had. Every join is on unique names, so neither a node with a million children nor a conversation
with a third of all turns gathers in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emploiscope.llm.text import gives_back
from emploiscope.llm.workspace import Workspace, shuffle_partitions

NODE = ["conv_id", "depth"]
PARENT = ["parent_conv_id", "parent_depth"]
CHILD = ["child_conv_id", "child_depth"]
# Ends of a node are listed by blocks of so many consecutive numbers before they are hashed in order.
IDS_PER_BLOCK = 4096


def ordered_turns(conversations: DataFrame, work: Workspace) -> DataFrame:
    """``conv_id, place, role, text``: the turns of every conversation, numbered from 1.

    Order: turn (null first), then role, then text, nulls as empty. Rows are range-partitioned by that order,
    numbered within each range of a conversation, and the ranges laid end to end.
    """
    empty = F.lit("")
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    ).filter("conv_id IS NOT NULL")
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    dealt = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), "conv_id", *order).withColumn("piece", F.spark_partition_id())
    dealt = work.save(dealt, "turns")
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    begins = dealt.groupBy("conv_id", "piece").agg(F.count("*").alias("n")).withColumn("begin", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("conv_id", "piece").orderBy(*order)
    numbered = dealt.withColumn("at", F.row_number().over(inside)).join(begins, ["conv_id", "piece"])
    return numbered.select("conv_id", "piece", (F.col("begin") + F.col("at")).alias("place"), "role", "text")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """Every conversation with the first turns of its series' head before what follows its own.

    Conversation c takes the first h turns of conversation c - c % 20, h being crc32(c) % 4 of its
    number in decimal, and keeps its own turns after the first h.
    """
    ids = turns.select("conv_id").distinct()
    ids = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 20).alias("head"), (F.crc32(F.col("conv_id").cast("string")) % 4).alias("h"))
    heads = turns.filter((F.col("conv_id") % 20 == 0) & (F.col("place") < 4)).withColumnRenamed("conv_id", "head")
    borrowed = ids.join(heads, "head").filter("place <= h").select("conv_id", "piece", "place", "role", "text")
    own = turns.filter(F.col("place") > F.crc32(F.col("conv_id").cast("string")) % 4)
    return borrowed.withColumn("piece", F.lit(-1)).union(own)


def _prefixes(rebuilt: DataFrame, work: Workspace) -> DataFrame:
    """``conv_id, depth, k1, k2, last1, last2, words, is_end``: a fingerprint of every prefix of every conversation.

    Depths count rebuilt turns without gaps: where the head had fewer turns than were asked for,
    own turns move up. Numbers and sums run within each piece first.
    """
    order = Window.partitionBy("conv_id", "piece").orderBy("place")
    rows = rebuilt.select("conv_id", "piece", "place", "role", "text", F.size(F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))).cast("bigint").alias("words"))
    rows = work.save(rows.withColumn("at", F.row_number().over(order)).drop("place"), "rebuilt")
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.groupBy("conv_id", "piece").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("conv_id")
    counted = counted.select("conv_id", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"), F.sum("n").over(whole).alias("length"))
    rows = rows.join(counted, ["conv_id", "piece"]).withColumn("depth", F.col("begin") + F.col("at"))
    wide = "decimal(38,0)"
    rows = rows.select(
        *["conv_id", "piece", "depth", "words"],
        (F.col("depth") == F.col("length")).alias("is_end"),
        F.xxhash64("depth", "role", "text").cast(wide).alias("h1"),
        F.xxhash64(F.lit("second"), "text", "depth", "role").cast(wide).alias("h2"),
    )
    sums = rows.groupBy("conv_id", "piece").agg(F.sum("h1").alias("s1"), F.sum("h2").alias("s2"))
    zero = F.lit(0).cast(wide)
    sums = sums.select("conv_id", "piece", *[F.coalesce(F.sum(s).over(before), zero).alias(s) for s in ("s1", "s2")])
    so_far = Window.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(sums, ["conv_id", "piece"])
    keys = [(F.col(f"s{i}") + F.sum(f"h{i}").over(so_far)).cast(wide).alias(f"k{i}") for i in (1, 2)]
    return rows.select("conv_id", "depth", "words", "is_end", "h1", "h2", *keys)


def _nodes(prefixes: DataFrame, ids: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """``conv_id, depth, parent_conv_id, parent_depth, n_convs, saved`` of every node, and ``conv_id, depth, end`` of every conversation."""
    prefixes = work.save(prefixes, "prefixes")
    key = ["depth", "k1", "k2"]
    found = prefixes.groupBy(*key).agg(F.min("conv_id").alias("first"), F.count("*").alias("n_convs"), *[F.first(c).alias(c) for c in ("words", "h1", "h2")])
    found = work.save(found, "found")
    # A node of one conversation has that conversation's own prefix as its parent, unless others share it.
    shared = found.filter("n_convs > 1").select(F.col("first").alias("parent_conv_id"), *key)
    above = found.select("first", "n_convs", "words", F.col("depth").alias("at"), (F.col("depth") - 1).alias("depth"), *[(F.col(f"k{i}") - F.col(f"h{i}")).cast("decimal(38,0)").alias(f"k{i}") for i in (1, 2)])
    # Parents with a thousandth of all nodes as children are few; their children are joined without a shuffle.
    least = max(1000, found.count() // 1000)
    hot = above.groupBy(*key).count().filter(F.col("count") > least).drop("count").join(shared, key)
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    top = above.filter("depth = 0").crossJoin(F.broadcast(root.select(F.col("conv_id").alias("parent_conv_id"))))
    below = above.filter("depth > 0").join(F.broadcast(hot.withColumnRenamed("parent_conv_id", "hot")), key, "left")
    settled, open_ = below.filter("hot IS NOT NULL").withColumn("parent_conv_id", F.col("hot")), below.filter("hot IS NULL").join(shared, key, "left")
    columns = ["first", "at", "parent_conv_id", "n_convs", "words"]
    rows = top.select(*columns).union(settled.select(*columns)).union(open_.select(*columns))
    depth = F.col("at").cast("bigint")
    nodes = rows.select(
        F.col("first").alias("conv_id"),
        depth.alias("depth"),
        F.coalesce("parent_conv_id", "first").alias("parent_conv_id"),
        (depth - 1).alias("parent_depth"),
        "n_convs",
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    none, zero = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    root = root.filter("n_convs > 0").select("conv_id", zero.alias("depth"), none.alias("parent_conv_id"), none.alias("parent_depth"), "n_convs", zero.alias("saved"))
    ends = prefixes.filter("is_end").select(F.col("conv_id").alias("end"), *key).join(found.select("first", *key), key)
    ends = ends.select(F.col("first").alias("conv_id"), F.col("depth").cast("bigint").alias("depth"), "end")
    turnless = ids.join(prefixes.filter("depth = 1").select("conv_id"), "conv_id", "left_anti").select(F.col("conv_id").alias("end"))
    turnless = turnless.crossJoin(F.broadcast(root.select("conv_id", "depth"))).select("conv_id", "depth", "end")
    return work.save(nodes.union(root), "nodes"), ends.union(turnless)


def subtree_totals(nodes: DataFrame, weights: list[str], work: Workspace) -> DataFrame:
    """The sums of ``weights`` over the subtree of every node, its top included.

    ``nodes`` has unique names (``NODE``), the parent's name (``PARENT``, null for roots) with a
    smaller depth, and non-null whole-number weights.
    """
    active = nodes.select(*NODE, *PARENT, *weights)
    longest = nodes.agg(F.max("depth")).head()[0] or 0
    bits = max(1, int(longest).bit_length())
    below_root = F.col("parent_depth").isNotNull()
    rounds: list[DataFrame] = []
    left = longest
    while left:
        children = active.filter(below_root).groupBy(*PARENT)
        children = children.agg(F.count("*").alias("n"), *[F.min(a).alias(b) for a, b in zip(NODE, CHILD, strict=True)])
        children = children.select(*[F.col(a).alias(b) for a, b in zip(PARENT, NODE, strict=True)], "n", *CHILD)
        bit = F.lit(1 << (len(rounds) % bits)).cast("bigint")
        # Chain neighbours are told apart by a bit of their depths, so no two that touch are spliced at once.
        splice = below_root & (F.col("n") == 1) & (F.col("depth").bitwiseAND(bit) > 0) & (F.col("parent_depth").bitwiseAND(bit) == 0)
        seen = active.join(children, NODE, "left").withColumn("spliced", F.coalesce(splice, F.lit(False)))
        moved = seen.filter("spliced").select(*[F.col(a).alias(b) for a, b in zip(CHILD, NODE, strict=True)], *[F.col(a).alias(f"new_{a}") for a in PARENT])
        # A leaf that gets a new parent in this round waits for the next.
        raked = F.col("n").isNull() & below_root & F.col("new_parent_depth").isNull()
        parents = [F.coalesce(f"new_{a}", a).alias(a) for a in PARENT]
        seen = seen.join(moved, NODE, "left").select(*NODE, *parents, *weights, *CHILD, "spliced", raked.alias("raked"))
        seen = work.save(seen, "round")
        rounds.append(seen)
        gained = seen.filter("spliced OR raked").groupBy(*PARENT).agg(*[F.sum(w).alias(f"more_{w}") for w in weights])
        gained = gained.select(*[F.col(a).alias(b) for a, b in zip(PARENT, NODE, strict=True)], *[f"more_{w}" for w in weights])
        added = [(F.col(w) + F.coalesce(f"more_{w}", F.lit(0))).alias(w) for w in weights]
        kept = seen.filter("NOT (spliced OR raked)")
        active = kept.join(gained, NODE, "left").select(*NODE, *PARENT, *added)
        left = not kept.filter(below_root).isEmpty()
    totals = active.select(*NODE, *weights)
    for seen in reversed(rounds):
        known, spliced = totals.union(seen.filter("raked").select(*NODE, *weights)), seen.filter("spliced").drop(*PARENT)
        child = totals.select(*[F.col(a).alias(b) for a, b in zip(NODE, CHILD, strict=True)], *[F.col(w).alias(f"more_{w}") for w in weights])
        expanded = spliced.join(child, CHILD).select(*NODE, *[(F.col(w) + F.col(f"more_{w}")).alias(w) for w in weights])
        totals = work.save(known.union(expanded), "totals")
    return totals


@gives_back
def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of ids sorted by node: hashed as they come, a node's state being all that is held."""
    name, state, names, digests = None, None, [], []
    for batch in batches:
        for conv_id, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids")), strict=True):
            if (conv_id, depth) == name:
                state.update(b",")
            else:
                if name is not None:
                    names.append(name)
                    digests.append(state.hexdigest())
                name, state = (conv_id, depth), hashlib.sha256()
            state.update(ids.encode())
        yield _digests(names, digests)
        names, digests = [], []
    if name is not None:
        yield _digests([name], [state.hexdigest()])


def _digests(names: list[tuple[int, int]], digests: list[str]) -> pa.RecordBatch:
    ids, depths = ([n[k] for n in names] for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(depths, pa.int64()), pa.array(digests, pa.string())], names=[*NODE, "ends_sha256"])


def ends_digests(ends: DataFrame) -> DataFrame:
    """``conv_id, depth, ends_sha256`` of nodes where conversations end.

    SHA-256 runs through a node's list from front to back, so a list can't be hashed in parts. It is
    gathered in blocks of neighbouring numbers, and a task streams the blocks without holding them.
    """
    # Rounds down for numbers below zero as well.
    block = F.floor(F.col("end") / F.lit(IDS_PER_BLOCK).cast("decimal(20,0)"))
    listed = ends.groupBy(*NODE, block.alias("block")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("end")), lambda x: x.cast("string")), ",").alias("ids"))
    listed = listed.repartition(shuffle_partitions(ends.sparkSession), *NODE).sortWithinPartitions(*NODE, "block")
    return listed.select(*NODE, "ids").mapInArrow(_hash_ends, "conv_id bigint, depth bigint, ends_sha256 string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """Every node of the trie of rebuilt ``conversations(conv_id, turn, role, text)``.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Turns are ordered by turn, nulls
    first, then by role and text; repeated rows are turns each. Null roles and texts are empty. Rows
    without a conv_id belong to no conversation and are left out. Other columns are ignored. An
    empty table gives an empty table, without a root.
    """
    work = Workspace(conversations.sparkSession, "prefix-trie")
    turns = work.save(ordered_turns(conversations, work), "ordered")
    ids = work.save(turns.select("conv_id").distinct(), "ids")
    nodes, ends = _nodes(_prefixes(rebuilt_turns(turns), work), ids, work)
    children = nodes.filter("parent_depth IS NOT NULL").groupBy(*PARENT).agg(F.count("*").alias("n_children"))
    children = children.select(*[F.col(a).alias(b) for a, b in zip(PARENT, NODE, strict=True)], "n_children")
    nodes = nodes.join(children, NODE, "left").fillna(0, ["n_children"])
    nodes = work.save(nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("bigint")).withColumnRenamed("saved", "saved_tokens"), "counted")
    totals = subtree_totals(nodes, ["n_leaves", "saved_tokens"], work)
    out = nodes.drop("n_leaves", "saved_tokens").join(totals, NODE).join(ends_digests(ends), NODE, "left")
    digest = F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest)
