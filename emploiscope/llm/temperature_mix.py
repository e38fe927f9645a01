"""Mixing sources to target weights by temperature, realised as budgeted permutations of blocks.

A source's weight is its share of all tokens to the power of an exponent between 0 (all alike) and
1 (in proportion), normalised. Bisection finds the largest exponent whose weights reach the target
entropy, but never one at which some source would be repeated more often than allowed. The token
budget is the smallest that uses every document at least once, so nothing is dropped; each source
is gone through a whole number of times and once more up to its budget. Every pass over a source is
a fresh permutation of its blocks, and of the documents inside a block.

Everything is a DataFrame expression. Sources are a table throughout: bisection asks for sums over
it, a few steps at a time, and only the sums reach the driver. No window holds more than the blocks
of one source or the documents of one block.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emploiscope.llm.workspace import BROADCAST_KEYS, Workspace

ENTROPY_SHARE = 0.999
MAX_REPEATS = 1.5
BLOCK_TOKENS = 50_000
DIGITS = 6
STEPS_PER_QUERY = 5
WHITE_RUN = "[ \t\n\x0b\x0c\r]+"


@dataclass(frozen=True)
class Target:
    """``entropy_share``: wanted entropy of the weights, over that of equal ones; ``max_repeats``: passes over any source at most."""

    entropy_share: float = ENTROPY_SHARE
    max_repeats: float = MAX_REPEATS


def _doc_key() -> F.Column:
    content = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    return F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), content)


def _hash(*parts) -> F.Column:
    """A number below 2**32 from the texts of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts).cast("binary")), 1, 8), 16, 10).cast("bigint")


def _grid(low: int, high: int) -> list[int]:
    """All the midpoints that the next few bisection steps could ask for, in units of the last digit."""
    points, spans = [], [(low, high)]
    for _ in range(STEPS_PER_QUERY):
        following = []
        for a, b in spans:
            if b - a > 1:
                middle = (a + b) // 2
                points.append(middle)
                following += [(a, middle), (middle, b)]
        spans = following
    return points


def find_exponent(sources: DataFrame, target: Target) -> float:
    """The exponent for ``sources(tokens)``, to ``DIGITS`` decimals.

    Entropy falls and the largest repetition, (largest / smallest) ** (1 - exponent), falls too as
    the exponent grows. The repetition limit comes first: the exponent is the larger of the one
    that reaches the entropy and the one that keeps the limit.
    """
    one = 10**DIGITS
    used = sources.filter("tokens > 0")
    n, largest, smallest, total = used.agg(F.count("*"), F.max("tokens"), F.min("tokens"), F.sum("tokens")).head()
    if not n or n == 1:
        return 1.0
    limits = F.lit(target.entropy_share) * F.log(F.lit(float(n)))

    def bisect(holds: str) -> int:
        """The largest exponent for entropy, the smallest for repetition, at which the wanted side holds."""
        low, high = 0, one
        while high - low > 1:
            points = _grid(low, high)
            grid = used.select((F.col("tokens") / F.lit(total)).alias("share"), F.explode(F.array(*[F.lit(p) for p in points])).alias("point"))
            power = F.pow("share", F.col("point") / F.lit(one))
            sums = grid.groupBy("point").agg(F.sum(power).alias("z"), F.sum(power * F.log(power)).alias("s"))
            entropy = F.log("z") - F.col("s") / F.col("z")
            repeats = F.pow(F.lit(largest / smallest), 1 - F.col("point") / F.lit(one))
            rows = sums.select("point", (entropy >= limits).alias("entropy"), (repeats > F.lit(target.max_repeats)).alias("repeats")).collect()
            upper = {r["point"]: r[holds] for r in rows}
            for _ in range(STEPS_PER_QUERY):
                if high - low > 1:
                    middle = (low + high) // 2
                    low, high = (middle, high) if upper[middle] else (low, middle)
        return low

    # At exponent 1 nothing is repeated; if even that has the entropy, tokens stay in proportion.
    natural = used.agg(F.log(F.lit(float(total))) - F.sum(F.col("tokens") * F.log("tokens")) / F.lit(float(total))).head()[0]
    by_entropy = one if natural >= target.entropy_share * used.select(F.log(F.lit(float(n)))).head()[0] else bisect("entropy")
    if by_entropy == one or largest == smallest:
        return by_entropy / one
    allowed = 0 if largest / smallest <= target.max_repeats else bisect("repeats") + 1
    return max(by_entropy, allowed) / one


def mixed_documents(docs: DataFrame, target: Target | None = None, seed: str = "mix") -> DataFrame:
    """``docs`` with every row as often as the mixture uses it, columns as they are; no order is implied.

    Texts are not shuffled while the rows used more than once are few. Rows that repeat a doc_id
    and its text share their uses evenly, rounded up.
    """
    work = Workspace(docs.sparkSession, "mixed")
    used = _uses(docs, target, seed, ()).groupBy("doc_key").agg(F.count("*").alias("uses"), F.count_if(F.col("epoch") == 0).alias("copies"))
    more = used.select(F.col("doc_key").alias("_doc_key"), F.ceil(F.col("uses") / F.col("copies")).cast("int").alias("_times")).filter("_times > 1")
    more = work.save(more, "used-again")
    more = F.broadcast(more) if more.count() <= BROADCAST_KEYS else more
    every = docs.withColumn("_doc_key", _doc_key()).join(more, "_doc_key", "left")
    every = every.withColumn("_use", F.explode(F.sequence(F.lit(1), F.coalesce("_times", F.lit(1)))))
    return every.select(*docs.columns)


def mix_sources(docs: DataFrame, target: Target | None = None, seed: str = "mix", carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, source, n_tokens, epoch, block, slot, exponent`` and ``carry``: one row per use of a document.

    ``docs(doc_id, text, source)``; tokens are words between ASCII white space. ``epoch`` counts the
    passes over a source from 0; ``block`` is a place in the order of blocks of the source and pass,
    ``slot`` one inside the block, both from 0 without gaps. Epoch 0 holds every row, so nothing is
    lost; the last pass stops once the source's tokens reach its budget, inside a block if need be.
    A source without tokens is used once. A null source is a source of its own; null and empty texts
    have no tokens. Repeated rows are rows of their own, with ties in any order. Null doc_ids are
    carried. Columns not in ``carry`` are ignored, and ``carry`` may not name a column of the
    result. An empty table gives none.
    """
    own = ["doc_id", "source", "n_tokens", "epoch", "block", "slot", "exponent"]
    if clash := set(carry) & set(own):
        raise ValueError(f"columns of the result can't be carried: {sorted(clash)}")
    return _uses(docs, target, seed, carry).drop("doc_key")


def _uses(docs: DataFrame, target: Target | None, seed: str, carry: tuple[str, ...]) -> DataFrame:
    target = target or Target()
    work = Workspace(docs.sparkSession, "mix")
    text = F.btrim(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    n_tokens = F.when(text == "", 0).otherwise(F.size(F.split(text, WHITE_RUN, -1)))
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    rows = docs.select("doc_id", source.alias("key"), n_tokens.cast("bigint").alias("n_tokens"), _doc_key().alias("doc_key"), *carry)
    counted = work.save(rows.select("key", "doc_key", "n_tokens"), "tokens")
    sources = work.save(counted.groupBy("key").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents")), "sources")
    exponent = find_exponent(sources, target)
    largest = sources.agg(F.max("tokens")).head()[0]
    # repeats = (largest / tokens) ** (1 - exponent): the largest source is used exactly once.
    budget = F.when(F.col("tokens") > 0, F.floor(F.col("tokens") * F.pow(F.lit(float(largest or 0)) / F.col("tokens"), F.lit(1 - exponent)) + 1e-6)).otherwise(0).cast("bigint")
    plan = sources.withColumn("budget", F.greatest(budget, "tokens"))
    plan = plan.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.greatest(F.col("tokens"), F.col("documents")) / F.lit(BLOCK_TOKENS))).cast("bigint"))
    plan = plan.withColumn("passes", F.when(F.col("tokens") > 0, F.ceil(F.col("budget") / F.col("tokens"))).otherwise(1).cast("int"))
    plan = work.save(plan.select("key", "tokens", "budget", "blocks", "passes"), "plan")

    home = F.pmod(_hash(F.lit(seed), "doc_key"), F.col("blocks"))
    # Blocks of every pass in their permuted order, and how many tokens come before each.
    filled = counted.join(plan, "key").withColumn("home", home).groupBy("key", "home").agg(F.sum("n_tokens").alias("held"))
    every = filled.join(plan, "key").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
    order = Window.partitionBy("key", "epoch").orderBy(_hash(F.lit(seed), F.lit("block"), "key", F.col("epoch").cast("string"), F.col("home").cast("string")), "home")
    placed = every.withColumn("block", F.row_number().over(order) - 1)
    placed = placed.withColumn("before", F.coalesce(F.sum("held").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = placed.withColumn("room", F.col("budget") - F.col("epoch") * F.col("tokens") - F.col("before"))
    placed = work.save(placed.filter("room > 0 or epoch = 0").select("key", "home", "epoch", "block", "room", F.col("tokens").alias("of")), "blocks")

    keyed = rows.join(F.broadcast(plan.select("key", "blocks")) if plan.count() <= 100_000 else plan.select("key", "blocks"), "key").withColumn("home", home)
    used = keyed.drop("blocks").join(placed, ["key", "home"])
    inside = Window.partitionBy("key", "home", "epoch").orderBy(_hash(F.lit(seed), F.col("epoch").cast("string"), "doc_key"), "doc_key")
    used = used.withColumn("slot", F.row_number().over(inside) - 1)
    used = used.withColumn("so_far", F.coalesce(F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # A document is used while the budget is not yet met, so a pass overshoots by less than one document.
    used = used.filter("epoch = 0 or so_far < room")
    name = F.when(F.col("key") != "", F.expr("substring(key, 2)"))
    return used.select("doc_key", "doc_id", name.alias("source"), "n_tokens", "epoch", F.col("block").cast("int").alias("block"), F.col("slot").cast("int").alias("slot"), F.lit(exponent).alias("exponent"), *carry)
