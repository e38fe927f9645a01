"""Similarity join of documents by the Jaccard coefficient of their word shingles.

T-occurrence search in the manner of DivideSkip, laid out for shuffles. A document is the sorted
list of its shingles' 64-bit hashes; every shingle has an inverted list of the documents that hold
it. A partner with similarity t or more occurs in at least T = ceil(t * n) of a document's n lists.
The lists are divided:

* *Short lists* (at most ``LONG`` documents) are merged: sorted by shingle in the shuffle, each is
  read once, and the occurrences of every pair in it are counted. A pair stays a candidate while
  its count, with the L long lists that both have added, can reach T (T - L occurrences in short
  lists are required).
* *Long lists* (hot passages, large groups of near copies) are never merged into pairs. They are
  skipped by every document whose short lists suffice, and their shingles are looked up by binary
  search in the candidate's sorted shingles.

A document needs only n - T + 1 of its lists for no partner to be missed, the same order of
shingles (short lists before long ones) holding for all. The first round therefore lists only the
shingles below a fixed share of the hash range, and further ones where these are fewer than needed.
Documents with a long list among them and too few short lists below the share, and so with partners
only among each other, go through a second round that lists all their shingles.
Documents that are still short of lists consist of hot text for more than 1 - t; they keep their
rarest long lists, up to the number needed. Such a list compares everybody with a few pivots and joins
what is linked. Members that are then still outside their list's largest class are few; they become
a query set that is searched for, in blocks of bounded size, among all members of such lists.

Equal sets are one record throughout, so exact copies cost one row each. Results do not depend on
``LONG``, ``LISTED``, ``PIVOTS``, ``BROADCAST_IDS`` or ``BLOCK_SHINGLES``; they set only the work.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emploiscope.llm.components import components
from emploiscope.llm.text import SPACED, U, blocks, gives_back, mix, shingle_sets, words
from emploiscope.llm.workspace import Workspace, shuffle_partitions, without

LONG = 16
LISTED = 0.3
PIVOTS = 4
BROADCAST_IDS = 500_000
BLOCK_SHINGLES = 4_000_000

_POSTED = "bucket int, key bigint, doc_id bigint, n bigint, listed bigint, record bigint, shingles binary, records binary"
_MERGED = "kind int, doc_id bigint, n bigint, listed bigint, a bigint, b bigint"
_DOCUMENT, _PAIR, _LONG_LIST = 0, 1, 2


def needed_lists(n, percent: int):
    """How many of a document's ``n`` lists no partner can avoid: n - T + 1 with T = ceil(n * percent / 100)."""
    return n - (n * percent + 99) // 100 + 1


def record_id(shingles: np.ndarray) -> np.int64:
    """A fingerprint of a set of shingles."""
    return mix(mix(shingles).sum(dtype=np.uint64)[None] + U(len(shingles))).view(np.int64)[0]


def _post(buckets: int, size: int, percent: int, share: float):
    """Postings of the shingles in the lowest ``share`` of the hash range and of each text's needed lists."""
    last = U(min(int(share * 2**64), 2**64 - 1))

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, listed, records, posted, owners = [], [], [], [], [], []
            seen: set[int] = set()
            for low, high, data, offsets in blocks(batch.column("text")):
                for shingles in shingle_sets(words(data, offsets, SPACED), size):
                    n = len(shingles)
                    below = int(np.searchsorted(shingles, last, side="right"))
                    record = record_id(shingles)
                    counts.append(n)
                    listed.append(below)
                    records.append(record)
                    if n and record not in seen:
                        seen.add(record)
                        kept = shingles[: max(below, needed_lists(n, percent))]
                        posted.append(kept)
                        owners.append(np.full(len(kept), record, dtype=np.int64))
            n = len(counts)
            yield _posted_batch(
                np.arange(n) % buckets, batch.column("key"), batch.column("doc_id"), counts, listed, records, [None] * n, [None] * n
            )
            if posted:
                posted, owners = np.concatenate(posted), np.concatenate(owners)
                bucket = (mix(posted) % U(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                bucket, posted, owners = bucket[order], posted[order], owners[order]
                edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
                spans = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
                none = [None] * len(spans)
                yield _posted_batch(
                    bucket[edges[:-1]], none, none, none, none, none, [posted[a:b].tobytes() for a, b in spans], [owners[a:b].tobytes() for a, b in spans]
                )

    return run


def _posted_batch(bucket, key, doc_id, n, listed, record, shingles, records) -> pa.RecordBatch:
    longs = [pa.array(x, type=pa.int64()) if isinstance(x, list) else x for x in (key, doc_id, n, listed, record)]
    arrays = [pa.array(bucket, type=pa.int32()), *longs, pa.array(shingles, type=pa.binary()), pa.array(records, type=pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", "key", "doc_id", "n", "listed", "record", "shingles", "records"])


def _merged_batch(kind: int, **columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    arrays = [pa.array(np.full(n, kind, dtype=np.int32))]
    for name in ("doc_id", "n", "listed", "a", "b"):
        x = columns.get(name)
        arrays.append(pa.nulls(n, pa.int64()) if x is None else x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, type=pa.int64()))
    return pa.RecordBatch.from_arrays(arrays, names=["kind", "doc_id", "n", "listed", "a", "b"])


def _merge(share: float):
    last = U(min(int(share * 2**64), 2**64 - 1))
    return gives_back(lambda batches: _merge_lists(batches, last))


def _merge_lists(batches: Iterator[pa.RecordBatch], last: np.uint64) -> Iterator[pa.RecordBatch]:
    """The inverted lists of one partition: short ones give pairs, long ones are passed on as they are."""
    shingles, owners = [], []
    for batch in batches:
        mine = batch.filter(pa.compute.is_valid(batch.column("record")))
        if len(mine):
            columns = {x: mine.column(x) for x in ("doc_id", "n", "listed")}
            yield _merged_batch(_DOCUMENT, **columns, a=mine.column("record"), b=mine.column("key"))
        for s, r in zip(batch.column("shingles"), batch.column("records"), strict=True):
            if s.is_valid:
                shingles.append(np.frombuffer(s.as_buffer(), dtype=np.uint64).copy())
                owners.append(np.frombuffer(r.as_buffer(), dtype=np.int64).copy())
    if not shingles:
        return
    shingle, owner = np.concatenate(shingles), np.concatenate(owners)
    del shingles, owners
    order = np.lexsort((owner, shingle))
    shingle, owner = shingle[order], owner[order]
    new = np.ones(len(shingle), dtype=bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])
    shingle, owner = shingle[new], owner[new]
    starts = np.flatnonzero(np.diff(shingle, prepend=~shingle[:1]))
    lengths = np.diff(starts, append=len(shingle))
    found, counts = [], []
    for length in range(2, LONG + 1):
        of = starts[lengths == length]
        if len(of):
            # Near copies have many equal lists. Records ascend inside a list, so a < b.
            lists, which = np.unique(owner[of[:, None] + np.arange(length)], axis=0, return_inverse=True)
            times = np.bincount(which.ravel(), weights=shingle[of] <= last).astype(np.int64)
            i, j = np.triu_indices(length, 1)
            found.append(np.stack([lists[:, i].ravel(), lists[:, j].ravel()], axis=1))
            counts.append(np.repeat(times, len(i)))
    if found:
        pairs, times = np.concatenate(found), np.concatenate(counts)
        order = np.lexsort((pairs[:, 1], pairs[:, 0]))
        pairs, times = pairs[order], times[order]
        first = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)]))
        pairs, times = pairs[first], np.add.reduceat(times, first)
        for low in range(0, len(pairs), 100_000):
            part = slice(low, low + 100_000)
            yield _merged_batch(_PAIR, a=pairs[part, 0], b=pairs[part, 1], n=times[part])
    for start, length in zip(starts[lengths > LONG].tolist(), lengths[lengths > LONG].tolist(), strict=True):
        for low in range(start, start + length, 100_000):
            high = min(low + 100_000, start + length)
            listed = np.full(high - low, int(shingle[start] <= last))
            yield _merged_batch(_LONG_LIST, a=shingle[low:high].view(np.int64), b=owner[low:high], listed=listed, n=np.full(high - low, length))


def _sets(size: int):
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column("text")):
                found = list(shingle_sets(words(data, offsets, SPACED), size))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([record_id(x) for x in found], type=pa.int64()), pa.array([x.tobytes() for x in found], type=pa.binary())],
                    names=["record", "shingles"],
                )

    return run


def _own_sets(size: int):
    """The shingles of the rows whose text is the record they are joined with."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records, classes = batch.column("record").to_pylist(), batch.column("class").to_pylist()
            rows = [(r, c, x.tobytes()) for r, c, x in zip(records, classes, _sets_of(batch, size), strict=True) if record_id(x) == r]
            types = (pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([row[k] for row in rows], t) for k, t in enumerate(types)], names=["record", "class", "shingles"])

    return run


def _sets_of(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    for _, _, data, offsets in blocks(batch.column("text")):
        yield from shingle_sets(words(data, offsets, SPACED), size)


def _search(queries: dict[int, tuple[int, np.ndarray]], size: int, percent: int):
    """Counts, for every text, its occurrences in the inverted lists of the queries; one link to each other class is enough."""
    names = np.array(list(queries), dtype=np.int64)
    classes = np.array([c for c, _ in queries.values()], dtype=np.int64)
    sizes = np.array([len(x) for _, x in queries.values()], dtype=np.int64)
    shingle = np.concatenate([x for _, x in queries.values()])
    owner = np.repeat(np.arange(len(names), dtype=np.int32), sizes)
    order = np.argsort(shingle, kind="stable")
    shingle, owner = shingle[order], owner[order]

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a: list[int] = []
            b: list[int] = []
            for record, own, x in zip(batch.column("record").to_pylist(), batch.column("class").to_pylist(), _sets_of(batch, size), strict=True):
                low, high = np.searchsorted(shingle, x), np.searchsorted(shingle, x, side="right")
                lengths = high - low
                if not lengths.any() or record_id(x) != record:
                    continue
                at = np.repeat(low - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
                times = np.bincount(owner[at], minlength=len(names))
                linked = np.flatnonzero((times * (100 + percent) >= percent * (sizes + len(x))) & (classes != own))
                if len(linked):
                    linked = linked[np.unique(classes[linked], return_index=True)[1]]
                    a += [record] * len(linked)
                    b += names[linked].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def occurrences(query: np.ndarray, candidate: np.ndarray, required: int) -> int:
    """How many of the query's shingles occur in the candidate, or less than ``required`` if that can't be reached.

    The shorter part of the lists is merged with a heap, the rest is probed by binary search in
    steps, each step skipped when even a full hit could not reach the requirement.
    """
    if len(query) < required or len(candidate) < required:
        return 0
    spare = len(query) - required
    head = min(len(query), spare + 1)
    # Without one hit among spare + 1 shingles the rest can't suffice.
    count, last = 0, None
    low, high = np.searchsorted(candidate, query[0]), np.searchsorted(candidate, query[head - 1], side="right")
    if (high - low) * 4 < head * 64:
        for value in heapq.merge(query[:head].tolist(), candidate[low:high].tolist()):
            count += value == last
            last = value
    else:
        count = _probe(query[:head], candidate)
    if not count:
        return 0
    step = max(64, len(query) // 8)
    for at in range(head, len(query), step):
        if count + len(query) - at < required:
            return count
        count += _probe(query[at : at + step], candidate)
    return count


def _probe(values: np.ndarray, candidate: np.ndarray) -> int:
    at = np.searchsorted(candidate, values)
    at[at == len(candidate)] = 0
    return int(np.count_nonzero(candidate[at] == values))


def _verify(percent: int):
    """Keeps the pairs with 100 * |a & b| >= percent * |a | b|."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                a, b = (np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in (left, right))
                if len(a) > len(b):
                    a, b = b, a
                # |a & b| * (100 + percent) >= percent * (|a| + |b|)
                required = -(-percent * (len(a) + len(b)) // (100 + percent))
                kept.append(occurrences(a, b, required) >= required)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(kept, type=pa.bool_()))

    return run


def row_key() -> F.Column:
    """What a row is found again by: rows share it only if they share doc_id and text."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


class _Join:
    def __init__(self, docs: DataFrame, size: int, percent: int) -> None:
        self.size, self.percent = size, percent
        self.docs = docs.select(row_key().alias("key"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.work = Workspace(docs.sparkSession, "jaccard")

    def lists(self, docs: DataFrame, share: float) -> DataFrame:
        partitions = shuffle_partitions(docs.sparkSession)
        posted = docs.mapInArrow(_post(8 * partitions, self.size, self.percent, share), _POSTED)
        spread = posted.repartitionById(partitions, F.col("bucket") % partitions).drop("bucket")
        return self.work.save(spread.mapInArrow(_merge(share), _MERGED), "lists", "kind")

    def members_and_records(self, merged: DataFrame) -> None:
        self.members = merged.filter(F.col("kind") == _DOCUMENT).select("doc_id", "n", "listed", F.col("a").alias("record"), F.col("b").alias("key"))
        first = F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "key")).alias("first")
        records = self.members.groupBy("record").agg(first, F.first("n").alias("n"), F.first("listed").alias("listed"))
        records = records.select("record", "first.doc_id", "first.key", "n", "listed")
        self.records = self.work.save(records, "records")

    @staticmethod
    def short(merged: DataFrame) -> DataFrame:
        """Pairs of the short lists and in how many of them both occur, bucket by bucket."""
        return merged.filter(F.col("kind") == _PAIR).select("a", "b", F.col("n").alias("times"))

    def long_lists(self, merged: DataFrame, listed: str) -> tuple[DataFrame, DataFrame]:
        """The long lists; every record's lists, how many of those listed are long, and how many of those posted."""
        long = merged.filter(F.col("kind") == _LONG_LIST).select(F.col("a").alias("shingle"), F.col("b").alias("record"), "listed", F.col("n").alias("length"))
        skipped = long.groupBy("record").agg(F.sum("listed").alias("skipped"), F.count("*").alias("long"))
        skipped = F.broadcast(skipped) if skipped.count() <= BROADCAST_IDS else skipped
        skips = self.records.select("record", "key", "n", F.expr(listed).alias("listed")).join(skipped, "record", "left")
        return long, self.work.save(skips.withColumns({x: F.coalesce(x, F.lit(0)) for x in ("skipped", "long")}), "skips")

    def lacking(self, skips: DataFrame) -> DataFrame:
        """Records with fewer short lists than they need, and how many long ones they must keep.

        A long list counts wherever it is in the hash range: a record that needs more lists than it has
        in the lowest share posts some beyond it. Only a record whose posted lists are all short misses none.
        """
        lacking = F.expr(f"n - (n * {self.percent} + 99) div 100 + 1 - (listed - skipped)")
        return skips.filter("long > 0").select("record", "key", lacking.alias("lacking"), F.expr("n - skipped").alias("private")).filter("lacking > 0")

    def reaching(self, pairs: DataFrame, skips: DataFrame) -> DataFrame:
        """The pairs whose sizes and occurrences allow the required overlap.

        T is the overlap required of the pair. A record may miss n - T of its shingles, so at least
        listed - (n - T) of those listed must occur in the other, in short lists or in long ones.
        """
        of = {x: skips.select(F.col("record").alias(x), *[F.col(c).alias(c + x) for c in ("n", "listed", "skipped")]) for x in "ab"}
        counted = pairs.groupBy("a", "b").agg(F.sum("times").alias("times")).join(of["a"], "a").join(of["b"], "b")
        required = F.expr(f"({self.percent} * (na + nb) + {99 + self.percent}) div {100 + self.percent}")
        counted = counted.withColumn("required", required).filter("required <= least(na, nb)")
        enough = "times + least(skippeda, skippedb) >= required + greatest(listeda - na, listedb - nb)"
        return counted.filter(enough).select("a", "b")

    def of_keys(self, keys: DataFrame) -> DataFrame:
        """The documents with a key of the saved table ``keys``, which is broadcast only while it is small."""
        if keys.count() <= BROADCAST_IDS:
            keys = F.broadcast(keys)
        return self.docs.join(keys, "key", "left_semi")

    def candidates(self) -> tuple[DataFrame, DataFrame]:
        """Pairs of the short lists and of pivots; the long lists that can't be skipped."""
        first = self.lists(self.docs, LISTED)
        self.members_and_records(first)
        _, skips = self.long_lists(first, "listed")
        pairs = self.reaching(self.short(first), skips)
        lacking = self.work.save(self.lacking(skips).select("key").distinct(), "lacking")
        second = self.lists(self.of_keys(lacking), 1.0)
        long, skips = self.long_lists(second, "n")
        rarest = Window.partitionBy("record").orderBy("length", "shingle")
        kept = long.join(self.lacking(skips), "record").withColumn("rank", F.row_number().over(rarest)).filter("rank <= lacking")
        kept = self.work.save(kept.select("shingle", "record", "private"), "long")
        more = self.short(second).union(self.pivots(kept).withColumn("times", F.lit(0).cast("bigint")))
        return pairs.union(self.reaching(more, skips)).distinct(), kept

    def pivots(self, lists: DataFrame) -> DataFrame:
        """Every member of a list with a few members of that list, the first being the one with the fewest shingles of its own."""
        central = F.min_by("record", F.struct("private", F.xxhash64("record"))).alias("p0")
        chosen = [F.min_by("record", F.xxhash64("record", F.lit(k))).alias(f"p{k}") for k in range(1, PIVOTS)]
        pivots = lists.groupBy("shingle").agg(central, *chosen)
        pairs = lists.join(pivots, "shingle").select("record", F.explode(F.array_distinct(F.array(*[f"p{k}" for k in range(PIVOTS)]))).alias("pivot"))
        return pairs.filter("record <> pivot").select(F.least("record", "pivot").alias("a"), F.greatest("record", "pivot").alias("b")).distinct()

    def links(self, pairs: DataFrame) -> DataFrame:
        """The candidate pairs that are similar enough."""
        pairs = self.work.save(pairs, "candidates")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("record")).distinct().join(self.records, "record").select("key").distinct()
        texts = self.of_keys(self.work.save(wanted, "wanted")).select("text")
        sets = self.work.save(texts.mapInArrow(_sets(self.size), "record bigint, shingles binary").dropDuplicates(["record"]), "sets")
        left = sets.select(F.col("record").alias("a"), F.col("shingles").alias("left"))
        right = sets.select(F.col("record").alias("b"), F.col("shingles").alias("right"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
        return self.work.save(both.mapInArrow(_verify(self.percent), "a bigint, b bigint"), "links")

    def apart(self, lists: DataFrame, classes: DataFrame) -> DataFrame:
        """``record, class, outside``: members of lists with several classes, and whether they are outside a list's largest."""
        member = lists.join(classes.withColumnRenamed("node", "record"), "record", "left")
        member = self.work.save(member.select("shingle", "record", F.coalesce("component", "record").alias("class")), "classes")
        counts = member.groupBy("shingle", "class").agg(F.count("*").alias("n"))
        largest = counts.groupBy("shingle").agg(F.max_by("class", F.struct("n", "class")).alias("largest"), F.count("*").alias("classes"))
        mixed = member.join(largest.filter("classes > 1"), "shingle")
        apart = mixed.groupBy("record", "class").agg(F.max(F.col("class") != F.col("largest")).alias("outside"))
        return self.work.save(apart.join(self.records.select("record", "key", "n"), "record"), "apart")

    def search(self, apart: DataFrame) -> DataFrame | None:
        """Links between records outside their list's largest class and records of other classes."""
        outside = apart.filter("outside")
        held = outside.agg(F.sum("n")).head()[0]
        if not held:
            return None
        every = self.work.save(apart.select("key", "record", "class").distinct(), "searched")
        texts = self.docs.join(F.broadcast(every) if every.count() <= BROADCAST_IDS else every, "key")
        parts, found = -(-held // BLOCK_SHINGLES), []
        for part in range(parts):
            block = outside.filter(F.pmod(F.xxhash64("record"), F.lit(parts)) == part).select("key", "record", "class")
            queries = self.docs.join(F.broadcast(block), "key").mapInArrow(_own_sets(self.size), "record bigint, class bigint, shingles binary")
            queries = {r["record"]: (r["class"], np.frombuffer(r["shingles"], dtype=np.uint64)) for r in queries.collect()}
            links = texts.mapInArrow(_search(queries, self.size, self.percent), "a bigint, b bigint")
            found.append(self.work.save(links, "more-links"))
        return reduce(DataFrame.union, found)

    def run(self) -> DataFrame:
        pairs, lists = self.candidates()
        links = self.links(pairs)
        classes = components(links, self.work)
        more = self.search(self.apart(lists, classes))
        if more is not None:
            links = links.union(more)
            classes = components(links, self.work)
        return self.result(links, classes)

    def result(self, links: DataFrame, classes: DataFrame) -> DataFrame:
        """One row per input row. A class is named by the smallest doc_id of all its records' documents."""
        record = self.records.join(classes.withColumnRenamed("node", "record"), "record", "left")
        record = record.select("record", "doc_id", "key", F.coalesce("component", "record").alias("component"))
        first = F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "key")).alias("first")
        firsts = record.groupBy("component").agg(first).select("component", F.col("first.doc_id").alias("component_id"), F.col("first.key").alias("first_key"))
        named = record.join(firsts, "component").select("record", "component_id", "first_key")
        out = self.members.join(named, "record").select("doc_id", F.col("n").alias("n_shingles"), "record", "component_id", "key", "first_key")
        # Documents without words are linked with nothing.
        return out.withColumns({x: F.when(F.col("n_shingles") == 0, F.col(own)).otherwise(F.col(x)) for x, own in (("component_id", "doc_id"), ("first_key", "key"))})


def similar_documents(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, record, component_id`` per row of ``docs(doc_id, text)``.

    Two documents link when 100 * intersection >= percent * union of their sets of ``size``-word
    shingles (words between ASCII white space, A-Z lower-cased). ``component_id`` is the smallest
    doc_id reachable by links; ``record`` is equal for equal sets. A text with fewer words has its
    whole sequence as one shingle; null, empty and blank texts have none and stay alone. Repeated
    rows are kept, each with its row. A row without doc_id, or with one that other texts have too, has
    its own links; a null doc_id never names a class that has another id. Other columns are ignored. An empty table gives an empty table.
    """
    return _Join(docs, size, percent).run().drop("key", "first_key")


def deduplicate(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of every class of similar documents: the one with the smallest doc_id.

    A row without doc_id stays only where no row of its class has one. Rows that repeat a doc_id and its
    text are copies of each other. Rows without words are all kept, but for such copies with a doc_id.
    """
    work = Workspace(docs.sparkSession, "deduplicate")
    found = _Join(docs, size, percent).run().select("key", "first_key", (F.isnull("doc_id") & (F.col("n_shingles") == 0)).alias("blank"))
    found = work.save(found.withColumnRenamed("key", "_row_key"), "classes")
    dropped = work.save(found.filter("_row_key <> first_key").select("_row_key").distinct(), "dropped")
    repeated = work.save(found.filter("not blank").groupBy("_row_key").count().filter("count > 1").select("_row_key"), "repeated")
    kept = without(docs.withColumn("_row_key", row_key()), dropped, "_row_key")
    if not repeated.isEmpty():
        again = kept.join(repeated, "_row_key", "left_semi").dropDuplicates(["_row_key"])
        kept = without(kept, repeated, "_row_key").unionByName(again)
    return kept.select(*docs.columns)
