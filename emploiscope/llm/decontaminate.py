"""Benchmark passages in documents, by a prefix-filtered set join.

A window is ``WINDOW`` consecutive words of a benchmark item (the whole item if it is shorter). A
window is the ordered set of its shingles, and a document contains it only if it contains all of
them, so the necessary prefix of a window is one shingle: its rarest. The steps:

1. One pass over the documents finds where shingles of the benchmark occur. Their hashes are
   broadcast; a benchmark of more than ``BLOCK_SHINGLES`` is cut into blocks of windows, with one
   pass for each block.
2. Shingles are ordered by rarity: the number of documents they occur in.
3. The rarest shingle of every window is joined with the occurrences. Each match fixes the place
   where the window would have to begin; the length bound (it must lie inside the text) and the
   positional bound (it must lie inside one unbroken run of occurrences) drop most places.
4. What is left is verified exactly: the words at that place are compared, one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emploiscope.llm.text import ALPHANUMERIC, LOWER, Words, blocks, gives_back, windows, words
from emploiscope.llm.workspace import Workspace, without

WINDOW = 13
SHINGLE = 5
BLOCK_SHINGLES = 2_000_000

_FOUND = "doc_id bigint, n_words bigint, block int, shingle bigint, positions array<int>, run_start array<int>, run_end array<int>, run int, run_words string, own_id bigint"
_ITEMS = "item_id string, n_words int, position int, size int, shingle bigint, words string"


def _texts(found: Words, data: np.ndarray) -> list[str]:
    lowered = LOWER[data].tobytes()
    return [lowered[a:b].decode("utf-8", "replace") for a, b in zip(found.starts.tolist(), found.ends.tolist(), strict=True)]


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of every item, with each of its shingles (``position``: its offset in the window)."""
    for batch in batches:
        rows: dict[str, list] = {name.split()[0]: [] for name in _ITEMS.split(", ")}
        ids = batch.column("item_id").to_pylist()
        for low, _, data, offsets in blocks(batch.column("text")):
            found = words(data, offsets, ALPHANUMERIC)
            texts = _texts(found, data)
            for i in range(len(offsets) - 1):
                a, b = int(found.first[i]), int(found.first[i + 1])
                length = min(WINDOW, b - a)
                if not length:
                    continue
                size = min(SHINGLE, length)
                shingles = windows(found.hashes[a:b], size).view(np.int64)
                for start in range(b - a - length + 1):
                    text = " ".join(texts[a + start : a + start + length])
                    for offset in range(length - size + 1):
                        for name, value in zip(rows, (ids[low + i], length, offset, size, shingles[start + offset], text), strict=True):
                            rows[name].append(value)
        types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(rows.values(), types, strict=True)], names=list(rows))


def _occurrences(block: int, wanted: dict[int, np.ndarray], total: bool):
    """Three kinds of rows: places of a wanted shingle in a text; the words of an unbroken run of places; n_words if ``total``."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own_ids = (batch.column(c).to_pylist() for c in ("doc_id", "own_id"))
            out: list[tuple] = []
            for low, _, data, offsets in blocks(batch.column("text")):
                found = words(data, offsets, ALPHANUMERIC)
                counts = np.diff(found.first)
                if total:
                    out += [(ids[low + i], n, block, None, None, None, None, None, None, own_ids[low + i]) for i, n in enumerate(counts.tolist())]
                doc_of = np.repeat(np.arange(len(counts)), counts)
                for size, hashes in wanted.items():
                    every = windows(found.hashes, size).view(np.int64)
                    at = np.searchsorted(hashes, every)
                    at[at == len(hashes)] = 0
                    hit = np.flatnonzero(hashes[at] == every)
                    hit = hit[doc_of[hit] == doc_of[hit + size - 1]]
                    if not len(hit):
                        continue
                    # Runs of words without a gap between occurrences, inside one text.
                    cut = (np.diff(hit) > size) | (doc_of[hit[1:]] != doc_of[hit[:-1]])
                    run_of = np.concatenate([[0], np.cumsum(cut)])
                    begins, ends = hit[np.concatenate([[True], cut])], hit[np.concatenate([cut, [True]])] + size
                    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
                        doc = int(doc_of[a])
                        texts = b" ".join([LOWER[data[x:y]].tobytes() for x, y in zip(found.starts[a:b].tolist(), found.ends[a:b].tolist(), strict=True)])
                        out.append((ids[low + doc], int(counts[doc]), block, None, None, None, None, a - int(found.first[doc]), texts.decode("utf-8", "replace"), None))
                    base = found.first[doc_of[hit]]
                    order = np.lexsort((hit, every[hit], doc_of[hit]))
                    keys = np.stack([doc_of[hit][order], every[hit][order]])
                    edges = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0), [True]]))
                    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                        own = order[a:b]
                        doc, r = int(doc_of[hit[own[0]]]), run_of[own]
                        place = ((hit[own] - base[own]).tolist(), (begins[r] - base[own]).tolist(), (ends[r] - base[own]).tolist())
                        out.append((ids[low + doc], int(counts[doc]), block, int(every[hit[own[0]]]), *place, None, None, None))
            yield from _found_batches(out)

    return run


def _found_batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    ints = pa.list_(pa.int32())
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), ints, ints, ints, pa.int32(), pa.string(), pa.int64()]
    for low in range(0, len(rows), 5000):
        columns = list(zip(*rows[low : low + 5000], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=[x.split()[0] for x in _FOUND.split(", ")])


def content_key(docs: DataFrame) -> F.Column:
    """A 64-bit fingerprint of doc_id and text, so that rows without a doc_id, or sharing one, are told apart."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


class Decontamination:
    """``spans``: hit stretches of words per document and item; ``report``: one row per document.

    Inside, ``doc_id`` is the document's content key.
    """

    def __init__(self, docs: DataFrame, benchmark: DataFrame) -> None:
        self.docs = docs.select(content_key(docs).alias("doc_id"), F.col("doc_id").cast("bigint").alias("own_id"), F.col("text").cast("string").alias("text"))
        self.work = Workspace(docs.sparkSession, "decontaminate")
        items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
        self.items = self.work.save(items.mapInArrow(_item_windows, _ITEMS).distinct(), "item-windows")
        self._find()

    def _find(self) -> None:
        shingles = self.items.select("size", "shingle").distinct().count()
        parts = max(1, -(-shingles // BLOCK_SHINGLES))
        # All shingles of a window are in its block, so no run of places is broken.
        self.items = self.items.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(parts)).cast("int"))
        found = []
        for block in range(parts):
            own = self.items.filter(F.col("block") == block).select("size", "shingle").distinct().toPandas()
            wanted = {int(size): np.sort(group["shingle"].to_numpy(dtype=np.int64)) for size, group in own.groupby("size")}
            found.append(self.work.save(self.docs.mapInArrow(_occurrences(block, wanted, block == 0), _FOUND), "occurrences"))
        found = reduce(DataFrame.union, found)
        self.totals = found.filter("shingle is null and run is null").select("doc_id", "n_words", "own_id")
        self.runs = found.filter("run is not null").select("doc_id", "block", "run", "run_words").distinct()
        self.found = found.filter("shingle is not null").drop("run", "run_words", "own_id")

    def _prefixes(self) -> DataFrame:
        """The rarest shingle of every window; ties go to the smaller hash."""
        rarity = self.found.groupBy("block", "shingle").agg(F.count("*").alias("documents"))
        ordered = Window.partitionBy("words", "length").orderBy("documents", "shingle", "position")
        # A window has at most WINDOW - SHINGLE + 1 rows here.
        windows_of = self.items.select("block", "words", F.col("n_words").alias("length"), "position", "shingle").distinct()
        # A shingle that no document has rules its window out.
        whole = windows_of.join(rarity, ["block", "shingle"], "left").withColumn("documents", F.coalesce("documents", F.lit(0)))
        rarest = whole.withColumn("rank", F.row_number().over(ordered)).filter("rank = 1 and documents > 0")
        return rarest.select("block", "words", "length", "position", "shingle")

    def places(self) -> DataFrame:
        """``doc_id, start, length, words``: every place where a window occurs."""
        joined = self.found.join(self._prefixes(), ["block", "shingle"])
        at = F.explode(F.arrays_zip("positions", "run_start", "run_end"))
        placed = joined.select("doc_id", "block", "n_words", "words", "length", "position", at.alias("at"))
        placed = placed.withColumn("start", F.expr("at.positions - position"))
        bounds = "start >= 0 and start + length <= n_words and start >= at.run_start and start + length <= at.run_end"
        placed = placed.filter(bounds).withColumn("run", F.col("at.run_start"))
        placed = placed.join(self.runs, ["doc_id", "block", "run"])
        # Words hold no space, so the window's text is compared with as many words of the run.
        same = F.array_join(F.slice(F.split("run_words", " "), F.expr("start - run + 1"), F.col("length")), " ") == F.col("words")
        return placed.filter(same).select("doc_id", "start", "length", "words").distinct()

    def spans(self) -> DataFrame:
        """``doc_id, item_id, start, length``: places with the items they come from."""
        owners = self.items.select("item_id", "words").distinct()
        return self.work.save(self.places().join(owners, "words").select("doc_id", "item_id", "start", "length"), "spans")

    def report(self, numerator: int = 1, denominator: int = 20) -> DataFrame:
        spans = self.spans()
        places = spans.select("doc_id", "start", "length").distinct()
        before = Window.partitionBy("doc_id").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
        ended = F.coalesce(F.max(F.col("start") + F.col("length")).over(before), F.lit(0))
        hit = places.withColumn("new", F.greatest(F.lit(0), F.col("start") + F.col("length") - F.greatest("start", ended)))
        hit = hit.groupBy("doc_id").agg(F.sum("new").cast("bigint").alias("n_hit"))
        items = spans.select("doc_id", "item_id").distinct().groupBy("doc_id").agg(F.sort_array(F.collect_list("item_id")).alias("items"))
        # Repeated rows have equal totals; each keeps its row.
        out = self.totals.join(hit, "doc_id", "left").join(items, "doc_id", "left")
        n_hit = F.coalesce("n_hit", F.lit(0))
        listed = F.coalesce("items", F.array().cast("array<string>"))
        return out.select(
            F.col("own_id").alias("doc_id"),
            F.col("doc_id").alias("content_key"),
            "n_words",
            n_hit.alias("n_hit"),
            F.size(listed).cast("bigint").alias("n_items"),
            listed.alias("items"),
            ((n_hit > 0) & (n_hit * denominator >= F.col("n_words") * numerator)).alias("contaminated"),
        )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items, contaminated`` per row of ``docs(doc_id, text)``.

    Words are runs of ASCII digits, lower-cased A-Z and any characters outside ASCII. A word inside
    any occurrence of a window of ``benchmark(item_id, text)`` is hit; a document is contaminated
    when at least one word in twenty is. Null, empty and wordless texts have no words and are clean;
    such items have no window. Rows without a doc_id, and rows that share one, have the hits of their
    own texts. Other columns are ignored; empty tables give no hits or no rows.
    """
    return Decontamination(docs, benchmark).report().drop("content_key")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    found = Decontamination(docs, benchmark)
    bad = found.report().filter("contaminated").select(F.col("content_key").alias("_content_key")).distinct()
    keyed = docs.withColumn("_content_key", content_key(docs))
    return without(keyed, found.work.save(bad, "contaminated"), "_content_key").select(*docs.columns)
