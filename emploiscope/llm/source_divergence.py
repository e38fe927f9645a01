"""How far the word use of sources lies apart, language by language, in exact whole numbers.

Every document becomes an exact sparse count vector over the terms that enough documents of its
language hold, as a count vectorizer with a least document frequency and no limit to its vocabulary
gives it; the vectors are summed per language and source. From the sums every term gets a share in
billionths, smoothed by one, and two sources are compared over all terms of the language: by closed
forms where a source lacks a term, and term by term only where both have it. So work follows the
stored counts, not sources times vocabulary.

Vocabulary and sums are tables that no process ever holds whole (Spark's own CountVectorizer keeps
the vocabulary on the driver and on every executor). The vectors of a task are summed in the task
before anything is shuffled; rare terms leave when the documents of all tasks are counted, which
gives the same sums as leaving them out of every vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emploiscope.llm import text
from emploiscope.llm.workspace import Workspace

MIN_DOCUMENTS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
# Summed vector entries that a task holds before it hands them on.
ENTRIES_PER_SUM = 1 << 20
# Stored counts of one task of the pair evaluation.
ENTRIES_PER_BLOCK = 1 << 15
SPREAD = 64

# Terms are runs of ASCII letters and everything outside ASCII.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True


def _added(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and the sum of each one's values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[begins], np.add.reduceat(values[order], begins) if len(begins) else values


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts by ``keys``, the last one first, and where in it each distinct combination begins."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    return order, np.flatnonzero(new)


def _strings(lower: np.ndarray, words: text.Words, chosen: np.ndarray) -> pa.Array:
    """The words numbered ``chosen``."""
    inside = np.zeros(len(lower) + 1, dtype=np.int64)
    inside[words.starts] += 1
    inside[words.ends] -= 1
    spans = np.append(0, np.cumsum(words.ends - words.starts))
    buffers = [None, pa.py_buffer(spans), pa.py_buffer(lower[np.cumsum(inside[:-1]) > 0])]
    return pa.Array.from_buffers(pa.large_string(), len(words.starts), buffers).take(pa.array(chosen))


def document_vectors(words: text.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse count vectors of a block's documents: document, term hash, count, and a word that is the term."""
    row = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    order, begins = _runs(words.hashes, row)
    count = np.diff(np.append(begins, len(order)))
    return row[order[begins]], words.hashes[order[begins]], count, order[begins]


@text.gives_back
def _vector_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vectors of a task's documents summed per language and source: occurrences and documents of every term."""
    groups: dict[tuple[str, str], int] = {}
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]] = []

    def summed() -> pa.RecordBatch:
        group, hashes, n, df = (np.concatenate([h[k] for h in held]) for k in range(4))
        order, begins = _runs(hashes, group)
        names = list(groups)
        lang, source = (pa.array([x[k] for x in names]).take(pa.array(group[order[begins]])) for k in (0, 1))
        term = pa.concat_arrays([h[4] for h in held]).take(pa.array(order[begins])).cast(pa.string())
        sums = [pa.array(np.add.reduceat(x[order], begins)) for x in (n, df)]
        return pa.RecordBatch.from_arrays([lang, source, term, *sums], names=["lang", "source", "term", "n", "df"])

    entries = 0
    for batch in batches:
        for low, high, data, offsets in text.blocks(batch.column("text")):
            rows = batch.slice(low, high - low)
            code = np.array([groups.setdefault(x, len(groups)) for x in zip(rows.column("lang").to_pylist(), rows.column("source").to_pylist(), strict=True)])
            words = text.words(data, offsets, LETTERS)
            row, hashes, count, word = document_vectors(words)
            if not len(row):
                continue
            order, begins = _runs(hashes, code[row])
            n, df = np.add.reduceat(count[order], begins), np.diff(np.append(begins, len(order)))
            first = order[begins]
            held.append((code[row[first]], hashes[first], n, df, _strings(text.LOWER[data], words, word[first])))
            entries += len(begins)
            if entries >= ENTRIES_PER_SUM:
                yield summed()
                held, entries = [], 0
    if held:
        yield summed()


def group_sums(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, total``: occurrences in the source and the language, none where zero in the source.

    ``docs`` has non-null text columns ``lang, source, text``. Terms that fewer than
    ``MIN_DOCUMENTS`` rows of their language hold are left out.
    """
    partly = docs.mapInArrow(_vector_sums, "lang string, source string, term string, n bigint, df bigint")
    sums = partly.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    of_lang = Window.partitionBy("lang", "term")
    sums = sums.select("lang", "source", "term", "n", F.sum("n").over(of_lang).alias("total"), F.sum("df").over(of_lang).alias("documents"))
    return sums.filter(F.col("documents") >= MIN_DOCUMENTS).drop("documents")


def share(n: str, total: str) -> F.Column:
    """The smoothed share in billionths: 1 + floor(SCALE * (n + 1) / total)."""
    return F.expr(f"1 + CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + 1 AS DECIMAL(20,0)) DIV CAST({total} AS DECIMAL(20,0))")


def divergence(p: str, q: str) -> F.Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) DIV {q}")


def _both(table: pa.Table) -> pa.Table:
    """What closed forms miss for terms that two sources have: sums per ordered pair, one block of terms."""
    n = table.num_rows
    source, term = (table.column(c).combine_chunks().dictionary_encode() for c in ("source", "term"))
    s, t = (x.indices.to_numpy().astype(np.int64) for x in (source, term))
    order = np.lexsort((s, t))
    s, t = s[order], t[order]
    p, zero = (table.column(c).to_numpy()[order] for c in ("p", "zero"))
    width = len(source.dictionary)

    def f(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (x - y) ** 2 // y

    keys, values = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    first, distance = np.arange(n), 1
    while True:
        first = first[first < n - distance]
        first = first[t[first] == t[first + distance]]
        if not len(first):
            break
        for a, b in ((first, first + distance), (first + distance, first)):
            gain = f(p[a], p[b]) - f(p[a], zero[b]) - f(zero[a], p[b]) + f(zero[a], zero[b])
            for held, new in zip((keys, values), _added(s[a] * width + s[b], gain), strict=True):
                held.append(new)
        distance += 1
    pairs, total = _added(np.concatenate(keys), np.concatenate(values))
    names = source.dictionary
    lang = pa.array([table.column("lang")[0].as_py()] * len(pairs), pa.string())
    return pa.table({"lang": lang, "source": names.take(pa.array(pairs // width)), "item": names.take(pa.array(pairs % width)), "value": pa.array(total)})


def pair_divergences(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every two sources of a language.

    A sum over all terms is taken apart: all terms as if both sources lacked them, the terms of one
    side as if the other lacked them (by equal shares, of which there are few), and what is left
    for terms that both have.
    """
    one = groups.select("lang", "source", "zero", "v")
    other = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("other_zero"))
    pairs = one.join(other, "lang").filter("source <> item")
    decimal = "decimal(38,0)"
    lacking = divergence("zero", "other_zero")
    none = pairs.select("lang", "source", "item", F.when(F.col("v") > 0, F.col("v").cast(decimal) * lacking).otherwise(0).cast(decimal).alias("value"))
    shares = entries.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))

    def one_side(side: str, both: F.Column) -> DataFrame:
        joined = pairs.join(shares.withColumnRenamed("source", side), ["lang", side])
        return joined.select("lang", "source", "item", (F.col("m").cast(decimal) * (both - lacking)).cast(decimal).alias("value"))

    blocks = entries.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))
    both = blocks.select("lang", "block", "source", "term", "p", "zero").groupBy("lang", "block").applyInArrow(_both, "lang string, source string, item string, value bigint")
    parts = none.union(one_side("source", divergence("p", "other_zero"))).union(one_side("item", divergence("zero", "p")))
    parts = parts.union(both.withColumn("value", F.col("value").cast(decimal)))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").cast("bigint").alias("value"))


def leading_terms(entries: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, item, value, rank`` of the terms a source uses more than its language does."""
    more = entries.filter("p > q").select("lang", "source", F.col("term").alias("item"), divergence("p", "q").alias("value"))
    order = [F.col("value").desc(), F.col("item")]
    # A hot group is ranked in sub-groups first; Spark limits both before it shuffles.
    some = Window.partitionBy("lang", "source", F.pmod(F.xxhash64("item"), F.lit(SPREAD))).orderBy(*order)
    more = more.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top)
    return more.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))).filter(F.col("rank") <= top)


def audit_sources(docs: DataFrame, entries_per_block: int = ENTRIES_PER_BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank`` over ``docs(text, lang, source)``.

    Part ``pair`` has every other source of the same language, part ``term`` the ``TOP_TERMS`` terms
    in which the source is furthest above its language. Values are sums of floor((p - q)^2 / q) in
    billionths; equal values are ranked by item. Every row is a document, repeated ones too. Null
    texts, languages and sources are empty strings; a group without terms has pairs and no terms; a
    source that is alone in its language has no pairs; without kept terms all values are 0. Other
    columns are ignored, so their names cannot clash. An empty table gives an empty table.
    """
    work = Workspace(docs.sparkSession, "source-divergence")
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    sums = work.save(group_sums(docs), "sums")
    of_group = sums.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.count("*").alias("entries"))
    # Every kept term of a language is in one of its sources: the vocabulary is the distinct terms.
    vocabulary = sums.groupBy("lang", "term").agg(F.first("total").alias("total")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    blocks = of_group.groupBy("lang").agg(F.ceil(F.sum("entries") / entries_per_block).alias("blocks"))
    groups = docs.select("lang", "source").distinct().join(of_group.drop("entries"), ["lang", "source"], "left")
    groups = groups.join(vocabulary, "lang", "left").join(blocks, "lang", "left").fillna(0, ["group_n", "lang_n", "blocks", "v"])
    groups = groups.withColumn("zero", F.when(F.col("v") > 0, share("0", "(group_n + v)")))
    groups = work.save(groups, "groups")
    entries = sums.join(groups, ["lang", "source"])
    entries = entries.select("lang", "source", "term", "zero", "blocks", share("n", "(group_n + v)").alias("p"), share("total", "(lang_n + v)").alias("q"))
    entries = work.save(entries, "entries")
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    pairs = pair_divergences(entries, groups).withColumn("rank", F.row_number().over(ranked))

    def part(name: str, df: DataFrame) -> DataFrame:
        return df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part("pair", pairs).union(part("term", leading_terms(entries)))
