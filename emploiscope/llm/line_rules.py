"""Quality rules on single documents, and on lines that recur across the documents of a host.

Everything is a DataFrame expression. One pass over the texts gives each document's measures and a
hash and word count for each of its lines; the texts are not read again after that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emploiscope.llm.workspace import Workspace, without

WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = "[ \t\n\x0b\x0c\r]+"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

# A line is boilerplate of its host above both limits.
MAX_DOCUMENTS = 5
MAX_SHARE_PERCENT = 5
MIN_KEPT_PERCENT = 50

# Boilerplate lines of all hosts that are sent to every task; more are joined by shuffle.
BROADCAST_LINES = 200_000


def _key() -> F.Column:
    """Equal for equal rows: doc_id, source and text."""
    parts = [F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(F.col("source").cast("string"), F.lit("\x01")), F.coalesce(F.col("text").cast("string"), F.lit(""))]
    return F.md5(F.concat_ws("\x00", *parts).cast("binary"))


def _measures(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    df = docs.select(
        F.col("doc_id"),
        # Rows without a source form a host of their own.
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("host"),
        F.md5(text.cast("binary")).alias("content"),
        _key().alias("key"),
        F.char_length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
        lines.alias("lines"),
    )
    in_lines = F.transform("lines", lambda line: F.split(F.btrim(line, F.lit(WHITE)), WHITE_RUN, -1))
    df = df.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint")).withColumn("in_lines", in_lines)
    df = df.select(
        *["doc_id", "host", "content", "key", "n_symbols", "n_dup_lines"],
        F.transform("in_lines", lambda w: F.struct(F.xxhash64(F.lower(F.array_join(w, " "))).alias("hash"), F.size(w).alias("words"))).alias("lines"),
        F.flatten("in_lines").alias("words"),
    )
    # The hash of every window of consecutive words, at the place of its first word.
    at = F.sequence(F.lit(0), F.size("words") - WINDOW)
    hashes = F.transform(at, lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]))
    df = df.select(
        *["doc_id", "host", "content", "key", "n_symbols", "n_dup_lines", "lines"],
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.when(F.size("words") >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    df = df.withColumn("sorted", F.when(repeats, placed)).drop("windows")

    def again(x, k):
        return (F.coalesce(F.get("sorted", k - 1)["h"] == x["h"], F.lit(False))) | (F.coalesce(F.get("sorted", k + 1)["h"] == x["h"], F.lit(False)))

    places = F.sort_array(F.transform(F.filter("sorted", again), lambda x: x["i"]))
    df = df.withColumn("places", places)
    covered = F.aggregate(
        "places",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint"))).drop("sorted", "places")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return df.withColumn("base_failed", failed)


def _boilerplate(measured: DataFrame, work: Workspace) -> DataFrame:
    """``host, hash`` of the lines above both limits. Equal texts of a host count as one document."""
    host_size = measured.groupBy("host").agg(F.count_distinct("content").alias("documents"))
    line = measured.select("host", "content", F.explode(F.array_distinct(F.transform("lines", lambda x: x["hash"]))).alias("hash"))
    # Counting in two steps: partial aggregation leaves a hot line with one row per task in the second.
    counts = line.distinct().groupBy("host", "hash").agg(F.count("*").alias("n")).filter(F.col("n") > MAX_DOCUMENTS)
    over = counts.join(host_size, "host").filter(F.col("n") * 100 > F.col("documents") * MAX_SHARE_PERCENT)
    return work.save(over.select("host", "hash", F.col("n").alias("n_documents")), "boilerplate")


def keep_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge_documents`` keeps, with all their columns and texts as they are."""
    work = Workspace(docs.sparkSession, "line-rules")
    rejected = work.save(_judged(docs, work).filter("not kept").select(F.col("key").alias("_row_key")).distinct(), "rejected")
    return without(docs.withColumn("_row_key", _key()), rejected, "_row_key").drop("_row_key")


def without_boilerplate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with the lines above both limits taken out of ``text``.

    Other lines, blank ones included, stay as they are and in their order; so does a text without such
    lines. No row is dropped: what is left of a document may be empty.
    """
    work = Workspace(docs.sparkSession, "line-rules")
    measured = work.save(_measures(docs), "measures")
    removed = _removed(measured, work).groupBy("key").agg(F.collect_list("at").alias("_removed"))
    removed = work.save(removed.withColumnRenamed("key", "_row_key"), "removed")
    joined = docs.withColumn("_row_key", _key()).join(removed, "_row_key", "left")
    joined = joined.withColumn("_lines", F.split(F.col("text").cast("string"), "\n", -1))
    # Places are counted among the lines that are not blank. Arrays used inside a lambda are columns of
    # their own, referenced more than once, so that no projection evaluates them again for each element.
    places = F.sequence(F.lit(0), F.size("_lines") - 1)
    filled = F.filter(places, lambda i: F.btrim(F.get("_lines", i), F.lit(WHITE)) != "")
    joined = joined.withColumn("_filled", F.when(F.col("_removed").isNotNull(), filled))
    gone = F.when(F.size("_filled") > 0, F.transform("_removed", lambda at: F.get("_filled", at)))
    text = F.array_join(F.transform(F.array_except(places, gone), lambda i: F.get("_lines", i)), "\n")
    return joined.withColumn("text", F.when(F.col("_removed").isNull(), F.col("text")).otherwise(text)).select(docs.columns)


def judge_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text, source)``.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed`` are measures of the
    text alone (words end at ASCII white space). ``n_kept_words`` leaves out the document's
    boilerplate: lines (normalised: trimmed, white space folded, lower case) in more than
    ``MAX_DOCUMENTS`` distinct documents of its source and more than ``MAX_SHARE_PERCENT`` of them.
    ``kept`` is false for a document that fails the base rules or is depleted: fewer than
    ``MIN_WORDS`` words or ``MIN_KEPT_PERCENT`` of its words are kept.

    Null, empty and blank texts have no words and fail. A null source is a source of its own.
    Repeated rows are judged alike and each kept as a row; equal texts of a source count as one
    document. Null doc_ids are carried. Other columns are ignored; an empty table gives none.
    """
    return _judged(docs, Workspace(docs.sparkSession, "line-rules")).drop("key")


def _removed(measured: DataFrame, work: Workspace) -> DataFrame:
    """``key, at, words`` of every boilerplate line: its place among the lines of its document that are not blank."""
    over = _boilerplate(measured, work)
    if over.count() <= BROADCAST_LINES:
        over = F.broadcast(over)
    lines = measured.select("key", "host", F.posexplode("lines").alias("at", "line")).select("key", "host", "at", "line.hash", "line.words")
    # Repeated rows share a key and have equal lines, so each line of a key counts once.
    return lines.join(over, ["host", "hash"]).groupBy("key", "at").agg(F.first("words").alias("words"))


def _judged(docs: DataFrame, work: Workspace) -> DataFrame:
    measured = work.save(_measures(docs), "measures")
    removed = _removed(measured, work)
    out = measured.drop("lines").join(removed.groupBy("key").agg(F.sum("words").alias("removed")), "key", "left")
    out = out.withColumn("n_kept_words", F.col("n_words") - F.coalesce("removed", F.lit(0)))
    depleted = (F.col("n_kept_words") < MIN_WORDS) | (F.col("n_kept_words") * 100 < F.col("n_words") * MIN_KEPT_PERCENT)
    return out.select(
        "key", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~depleted).alias("kept"), "n_kept_words"
    )
