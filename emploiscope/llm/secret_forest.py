"""Secrets in documents: candidate strings, and a random forest that removes false positives.

Candidates are long unbroken runs of the characters that keys are made of. The forest looks at
their length, the changes between character classes, how far they are covered by stems of ordinary
words, what stands before and after, and the path they come from. It is fitted on labelled
findings; by default those that a published key format or an assignment to a telling name settles.
All steps are DataFrame expressions; the forest is Spark's own.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emploiscope.llm.workspace import Workspace

MIN_LENGTH = 16
TREES = 20
DEPTH = 6
SEED = 17
# The fit sees at most so many findings of each label.
FINDINGS_PER_LABEL = 5000
# Stems count as ordinary from so many documents and from one document in so many.
STEM_DOCUMENTS = 5
STEM_ONE_IN = 400
STEM = 4
THRESHOLD = 0.5

WHITE_RUN = "[ \t\n\x0b\x0c\r]+"
RUN = f"([A-Za-z0-9+/_-]{{{MIN_LENGTH},}})"

# Published key formats and telling names.
KEY_FORMATS = "^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35}|sk_live_[0-9a-zA-Z]{24,})$"
TELLING = "(token|secret|passw|passwd|pwd|api_?key|apikey|access_?key|auth|credential|private_?key)"
HARMLESS = "(sha|md5|hash|digest|checksum|commit|revision|uuid|guid|etag|build)"
ORDINARY_PATH = "(test|spec|example|sample|fixture|mock|doc|demo)"

FEATURES = [
    "length",
    "changes",
    "vowel_runs",
    "digits",
    "upper",
    "distinct",
    "covered",
    "assigned",
    "quoted",
    "telling",
    "harmless",
    "slashes",
    "in_address",
    "ordinary_path",
]


def findings(docs: DataFrame) -> DataFrame:
    """``doc_id, path, word, candidate, before, prefix, suffix, after``: every candidate with its surroundings."""
    path = F.col("path") if "path" in docs.columns else F.col("source")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.select("doc_id", F.coalesce(path.cast("string"), F.lit("")).alias("path"), F.split(text, WHITE_RUN, -1).alias("words"))
    long = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).rlike(RUN))
    df = df.select("doc_id", "path", "words", F.explode(long).alias("word"))

    def at(offset):
        return F.coalesce(F.get("words", F.col("word") + offset), F.lit(""))

    df = df.select("doc_id", "path", "word", F.concat_ws(" ", at(-3), at(-2), at(-1)).alias("before"), at(0).alias("text"), at(1).alias("after"))
    df = df.select("*", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(RUN), F.lit(1)))).alias("candidate"))
    place = F.instr("text", F.col("candidate"))
    return df.select(
        *["doc_id", "path", "word", "candidate", "before", "after"],
        F.substring("text", F.lit(1), place - 1).alias("prefix"),
        F.substring("text", place + F.length("candidate"), F.length("text")).alias("suffix"),
    )


def _lead(df: DataFrame) -> F.Column:
    return F.lower(F.concat_ws(" ", "before", "prefix"))


def rule_label(df: DataFrame) -> F.Column:
    """1 where a key format or an assignment to a telling name settles a finding, 0 where words do, else null."""
    lead = _lead(df)
    assigned = lead.rlike(TELLING + "[a-z_]*[\"']? *[=:] *[\"']?$") & F.col("candidate").rlike("[0-9]")
    known = F.col("candidate").rlike(KEY_FORMATS) | assigned
    word = ~F.col("candidate").rlike("[0-9]") | lead.rlike(HARMLESS + "[a-z_ ]*[=:]? *[\"']?$")
    return F.when(known, 1).when(word, 0)


def with_features(df: DataFrame, stems: list[str]) -> DataFrame:
    c, n = F.col("candidate"), F.length("candidate").cast("double")

    def runs(pattern: str) -> F.Column:
        return F.regexp_count("candidate", F.lit(pattern))

    def share(pattern: str) -> F.Column:
        return F.length(F.regexp_replace("candidate", pattern, "")) / n

    lead = _lead(df)
    changes = runs("[a-z]+") + runs("[A-Z]+") + runs("[0-9]+") + runs("[^a-zA-Z0-9]+") - 1
    lowered = F.lower(c)
    at = F.sequence(F.lit(1), F.length("candidate") - (STEM - 1))
    # The list of stems becomes a hash set in the plan.
    hits = F.size(F.filter(at, lambda i: F.substring(lowered, i, F.lit(STEM)).isin(stems))) if stems else F.lit(0)
    values = {
        "length": n,
        "changes": changes / n,
        "vowel_runs": F.regexp_count(lowered, F.lit("[aeiouy]+")) / n,
        "digits": share("[^0-9]+"),
        "upper": share("[^A-Z]+"),
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
        "covered": hits / (n - (STEM - 1)),
        "assigned": lead.rlike("[=:] *[\"']?$").cast("double"),
        "quoted": (F.col("prefix").rlike("[\"']$") & F.col("suffix").rlike("^[\"']")).cast("double"),
        "telling": lead.rlike(TELLING).cast("double"),
        "harmless": lead.rlike(HARMLESS).cast("double"),
        "slashes": F.regexp_count(c, F.lit("/")) / n,
        "in_address": (F.col("prefix").rlike("://|@") | F.col("suffix").rlike("^[@.][A-Za-z]")).cast("double"),
        "ordinary_path": F.lower("path").rlike(ORDINARY_PATH).cast("double"),
    }
    return df.withColumns({k: values[k].cast("double") for k in FEATURES})


def frequent_stems(docs: DataFrame) -> list[str]:
    """The letter stems of ordinary words: those in enough of all documents, however often they occur in one.

    There are at most 26 ** STEM (456,976) stems, so counts and list are bounded whatever the corpus.
    """
    texts = docs.filter("text is not null").select(F.lower(F.col("text").cast("string")).alias("text"))
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(f"([a-z]{{{STEM},}})"), F.lit(1)))
    stems = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - (STEM - 1)), lambda i: F.substring(w, i, F.lit(STEM))))
    counted = texts.select(F.explode(F.array_distinct(F.flatten(stems))).alias("stem")).groupBy("stem").agg(F.count("*").alias("n"))
    least = max(STEM_DOCUMENTS, -(-texts.count() // STEM_ONE_IN))
    return sorted(r["stem"] for r in counted.filter(F.col("n") >= least).collect())


def fit(labelled: DataFrame) -> RandomForestClassificationModel | None:
    """A forest for findings with features and ``label``; None when only one label occurs."""
    rows = labelled.filter("label is not null").select("label", *FEATURES, F.xxhash64("doc_id", "word", "candidate").alias("h"))
    kept = None
    for label in (0, 1):
        # In a fixed order, so that the forest is the same for the same findings.
        part = rows.filter(F.col("label") == label).orderBy("h", *FEATURES).limit(FINDINGS_PER_LABEL)
        kept = part if kept is None else kept.union(part)
    kept = Workspace(labelled.sparkSession, "secret-forest").save(kept.coalesce(1).sortWithinPartitions("label", "h", *FEATURES), "training")
    if kept.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(kept.withColumn("label", F.col("label").cast("double")))
    # One tree's sample depends on how rows are dealt out: one partition is the same everywhere.
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt").fit(rows.select("label", "features").coalesce(1))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, word, candidate, score, is_secret`` of every candidate in ``docs(doc_id, text, source)``.

    ``word`` is the candidate's place among the words of the text, from 0 (an empty first word
    counts). A column ``path`` is used instead of ``source`` if there is one. Candidates have
    ``MIN_LENGTH`` characters or more; equal ones in one word are reported once. ``score`` is the
    forest's share of votes for a secret; if the labelled findings are all alike, it is their label
    by rule, and 0 where no rule applies. Null and empty texts have no candidates; repeated rows are
    reported each; null doc_ids are carried; other columns are ignored; empty tables give none.
    """
    work = Workspace(docs.sparkSession, "secrets")
    found = work.save(findings(docs), "findings")
    featured = with_features(found, frequent_stems(docs)).withColumn("label", rule_label(found))
    model = fit(featured)
    if model is None:
        score = F.coalesce("label", F.lit(0)).cast("double")
        scored = featured
    else:
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(featured))
        score = vector_to_array("probability")[1]
    return scored.select("doc_id", "word", "candidate", score.alias("score")).withColumn("is_secret", F.col("score") >= THRESHOLD)
