"""A training corpus from the documents table: filtered, deduplicated, decontaminated, mixed and sharded.

Stages take ``(spark, docs, sf_dir)`` and return a DataFrame; each is written and read again before
the next. All but the last return the columns of ``documents``; the last returns each row's shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from emploiscope.llm import decontaminate, jaccard_join, karmarkar_karp, line_rules, temperature_mix
from emploiscope.llm.queries import ship_package, table
from emploiscope.llm.workspace import Workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or are little but boilerplate of their source, go."""
    return line_rules.keep_documents(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones stays: the one with the smallest doc_id."""
    ship_package(spark)
    return jaccard_join.deduplicate(docs, size=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is from the benchmark go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Smaller sources are repeated up to their weight; every document is used at least once."""
    return temperature_mix.mixed_documents(docs)


def balanced_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row, in 24 shards of nearly equal bytes."""
    return karmarkar_karp.shard_documents(docs, shards=24)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mix_to_weights),
    ("sharding", balanced_shards),
]

# Differencing and classes of similar documents need iteration that SQL can't express together.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages, one after the other, on the documents of ``sf_dir``."""
    work = Workspace(spark, "corpus-pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
