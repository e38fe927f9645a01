"""One query per operator over its whole table, with production parameters, and the SQL where SQL can express it."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import emploiscope
from emploiscope.llm import arrow_tokens, decontaminate, dom_boost, jaccard_join, karmarkar_karp, language_id, license_rules, line_rules, personal_data, prefix_trie, secret_forest, source_divergence, sql, temperature_mix

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python workers can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(emploiscope.__file__).parent
    folder = tempfile.mkdtemp(prefix="emploiscope-package-")
    archive = os.path.join(folder, "emploiscope-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(archive)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # executors fetch it from here
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """A public tokenizer's file; the same on the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document and the verdict after boilerplate lines of its source."""
    return line_rules.judge_documents(table(spark, sf_dir, "documents"))


def op2_karmarkar_karp_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes."""
    return karmarkar_karp.shard_documents(table(spark, sf_dir, "documents"), shards=24)


def op3_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every use of every document in a mixture of all sources."""
    return temperature_mix.mix_sources(table(spark, sf_dir, "documents"))


def op4_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate for a secret in the documents, with the forest's verdict."""
    return secret_forest.scan_secrets(table(spark, sf_dir, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the class of their similar documents: five words, Jaccard 0.8."""
    found = jaccard_join.similar_documents(table(spark, sf_dir, "documents"), size=5, percent=80)
    return found.select("doc_id", "n_shingles", "component_id")


def op6_dom_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return dom_boost.extract_main_text(table(spark, sf_dir, "pages"))


def op7_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document, and the licence sentences they were found by."""
    found = license_rules.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"), F.array_join("sentences", ",").alias("sentences"), "n_unknown")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of benchmark words per document: windows of 13 words, contaminated from one word in twenty."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op9_unigram_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, over the pieces of a public vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return language_id.identify_languages(table(spark, sf_dir, "documents"), pieces)


def op10_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as Arrow files and read back."""
    manifest = arrow_tokens.write_sequences(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return arrow_tokens.document_digests(manifest)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source against the others of its language, and the terms it uses most above its language."""
    return source_divergence.audit_sources(table(spark, sf_dir, "documents"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the strict spans, and all spans."""
    found = personal_data.find_personal_data(table(spark, sf_dir, "documents"))
    counts = [personal_data.counted("strict", kind).alias(f"n_{kind}") for kind in personal_data.KINDS]
    digest = F.sha2(personal_data.listed("strict").cast("binary"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), personal_data.listed("spans").alias("spans"), F.size("added").cast("bigint").alias("n_added"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_line_rules": op1_line_rules,
    "op2_karmarkar_karp_shards": op2_karmarkar_karp_shards,
    "op3_temperature_mix": op3_temperature_mix,
    "op4_secret_forest": op4_secret_forest,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_dom_boost": op6_dom_boost,
    "op7_license_rules": op7_license_rules,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_unigram_language_id": op9_unigram_language_id,
    "op10_arrow_sequences": op10_arrow_sequences,
    "op11_source_divergence": op11_source_divergence,
    "op12_personal_data": op12_personal_data,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op1_line_rules": sql.LINE_RULES,
    "op3_temperature_mix": sql.TEMPERATURE_MIX,
    "op5_ngram_jaccard_join": sql.JACCARD,
    "op8_benchmark_decontamination": sql.DECONTAMINATION,
    "op11_source_divergence": sql.SOURCE_DIVERGENCE,
    "op13_prefix_trie": sql.PREFIX_TRIE,
}
