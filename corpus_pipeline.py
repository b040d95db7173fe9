"""A training corpus from raw documents: language, repeated lines, near duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm import decontaminate, language_id, line_chunks, packing, simhash_pivots
from basketlens.llm.common import table
from basketlens.plans.workspace import released_shuffles, written

# A document whose best language scores less has no language that the model knows. Scores of texts under SHORT characters
# fall with the root of the length, whatever the language, and so does what is asked of them.
LEAST_SCORE = 0.25
SHORT = 20


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs``, with ``n_chars`` as long as the text is now."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long"))
    return docs.select(*columns)


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages; those without letters or with a score too low for any go."""
    least = LEAST_SCORE * F.least(F.lit(1.0), F.sqrt(F.char_length(F.trim("text")) / SHORT))
    model = language_id.fit(docs)
    found = language_id.identify(docs, model)
    return found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= least)).select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages and chunks of lines stay where they come first. No document goes, but texts can become empty.

    Passages go whole first, wherever they begin and end; content-defined chunks then go over all that is left. The other way
    round chunks would leave the odd lines of a passage at both ends of it.
    """
    with released_shuffles(spark):
        whole = written(line_chunks.remove_repeated_passages(docs).select(*docs.columns), "whole-passages")
    return _with_length(line_chunks.remove_repeated_chunks(whole), docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at two bits, over shingles of three words."""
    return simhash_pivots.keep_single(docs, shingle=3, limit=2)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out; documents of which nothing is left go."""
    return _with_length(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents in full sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", by_language),
    ("line_dedup", without_repeated_lines),
    ("simhash_near_dedup", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

# Language identification, the fingerprint's hash and the tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
