"""One query per operator over the whole of its table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from basketlens.llm import (
    conversation_repair,
    decontaminate,
    language_id,
    line_chunks,
    packing,
    pii_surrogates,
    pivot_permutation,
    repeat_intervals,
    simhash_pivots,
    spelling_kdtree,
    url_vocabulary,
    virtual_slots,
    warc_zstd,
)
from basketlens.llm.common import table
from basketlens.plans.workspace import scratch_path, written

Query = Callable[[SparkSession, str], DataFrame]

# A deployment brings its own secret.
SURROGATE_KEY = b"replace this key before use"
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
SHARDS = 40


def op1_pii_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return pii_surrogates.replace_entities(docs, SURROGATE_KEY)


def op2_line_chunks(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return line_chunks.remove_repeated_chunks(docs)


def op2_line_passages(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return line_chunks.remove_repeated_passages(docs)


def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(~language_id.held_out()))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op4_warc_zstd(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    path = scratch_path(spark, "archives")
    dictionary = warc_zstd.train_dictionary(pages.select(F.encode("html", "UTF-8").alias("payload")))
    warc_zstd.write_archives(warc_zstd.with_revisits(pages), path, dictionary)
    records = warc_zstd.read_archives(spark, path)
    return records.select(
        warc_zstd.page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc_zstd.page_of("refers_to").alias("refers_to"),
        "error",
    )


def op5_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op6_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "tier",
        "step_group",
    )


def op7_simhash_pivots(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash_pivots.near_duplicates(table(spark, sf, "documents"), shingle=3, limit=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_url_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return url_vocabulary.filter_urls(table(spark, sf, "pages"), URL_RULES)


def op9_pivot_permutation(spark: SparkSession, sf: str) -> DataFrame:
    return pivot_permutation.near_duplicates(table(spark, sf, "embeddings"))


def op10_virtual_slots(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    placed = virtual_slots.shard_documents(docs, SHARDS, scratch_path(spark, "slot-map"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def op11_repeat_intervals(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    cut = repeat_intervals.remove_repeats(docs)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_four_russians(spark: SparkSession, sf: str) -> DataFrame:
    conversations = table(spark, sf, "conversations")
    rows = written(conversation_repair.repair(conversation_repair.damaged(conversations)), "repaired")
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = rows.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.count_if("illegal").alias("illegal"),
        F.sum("cost").cast("long").alias("cost"),
    )
    found = counts.join(conversation_repair.audits(rows).withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv")))
    asked = conversations.select(F.col("conv_id").alias("asked")).distinct()
    joined = asked.join(found.drop("_conv"), F.col("asked").eqNullSafe(F.col("conv_id")), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        F.col("asked").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_spelling_kdtree(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return spelling_kdtree.group_variants(spelling_kdtree.word_counts(docs, damage=True))


def llm_queries() -> dict[str, Query]:
    own = [
        op1_pii_surrogates,
        op2_line_chunks,
        op2_line_passages,
        op3_language_id,
        op4_warc_zstd,
        op5_decontaminate,
        op6_packing,
        op7_simhash_pivots,
        op8_url_vocabulary,
        op9_pivot_permutation,
        op10_virtual_slots,
        op11_repeat_intervals,
        op12_four_russians,
        op13_spelling_kdtree,
    ]
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}
