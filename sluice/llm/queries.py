"""Queries of the training-data operators: one ``opN_<name>`` per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import (
    chat_format,
    decontaminate,
    exact_dedup,
    fim,
    line_dedup,
    mixing,
    near_dedup,
    phrases,
    secrets_crf,
    sharding,
    substring_dedup,
    token_align,
    toxicity,
)
from sluice.llm.common import table

CHAT_PROBE = "\\### Assistant: </turn> ok"


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document: base patterns and the trained field."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets_crf.digests(docs, secrets_crf.train(docs))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by compression distance."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col("_score").alias("score"),
        F.col("_predicted").alias("predicted"),
    )


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format every conversation and digest what reading back gives."""
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CHAT_PROBE).alias("text"),
    )
    records = rows.unionByName(probe).select(
        "conv_id", F.to_variant_object(F.struct("turn", "role", "text")).alias("record")
    )
    turns = chat_format.canonical_turns(records, "conv_id", "record")
    return chat_format.chat_digests(chat_format.format_chats(turns, "conv_id"), "conv_id")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards of nearly equal bytes."""
    return sharding.assign_shards(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling decision of every document at the raked probabilities."""
    return mixing.sampling_decisions(table(spark, sf_dir, "documents")).withColumn(
        "probability", F.round("probability", 6)
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents after removal of repeated three-line windows, as digests."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_removed").alias("n_removed"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents after removal of 13-word windows that a smaller document has."""
    return substring_dedup.dedup_substrings(
        table(spark, sf_dir, "documents"), digest=True
    ).withColumnRenamed("kept", "kept_sha256")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of whole normalised texts by block naming."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark_contamination(docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    ids = F.array_join(F.array_sort(F.transform("_items", lambda i: i.cast("string"))), ",")
    return marked.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        F.col("_contaminated").alias("contaminated"),
    )


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, and its likeness to an edited text and the next."""
    return phrases.edited_pairs(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle example of every document, and the text read back from it."""
    made = fim.fim_examples(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of two tokenizers' tokens in every document, and their links' counts."""
    return token_align.align_documents(table(spark, sf_dir, "documents"), digest=True).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        "n_best",
        "count_sum",
        F.col("groups").alias("groups_sha256"),
    )


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_toxicity": op2_toxicity,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_sharding": op4_sharding,
    "op5_mixing": op5_mixing,
    "op6_line_dedup": op6_line_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_fingerprints": op11_fingerprints,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_token_alignment": op13_token_alignment,
}
