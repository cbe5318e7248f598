"""Training-corpus pipeline: five stages from raw documents to shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``; rows that a stage rejects are gone for all
later ones.

1. ``toxicity``: rejects documents predicted toxic by compression distance.
2. ``near_dedup``: of each group of near-duplicates the row with the smallest id stays,
   once; rows are told by id and text, so texts that share an id are judged apart.
3. ``decontaminate``: rejects documents that hold benchmark passages.
4. ``mix``: samples documents at probabilities raked to source, language and
   topic targets.
5. ``shard``: deals the rest to 24 shards of nearly equal bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import decontaminate as contamination
from sluice.llm import mixing, near_dedup, sharding
from sluice.llm import toxicity as toxic
from sluice.llm.common import shielded, stage, table

#: The compression classifier has no SQL form; the tests compare the stages with
#: brute force instead.
ORACLE_SQL = None

#: Share of all tokens that the mixing stage keeps in expectation.
KEEP_TOKENS = 0.9


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxic.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return shielded(docs, lambda d: toxic.score_documents(d, model).filter("_predicted = 0"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    return shielded(
        docs, lambda d: contamination.mark_contamination(d, items).filter(~F.col("_contaminated"))
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shielded(docs, lambda d: mixing.sample_to_targets(d, keep=KEEP_TOKENS).filter("_sampled"))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the shard of every document that is left."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
