"""First-copy deduplication (WIN1). Copies in later batches (D4) are told by the index of
all ids, :mod:`sluice.sources.key_index`, in the same order.

``row_number() == 1`` over ``event_id`` is the reference semantics. Catalyst
rewrites it into ``WindowGroupLimit``: a *partial* limit runs before the
shuffle, so each map task forwards at most one row per event id. A hot id
re-sent millions of times therefore costs one row per map task in the
exchange, not millions in one reducer.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Order that decides which copy survives. The reference orders by ingestion
# time only; every row of one micro-batch shares that value, so we break ties
# on event time, then source position, then value (deterministic on retries).
DEDUP_ORDER: tuple[str, ...] = (
    "ingestion_timestamp",
    "timestamp",
    "kafka_partition",
    "kafka_offset",
    "value",
)


def _order_cols(df: DataFrame, order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in order if c in df.columns]


def dedup_first(
    df: DataFrame, key: str = "event_id", order: Sequence[str] = DEDUP_ORDER
) -> DataFrame:
    """WIN1: keep the first copy of each ``key`` by ``order`` (all columns kept)."""
    w = Window.partitionBy(key).orderBy(*_order_cols(df, order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
