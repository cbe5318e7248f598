"""Sharding by vector bin packing.

Bytes, tokens and rows are balanced jointly. The unit is the group of equal
texts; each is placed in the shard where the dot product of its size vector
with the shard's residual capacity (both as shares of a shard, bytes weighing
most) is highest.

How it scales: groups are map-side aggregated sums. A group larger than 1/64 of
a shard is heavy: there are at most 64 x shards x 3 of those, so they are placed
first, on the driver, largest first. All others are dealt by hash to lanes of a
bounded number of groups; every lane packs its groups, largest first, into its
own part of each shard's remaining capacity, so lanes need not talk to each
other and the shards still fill evenly. Slots are numbered from counts per
(shard, bucket): no window ever holds a whole shard, nor all rows of a large group,
even if they share one id.

A group larger than a whole shard cannot stay together if shards are to be
equal; only such a group is split, by a hash of its ids and of its rows' places in
the staged table (so that one id repeated throughout is split as well), into pieces of
a quarter shard that are placed like groups. There are fewer of them than shards.

Defined cases: null text has no bytes and no tokens (its row still counts);
size is the UTF-8 bytes of the text plus 8; rows that repeat are members of one
group and get slots of their own; a null id is packed like any other; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import ship, stage, text_or_empty

SHARDS = 24
#: Bytes that a row costs besides its text.
ROW_BYTES = 8
#: A group above this part of a shard is placed by the driver.
HEAVY_PART = 64
#: Groups of a lane and rows of a numbering bucket (one task's memory each).
LANE_GROUPS = 100_000
BUCKET_ROWS = 100_000
_DIMS = ("bytes", "tokens", "rows")
_PLACES = "key long, piece int, shard int, many boolean"
#: Weights in the dot product: bytes are what must come out near equal.
_WEIGHTS = np.array([8.0, 1.0, 1.0])


def place(sizes: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """Shard of each group. ``sizes`` is (groups, 3) in shares of a shard and
    ``capacity`` (shards, 3); groups are taken largest first, ties by position."""
    residual = capacity.astype(float).copy()
    out = np.empty(len(sizes), np.int32)
    order = np.argsort(-sizes.sum(axis=1), kind="stable")
    for i in order:
        best = int((residual @ (_WEIGHTS * sizes[i])).argmax())
        out[i] = best
        residual[best] -= sizes[i]
    return out


def _lane(share: np.ndarray, shard_sizes: np.ndarray):
    """Pack one lane: ``share`` is each shard's part of what is left to place."""
    bucket_rows = BUCKET_ROWS

    def run(groups: pa.Table) -> pa.Table:
        keys = groups.column("key").to_numpy()
        order = np.argsort(keys, kind="stable")  # same result however rows arrive
        sizes = np.stack([groups.column(d).to_numpy()[order] for d in _DIMS], axis=1) / shard_sizes
        shard = place(sizes, sizes.sum(axis=0) * share)
        return pa.table(
            {
                "key": pa.array(keys[order]),
                "piece": pa.array(np.zeros(len(keys), np.int32)),
                "shard": pa.array(shard),
                "many": pa.array(groups.column("rows").to_numpy()[order] > bucket_rows),
            }
        )

    return run


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` per row."""
    spark = docs.sparkSession
    ship(spark)
    text = text_or_empty()
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
        F.monotonically_increasing_id().alias("row"),  # fixed by staging
    )
    base = stage(base, "shard-rows")
    groups = stage(
        base.groupBy("key").agg(
            F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")
        ),
        "shard-groups",
    )
    total = groups.agg(*[F.sum(d).alias(d) for d in _DIMS], F.count("*").alias("n")).first()
    shard_sizes = np.maximum([(total[d] or 0) / shards for d in _DIMS], 1e-9)

    limits = shard_sizes / HEAVY_PART
    is_heavy = F.lit(False)
    for d, limit in zip(_DIMS, limits.tolist(), strict=True):
        is_heavy = is_heavy | (F.col(d) > F.lit(limit))
    # At most HEAVY_PART * shards groups can exceed the limit in each dimension.
    heavy = groups.filter(is_heavy).orderBy("key").collect()
    units: list[tuple[int, int, np.ndarray]] = []
    split: list[tuple[int, int]] = []
    many = {g["key"]: g["rows"] > BUCKET_ROWS for g in heavy}
    for g in heavy:
        vector = np.array([g[d] for d in _DIMS], float) / shard_sizes
        pieces = int(np.ceil(4 * vector.max())) if vector.max() > 1 else 1
        if pieces > 1:
            split.append((g["key"], pieces))
        units += [(g["key"], p, vector / pieces) for p in range(pieces)]
    load = np.zeros((shards, len(_DIMS)))
    placed: list[tuple[int, int, int, bool]] = []
    if units:
        sizes = np.stack([u[2] for u in units])
        where = place(sizes, np.ones((shards, len(_DIMS))))
        np.add.at(load, where, sizes)
        placed = [(u[0], u[1], int(s), many[u[0]]) for u, s in zip(units, where, strict=True)]
    left = np.maximum(1 - load, 0)
    share = left / np.maximum(left.sum(axis=0), 1e-9)

    lanes = 1 + (total["n"] or 0) // LANE_GROUPS
    light = (
        groups.filter(~is_heavy)
        .withColumn("lane", F.pmod(F.xxhash64("key"), F.lit(lanes)))
        .groupBy("lane")
        .applyInArrow(_lane(share, shard_sizes), _PLACES)
    )
    places = stage(
        light.unionByName(spark.createDataFrame(placed, _PLACES)),
        "shard-places",
    )
    pieces = spark.createDataFrame(split, "key long, pieces int")  # fewer rows than shards
    buckets = 1 + (total["rows"] or 0) // BUCKET_ROWS
    rows = stage(
        base.join(F.broadcast(pieces), "key", "left")
        .withColumn(
            "piece",
            F.coalesce(F.pmod(F.xxhash64("doc_id", "row"), F.col("pieces")), F.lit(0)).cast("int"),
        )
        .join(places, ["key", "piece"])
        .withColumn(
            "bucket",
            F.pmod(F.xxhash64("doc_id", "key", F.when(F.col("many"), F.col("row"))), F.lit(buckets)),
        )
        .select("doc_id", "size", "text_crc32", "shard", "bucket"),
        "shard-members",
    )
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("at", F.row_number().over(inside))
        .join(offsets, ["shard", "bucket"])
        .select(
            "doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("at") - 1).alias("slot")
        )
    )
