"""Index of all event ids ever delivered, bucketed by id (D4: WIN1 across batches).

One row per id and run that took a copy of it: the id and the values that decide which
copy is the first (``DEDUP_ORDER``). The files are hash-bucketed and sorted by id,
so looking up a batch shuffles the batch alone: Spark reads each bucket where it is
joined, with no exchange on the index side, however large and old the history.
Per id the smallest order counts, so adding rows twice changes nothing.

The table is ordinary bucketed Parquet in a folder; its entry in the session's catalog
only names the folder and the buckets, and is made again by whoever reads it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.dedup import DEDUP_ORDER
from sluice.session import path_exists

#: Stands for a null event id, so that the join is a plain equality.
NULL_ID = "\x00"
_TYPES = {
    "ingestion_timestamp": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
    "kafka_partition": "INT",
    "kafka_offset": "BIGINT",
    "value": "DOUBLE",
}


def id_of(event_id: str = "event_id") -> Column:
    return F.coalesce(F.col(event_id), F.lit(NULL_ID))


def order_of() -> Column:
    """The values that order the copies of an event, smallest first (nulls before all)."""
    return F.struct(*[F.col(c) for c in DEDUP_ORDER])


def _table(spark: SparkSession, path: str, buckets: int) -> str:
    name = f"sluice_keys_{hashlib.sha256(path.encode()).hexdigest()[:20]}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{c}` {_TYPES[c]}" for c in DEDUP_ORDER)
        where = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} (id STRING, {columns}) USING parquet "
            f"CLUSTERED BY (id) SORTED BY (id) INTO {buckets} BUCKETS LOCATION '{where}'"
        )
    return name


def add_keys(rows: DataFrame, path: str, buckets: int) -> None:
    """Add the ids and orders of ``rows`` (bronze columns); one shuffle of these columns."""
    name = _table(rows.sparkSession, path, buckets)
    (
        rows.select(id_of().alias("id"), *DEDUP_ORDER)
        .repartition(buckets, "id")
        .sortWithinPartitions("id")
        .write.insertInto(name)
    )


def known_keys(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """``id, known``: the order of the first copy of every id taken so far."""
    name = _table(spark, path, buckets)
    spark.catalog.refreshTable(name)
    return spark.table(name).groupBy("id").agg(F.min(order_of()).alias("known"))


def with_known(rows: DataFrame, path: str, buckets: int) -> DataFrame:
    """``rows`` with ``_known``: the order of the copy taken earlier, null for a new id."""
    spark = rows.sparkSession
    if not path_exists(spark, path):
        return rows.withColumn("_known", F.lit(None).cast(rows.select(order_of()).schema[0].dataType))
    # The buckets' own partitioning for the batch, so that only the batch moves.
    mine = rows.withColumn("_id", id_of()).repartition(buckets, F.col("_id"))
    known = known_keys(spark, path, buckets).hint("merge")
    return (
        mine.join(known, mine["_id"] == known["id"], "left")
        .drop("_id", "id")
        .withColumnRenamed("known", "_known")
    )


def compact_keys(spark: SparkSession, path: str, target: str, buckets: int) -> None:
    """Rewrite the index at ``path`` to ``target`` with one row per id and one file per
    bucket. No exchange: rows stay in their bucket."""
    known = known_keys(spark, path, buckets)
    name = _table(spark, target, buckets)
    known.select("id", *[F.col(f"known.{c}").alias(c) for c in DEDUP_ORDER]).sortWithinPartitions(
        "id"
    ).write.insertInto(name)
