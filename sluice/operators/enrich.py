"""Silver enrichment: rolling statistics, z-scores, time features (WIN2-3, PRJ3, PRJ9-12).

The rolling frame is "this row and the 99 before it" per (sensor_id,
sensor_type) in event-time order. Written directly as one window, a sensor's
whole history is sorted by a single task; a sensor holding a third of the data
would stall the job (AQE splits skewed joins, not windows).

``strategy="chunked"`` (the default) gives the same frame with bounded tasks. The
rows are staged and counted per sensor (keys only). Sensors of at most ``chunk_rows`` rows
go through the plain window: one exchange of full rows, and a sort that no single
sensor can make larger than a chunk. Only sensors with more rows are cut:

1. number the rows of each sensor: by default (``numbering="range"``) rows are
   range-partitioned on (sensor, event time, event_id), so Spark's sampled
   split points cut even one hot sensor-hour into balanced partitions, and
   each row takes its index in its sorted partition; ``numbering="bucket"``
   numbers rows inside (sensor, hour) buckets instead (one hash shuffle, but
   one task per bucket);
2. a running sum over the small group table (one row per sensor and
   partition or bucket) turns that into each row's position in the sensor's
   full history;
3. cut positions into chunks of ``chunk_rows`` and copy the last 99 rows of
   each chunk into the next one (a ~99/chunk_rows overhead);
4. run the frame per (sensor, chunk) and drop the copies.

The numbered rows feed both the group table and the join, so they are staged
once as Parquet below the shared checkpoint folder: the upstream dedup shuffle
is not run twice, both consumers see the same indices and read only the columns
they need, and a lost executor costs a re-read instead of a run from bronze.

Every task then sorts at most ``chunk_rows + 99`` rows of one sensor, however
skewed the sensor distribution. Both strategies feed the frame identical rows
in identical order, so results are bit-identical.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.config import DEFAULT_CONFIG, LakeConfig
from sluice.session import stage_table
from sluice.functions.columns import day_of_week, hour_of_day, is_business_hours, z_score

SENSOR_KEYS: tuple[str, ...] = ("sensor_id", "sensor_type")
# Event-time order with event_id as tie-break: deterministic frames.
ROLLING_ORDER: tuple[str, ...] = ("timestamp", "event_id")


def rolling_stats(
    df: DataFrame,
    value: str = "value",
    keys: Sequence[str] = SENSOR_KEYS,
    order: Sequence[str] = ROLLING_ORDER,
    rows: int = 100,
    strategy: str = "chunked",
    chunk_rows: int = 1 << 18,
    bucket: str = "hour",
    materialize: bool = True,
    numbering: str = "range",
) -> DataFrame:
    """WIN2/WIN3: add ``rolling_mean`` and ``rolling_stddev`` (sample) over a rows frame."""
    keys, order = list(keys), list(order)
    lookback = rows - 1
    if strategy == "direct":
        return _direct(df, value, keys, order, lookback)
    if strategy != "chunked":
        raise ValueError(f"unknown strategy {strategy!r}")
    if chunk_rows <= lookback:
        raise ValueError("chunk_rows must exceed the frame's lookback")
    if materialize:
        df = stage_table(df, "rolling-input")
    large = df.groupBy(*keys).count().filter(F.col("count") > chunk_rows).select(*keys)
    if materialize:
        large = stage_table(large, "rolling-large")
    if large.isEmpty():
        return _direct(df, value, keys, order, lookback)

    def of_large(how: str) -> DataFrame:
        same = F.lit(True)
        for k in keys:
            same = same & df[k].eqNullSafe(large[k])
        return df.join(large, same, how)

    small = _direct(of_large("left_anti"), value, keys, order, lookback)
    return small.unionByName(
        _chunked(of_large("left_semi"), value, keys, order, lookback, chunk_rows, numbering, bucket, materialize)
    )


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """Cluster rows by ``keys`` for a window over them, in as many partitions as the session
    shuffles into. A frame costs its length for each row, not the row's bytes: partitions
    merged by size would be about one a core and one over, so two rounds of long tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _direct(df: DataFrame, value: str, keys: list[str], order: list[str], lookback: int) -> DataFrame:
    """The frame as one window per sensor."""
    df = _spread(df, *keys)
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-lookback, 0)
    return df.withColumn("rolling_mean", F.avg(value).over(w)).withColumn(
        "rolling_stddev", F.stddev(value).over(w)
    )


def _chunked(
    df: DataFrame, value: str, keys: list[str], order: list[str], lookback: int,
    chunk_rows: int, numbering: str, bucket: str, materialize: bool,
) -> DataFrame:
    """The frame of sensors that are cut into chunks of positions."""
    numbered, groups = _number_rows(df, keys, order, numbering, bucket, materialize)
    # Running row count of the preceding groups of each sensor: a window over
    # the small group table only (one row per sensor and group).
    starts = groups.withColumn(
        "_start",
        F.coalesce(
            F.sum("_n").over(
                Window.partitionBy(*keys)
                .orderBy(F.col("_g").asc_nulls_first())
                .rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    ).select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.col("_g").alias("_s_g"), "_first", "_start")
    cond = None
    for k in keys + ["_g"]:
        part = numbered[k].eqNullSafe(starts[f"_s_{k}" if k != "_g" else "_s_g"])
        cond = part if cond is None else cond & part
    # The group table is joined by AQE's measured size (broadcast when small).
    positioned = numbered.join(starts, cond, "inner").withColumn(
        "_pos", F.col("_start") + F.col("_rn0") - F.col("_first")
    )
    chunk = F.floor(F.col("_pos") / F.lit(chunk_rows))
    offset = F.col("_pos") - chunk * F.lit(chunk_rows)
    spread = positioned.withColumn("_own", chunk).withColumn(
        "_chunk",
        F.explode(
            F.when(offset >= F.lit(chunk_rows - lookback), F.array(chunk, chunk + 1)).otherwise(
                F.array(chunk)
            )
        ),
    )
    spread = _spread(spread, *keys, "_chunk")
    w = Window.partitionBy(*keys, "_chunk").orderBy("_pos").rowsBetween(-lookback, 0)
    out = (
        spread.withColumn("rolling_mean", F.avg(value).over(w))
        .withColumn("rolling_stddev", F.stddev(value).over(w))
        .filter(F.col("_chunk") == F.col("_own"))
    )
    drop = ["_g", "_rn0", "_first", "_start", "_pos", "_own", "_chunk"]
    drop += [f"_s_{k}" for k in keys] + ["_s_g"]
    return out.drop(*drop)


def _number_rows(df, keys, order, numbering, bucket, materialize):
    """Rows with (_g, _rn0) and the group table (keys, _g, _n, _first).

    A row's position in its sensor's history is
    ``sum(_n of the sensor's earlier groups) + _rn0 - _first``.

    * ``bucket``: groups are (sensor, time bucket); ``_rn0`` is the 0-based
      ``row_number`` inside the bucket, ``_first`` is 0. One hash shuffle, but
      a single bucket is numbered by one task.
    * ``range``: rows are range-partitioned on (sensor, event time, event_id);
      Spark samples the split points, so any run of rows, even one sensor-hour
      holding a third of the data, is cut into balanced partitions. Groups are
      (sensor, partition); ``_rn0`` is the row's index in its sorted partition
      and ``_first`` the group's smallest index. The rows must be staged so
      that both consumers see the same indices. Choosing the split points
      costs one sampling pass over the (already shuffled) deduplicated rows.
    """
    if numbering == "bucket":
        numbered = df.withColumn("_g", F.date_trunc(bucket, F.col(order[0]))).withColumn(
            "_rn0", F.row_number().over(Window.partitionBy(*keys, "_g").orderBy(*order)) - 1
        )
        if materialize:
            # Both the group table and the join read ``numbered``: staging it
            # stops the upstream (dedup shuffle) from running twice, cuts the
            # lineage; the group aggregate then reads only keys and numbers.
            numbered = stage_table(numbered, "rolling-rows")
        groups = numbered.groupBy(*keys, "_g").agg(
            (F.max("_rn0") + 1).alias("_n"), F.lit(0).cast("long").alias("_first")
        )
        return numbered, groups
    if numbering != "range":
        raise ValueError(f"unknown numbering {numbering!r}")
    sort_cols = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    ranged = df.repartitionByRange(*sort_cols).sortWithinPartitions(*sort_cols)
    numbered = stage_table(
        ranged.withColumn("_g", F.spark_partition_id().cast("long")).withColumn(
            "_rn0", F.monotonically_increasing_id()
        ),
        "rolling-rows",
    )
    groups = numbered.groupBy(*keys, "_g").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_rn0").alias("_first")
    )
    return numbered, groups


def time_features(df: DataFrame, config: LakeConfig = DEFAULT_CONFIG) -> DataFrame:
    """PRJ3, PRJ10-12: hour, weekday, business-hours flag, event_date."""
    return (
        df.withColumn("hour_of_day", hour_of_day())
        .withColumn("day_of_week", day_of_week())
        .withColumn("is_business_hours", is_business_hours(config=config))
        .withColumn("event_date", F.to_date("timestamp"))
    )


def enrich(
    df: DataFrame, config: LakeConfig = DEFAULT_CONFIG, strategy: str = "chunked"
) -> DataFrame:
    """Rolling stats + z-score + time features (the silver ``enrich`` step)."""
    rolled = rolling_stats(
        df,
        rows=config.rolling_rows,
        strategy=strategy,
        chunk_rows=config.rolling_chunk_rows,
        bucket=config.rolling_bucket,
        numbering=config.rolling_numbering,
    )
    return time_features(rolled.withColumn("z_score", z_score()), config)
