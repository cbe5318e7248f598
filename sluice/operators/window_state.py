"""Mergeable state of the gold windows (AGG1, AGG2).

One row per (facility, sensor type, window) holds counts, sums, extremes, and mean and
M2 (the sum of squared distances from the mean) of the values. States of disjoint
sets of rows merge into the state of all of them: counts and sums add up, and mean and
M2 combine pairwise (``M2 = M2a + M2b + (mean_b - mean_a)^2 * na * nb / n``), which loses no
precision however far the mean is from zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.aggregate import window_start

KEYS = ("facility_id", "sensor_type", "window_start")
_SUMS = (
    "event_count", "value_sum", "anomaly_count", "flag_n", "quality_sum", "quality_n",
    "z_sum", "z_abs_sum", "z_n",
)


def window_state(rows: DataFrame, minutes: int) -> DataFrame:
    """State of every window of silver rows, with its day ``state_date``."""
    value, z = F.col("value"), F.col("z_score")
    grouped = rows.groupBy("facility_id", "sensor_type", window_start(minutes).alias("window_start")).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum(value).alias("value_sum"),
        F.min(value).alias("value_min"),
        F.max(value).alias("value_max"),
        F.struct(
            F.count(value).alias("n"),
            F.avg(value).alias("mean"),
            (F.var_pop(value) * F.count(value)).alias("m2"),
        ).alias("moments"),
        F.sum(F.col("is_anomaly").cast("long")).alias("anomaly_count"),
        F.count("is_anomaly").alias("flag_n"),
        F.sum("quality_score").alias("quality_sum"),
        F.count("quality_score").alias("quality_n"),
        F.sum(z).alias("z_sum"),
        F.sum(F.abs(z)).alias("z_abs_sum"),
        F.max(F.abs(z)).alias("z_abs_max"),
        F.count(z).alias("z_n"),
    )
    return grouped.withColumn("state_date", F.to_date("window_start"))


def both_moments(a: Column, b: Column) -> Column:
    """Moments of two disjoint sets of values."""
    n = a["n"] + b["n"]
    apart = b["mean"] - a["mean"]
    joined = F.struct(
        n.alias("n"),
        (a["mean"] + apart * b["n"] / n).alias("mean"),
        (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"),
    )
    return F.when(a["n"] == 0, b).when(b["n"] == 0, a).otherwise(joined)


def merge_states(states: DataFrame) -> DataFrame:
    """States merged per window. A window has one part per run that touched it since the
    last merge, so the list that is folded is short."""
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("m2"))
    merged = states.groupBy(*KEYS, "state_date").agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        F.min("value_min").alias("value_min"),
        F.max("value_max").alias("value_max"),
        F.max("z_abs_max").alias("z_abs_max"),
        F.reduce(F.array_sort(F.collect_list("moments")), none, both_moments).alias("moments"),
    )
    return merged.select(states.columns)


def base_from_state(state: DataFrame) -> DataFrame:
    """The window base of :mod:`sluice.operators.aggregate`, from merged states."""

    def over(total: str, n: str) -> Column:
        return F.col(total) / F.nullif(F.col(n), F.lit(0))

    m = F.col("moments")
    return state.select(
        *KEYS,
        "event_count",
        over("value_sum", "moments.n").alias("avg_value"),
        F.col("value_min").alias("min_value"),
        F.col("value_max").alias("max_value"),
        F.when(m["n"] > 1, F.sqrt(m["m2"] / (m["n"] - 1))).alias("stddev_value"),
        "anomaly_count",
        over("anomaly_count", "flag_n").alias("anomaly_rate"),
        over("quality_sum", "quality_n").alias("avg_quality_score"),
        over("z_sum", "z_n").alias("avg_z_score"),
        F.col("z_abs_max").alias("max_abs_z_score"),
        F.col("z_abs_sum").alias("_abs_z_sum"),
        F.col("z_n").alias("_abs_z_n"),
        F.col("anomaly_count").cast("double").alias("_flag_sum"),
        F.col("flag_n").alias("_flag_n"),
        F.col("quality_sum").alias("_quality_sum"),
        F.col("quality_n").alias("_quality_n"),
    )
