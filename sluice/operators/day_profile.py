"""Profiles of days from mergeable sketches (AGG10, AGG11, PRF1 in approximate form).

:func:`day_sketches` leaves one row per day and column: counts, extremes, moments, a
HyperLogLog sketch of the distinct values and a KLL sketch of the numbers. Rows of
different days merge, so the profile of any span of days reads these few rows and no
data; when a day changes only that day is read again (:func:`update_days`).

Stated errors: distinct counts have a relative standard error of 1.04 / sqrt(2^12), 1.6 %;
quantiles are values whose rank is off by at most 1.65 % of all values (KLL with k = 200,
99 % confidence). Counts, extremes and moments are exact. The exact profile at any size
is :func:`sluice.operators.profile.profile`.

Partial aggregation keeps one sketch per column, day and task before the shuffle, so a
day that holds most rows is no larger than any other.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.profile import FRACTIONS, NUMERIC_TYPES, _as_text, _c
from sluice.operators.window_state import both_moments
from sluice.sources.tables import write_partitioned

DISTINCT_ERROR = 3 * 0.0163
RANK_ERROR = 0.0165
_HLL_BITS, _KLL_K = 12, 200


def day_sketches(df: DataFrame, day: str) -> DataFrame:
    """``day, column_name, position`` and the mergeable state of every other column."""
    fields = [(i, f) for i, f in enumerate(df.schema.fields) if f.name != day]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, f in fields:
        c = _c(f.name)
        aggs += [
            F.count(c).alias(f"n{i}"),
            F.hll_sketch_agg(_as_text(c, f.dataType), F.lit(_HLL_BITS)).alias(f"d{i}"),
        ]
        if isinstance(f.dataType, NUMERIC_TYPES):
            x = c.cast("double")
            aggs += [
                F.min(x).alias(f"min{i}"),
                F.max(x).alias(f"max{i}"),
                F.struct(
                    F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2")
                ).alias(f"m{i}"),
                F.kll_sketch_agg_double(x, F.lit(_KLL_K)).alias(f"q{i}"),
            ]
    wide = df.groupBy(F.col(day).alias("day")).agg(*aggs)

    def of(name: str, i: int, kind: str) -> Column:
        known = f"{name}{i}" in wide.columns
        return (F.col(f"{name}{i}") if known else F.lit(None)).cast(kind)

    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(i).alias("position"),
            F.col("rows").alias("row_count"),
            (F.col("rows") - F.col(f"n{i}")).alias("null_count"),
            of("min", i, "double").alias("min"),
            of("max", i, "double").alias("max"),
            of("m", i, "struct<n:bigint,mean:double,m2:double>").alias("moments"),
            F.col(f"d{i}").alias("distinct_sketch"),
            of("q", i, "binary").alias("quantile_sketch"),
        )
        for i, f in fields
    ]
    return wide.select("day", F.inline(F.array(*rows)))


def update_days(df: DataFrame, day: str, path: str, days: Sequence[dt.date] | None = None) -> int:
    """Sketch some days of a table (default: all) into the sketch table at ``path``; other
    days stay as they are. Only these days of ``df`` are read."""
    if days is not None:
        df = df.filter(F.col(day).isin(list(days)))
    return write_partitioned(day_sketches(df, day), path, ("day",), "overwrite", days is not None, name="sketches")


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("day", F.col("day").cast("date"))


def merged_profile(sketches: DataFrame) -> DataFrame:
    """Profile of the days in ``sketches``, one row per column."""
    none = F.struct(
        F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("m2")
    )
    # One part per day and column: the list that is folded has as many entries as days.
    parts = F.collect_list(F.when(F.col("moments.n") > 0, F.col("moments")))
    merged = sketches.groupBy("column_name", "position").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.reduce(F.array_sort(parts), none, both_moments).alias("m"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct"),
        F.kll_merge_agg_double("quantile_sketch").alias("q"),
    )
    numeric = F.col("m.n") > 0

    def quantile(fraction: float) -> Column:
        return F.when(numeric, F.kll_sketch_get_quantile_double("q", F.lit(fraction)))

    p25, median, p75 = (quantile(f) for f in FRACTIONS)
    return merged.select(
        "column_name",
        "position",
        "row_count",
        "null_count",
        # A null counts as one value.
        (F.col("distinct") + (F.col("null_count") > 0).cast("long")).alias("distinct_count"),
        "min",
        "max",
        F.col("m.mean").alias("mean"),
        F.when(F.col("m.n") > 1, F.sqrt(F.col("m.m2") / (F.col("m.n") - 1))).alias("stddev"),
        p25.alias("p25"),
        median.alias("median"),
        p75.alias("p75"),
    )
