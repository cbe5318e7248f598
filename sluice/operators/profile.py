"""Column profiler (PRF1) and its report (PRF2).

Null counts and moments are one wide aggregate (one job, one scan), unpivoted
to one row per column. Distinct counts treat null as one value (as ``SELECT
DISTINCT`` would) and work on map columns; they and the quantiles are exact at
any size, from one pass of value counts (see :func:`value_counts`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StructType,
)

from sluice.config import DEFAULT_CONFIG, LakeConfig
from sluice.session import stage_table

NUMERIC_TYPES = (DoubleType, FloatType, IntegerType, LongType)
FRACTIONS = (0.25, 0.5, 0.75)


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _as_text(c: Column, data_type) -> Column:
    """Canonical text of a value for exact distinct counting across columns."""
    if isinstance(data_type, MapType):
        return F.to_json(F.array_sort(F.map_entries(c)))
    if isinstance(data_type, (ArrayType, StructType)):
        return F.to_json(c)
    if isinstance(data_type, BinaryType):
        return F.base64(c)
    if isinstance(data_type, (DoubleType, FloatType)):
        # grouping treats -0.0 and 0.0 (and all NaNs) as one value; so do we
        return F.when(c == 0, F.lit("0.0")).otherwise(c.cast("string"))
    return c.cast("string")


def value_counts(df: DataFrame) -> DataFrame:
    """``position, v, x, n``: how often each column holds each value.

    Each row is unpivoted to (position, value text) and counted with partial
    aggregation before the shuffle, so a value shared by a third of all rows
    collapses map-side. ``x`` is the number of a numeric value, else null.
    """
    pairs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("position"),
                        _as_text(_c(f.name), f.dataType).alias("v"),
                        _as_number(_c(f.name), f.dataType).alias("x"),
                    )
                    for i, f in enumerate(df.schema.fields)
                ]
            )
        )
    )
    return pairs.groupBy("position", "v", "x").agg(F.count(F.lit(1)).alias("n"))


def _as_number(c: Column, data_type) -> Column:
    if not isinstance(data_type, NUMERIC_TYPES):
        return F.lit(None).cast("double")
    return F.when(c == 0, F.lit(0.0)).otherwise(c.cast("double"))


def exact_quantiles(counts: DataFrame, fractions: tuple[float, ...]) -> DataFrame:
    """``position, q``: for each numeric column the values at the given fractions.

    The value of rank ceil(fraction * count). Values are range-partitioned on
    (position, value) and ranked inside each partition; the counts of the
    partitions before it (a small table) make that a rank in the column, so a
    column of any number of distinct values is spread over all tasks.
    """
    ranged = counts.filter("x is not null").repartitionByRange("position", "x")
    parts = stage_table(
        ranged.withColumn("part", F.spark_partition_id()).select("position", "x", "n", "part"),
        "profile-values",
    )
    column = Window.partitionBy("position")
    before = column.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("position", "part")
        .agg(F.sum("n").alias("rows"))
        .select(
            "position",
            "part",
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"),
            F.sum("rows").over(column).alias("total"),
        )
    )
    inside = (
        Window.partitionBy("position", "part").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = parts.withColumn("upto", F.sum("n").over(inside)).join(offsets, ["position", "part"])
    last = F.col("offset") + F.col("upto")

    def at(fraction: float) -> Column:
        rank = F.greatest(F.ceil(F.col("total") * F.lit(fraction)), F.lit(1))
        return F.max(F.when((rank <= last) & (rank > last - F.col("n")), F.col("x")))

    return ranked.groupBy("position").agg(F.array(*[at(f) for f in fractions]).alias("q"))


def profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """PRF1: one row per column.

    column_name, position, dtype, row_count, null_count, null_rate,
    distinct_count, min, max, mean, stddev, p25, median, p75
    (numeric statistics only for int/long/float/double columns).

    Null counts and moments come from one plain aggregate. Exact distinct counts
    and exact quantiles share the value counts of :func:`value_counts`, at any
    size of the table; ``exact=False`` uses HyperLogLog and Spark's quantile
    sketches inside the one aggregate instead. Per-column tables (as many rows as
    the schema has columns) are joined on the column position.
    """
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, f in enumerate(fields):
        c = _c(f.name)
        aggs.append(F.sum(c.isNull().cast("long")).alias(f"__n{i}"))
        if not exact:
            aggs.append(
                (F.approx_count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0)))
                .alias(f"__d{i}")
            )
        if isinstance(f.dataType, NUMERIC_TYPES):
            x = c.cast("double")
            aggs += [
                F.min(x).alias(f"__min{i}"),
                F.max(x).alias(f"__max{i}"),
                F.avg(x).alias(f"__mean{i}"),
                F.stddev(x).alias(f"__sd{i}"),
            ]
            if not exact:
                aggs.append(F.percentile_approx(x, list(FRACTIONS)).alias(f"__q{i}"))
    wide = df.agg(*aggs)

    def stat(i: int, name: str) -> Column:
        return F.col(f"__{name}{i}") if f"__{name}{i}" in wide.columns else F.lit(None).cast("double")

    def q(i: int, k: int) -> Column:
        return F.col(f"__q{i}")[k] if f"__q{i}" in wide.columns else F.lit(None).cast("double")

    rows = []
    for i, f in enumerate(fields):
        null_count = F.coalesce(F.col(f"__n{i}"), F.lit(0)).cast("long")
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(i).alias("position"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                F.col("__rows").alias("row_count"),
                null_count.alias("null_count"),
                F.when(F.col("__rows") > 0, null_count / F.col("__rows"))
                .otherwise(F.lit(0.0))
                .alias("null_rate"),
                (stat(i, "d") if not exact else F.lit(None)).cast("long").alias("_d"),
                stat(i, "min").alias("min"),
                stat(i, "max").alias("max"),
                stat(i, "mean").alias("mean"),
                stat(i, "sd").alias("stddev"),
                q(i, 0).alias("p25"),
                q(i, 1).alias("median"),
                q(i, 2).alias("p75"),
            )
        )
    long = wide.select(F.inline(F.array(*rows)))
    if exact:
        counts = stage_table(value_counts(df), "profile-counts")
        dist = counts.groupBy("position").agg(F.count(F.lit(1)).alias("distinct_count"))
        long = (
            long.drop("p25", "median", "p75")
            .join(dist, on="position", how="left")
            .join(exact_quantiles(counts, FRACTIONS), on="position", how="left")
            .withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0)).cast("long"))
            .withColumns({name: F.col("q")[k] for k, name in enumerate(("p25", "median", "p75"))})
        )
    else:
        long = long.withColumn("distinct_count", F.col("_d"))
    return long.select(
        "column_name",
        "position",
        "dtype",
        "row_count",
        "null_count",
        "null_rate",
        "distinct_count",
        "min",
        "max",
        "mean",
        "stddev",
        "p25",
        "median",
        "p75",
    )


def report_flags(prof: DataFrame, config: LakeConfig = DEFAULT_CONFIG) -> DataFrame:
    """PRF2 per column: high null rate (> 5 %) and low cardinality (<= 5 distinct)."""
    return prof.select(
        "column_name",
        "position",
        "row_count",
        (F.col("null_rate") > config.high_null_rate).alias("high_null"),
        (F.col("distinct_count") <= config.low_cardinality).alias("low_cardinality"),
    )


def profile_report(prof: DataFrame, config: LakeConfig = DEFAULT_CONFIG) -> DataFrame:
    """PRF2 summary row: flagged column lists (schema order), and each flag that has any
    with its columns.

    The profile has one row per column, so the lists are bounded by the
    schema width, not by the data.
    """
    flags = report_flags(prof, config)

    def names(flag: str) -> Column:
        picked = F.array_sort(F.collect_list(F.when(F.col(flag), F.struct("position", "column_name"))))
        return F.transform(picked, lambda s: s["column_name"])

    summary = flags.agg(
        names("high_null").alias("high_null_columns"),
        names("low_cardinality").alias("low_cardinality_columns"),
        F.count(F.lit(1)).alias("total_columns"),
        F.coalesce(F.max("row_count"), F.lit(0)).alias("total_rows"),
    )
    found = [F.struct(F.lit(flag).alias("flag"), F.col(f"{flag}_columns").alias("columns"))
             for flag in ("high_null", "low_cardinality")]
    return summary.select(
        "total_rows",
        "total_columns",
        "high_null_columns",
        "low_cardinality_columns",
        F.filter(F.array(*found), lambda f: F.size(f["columns"]) > 0).alias("recommendations"),
    )
