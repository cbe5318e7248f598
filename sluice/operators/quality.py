"""Data-quality suite (DQ1-5) as one grouped scan.

The per-type checks (null rate, in-range rate, coefficient of variation) come
from a single ``groupBy(sensor_type).agg`` with partial aggregation; the
thresholds are ``CASE`` expressions built from the configuration, so no join
is needed. Results are rows (one per expectation) in long form:

    check_name, check_type, sensor_type, success, observed_value, details
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    StringType,
    StructField,
    StructType,
)

from sluice.config import DEFAULT_CONFIG, REQUIRED_COLUMNS, LakeConfig

CHECK_SCHEMA = StructType(
    [
        StructField("check_name", StringType(), False),
        StructField("check_type", StringType(), False),
        StructField("sensor_type", StringType(), True),
        StructField("success", BooleanType(), False),
        StructField("observed_value", DoubleType(), True),
        StructField("details", StringType(), True),
    ]
)


def schema_checks(spark: SparkSession, df: DataFrame) -> DataFrame:
    """DQ1: one ``column_exists_<c>`` row per required column (metadata only)."""
    present = set(df.columns)
    rows = [
        (
            f"column_exists_{c}",
            "schema",
            None,
            c in present,
            1.0 if c in present else 0.0,
            f"Column '{c}' {'exists' if c in present else 'is missing'}",
        )
        for c in REQUIRED_COLUMNS
    ]
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def _per_type(config: LakeConfig, pick) -> Column:
    expr = None
    for sensor_type, limits in config.sensor_limits.items():
        val = pick(limits)
        cond = F.col("sensor_type") == sensor_type
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def _out_of_range(config: LakeConfig) -> Column:
    """1 when value is outside its type's [min, max] (null values are in range)."""
    expr = None
    for sensor_type, limits in config.sensor_limits.items():
        if limits.min_value is None or limits.max_value is None:
            continue
        bad = (F.col("value") < limits.min_value) | (F.col("value") > limits.max_value)
        cond = (F.col("sensor_type") == sensor_type) & bad
        expr = F.when(cond, 1) if expr is None else expr.when(cond, 1)
    return F.lit(0) if expr is None else expr.otherwise(0)


def type_stats(df: DataFrame, config: LakeConfig = DEFAULT_CONFIG) -> DataFrame:
    """AGG7-9 in one grouped pass: per sensor type count, nulls, out-of-range, mean, stddev."""
    return df.groupBy("sensor_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("value").isNull().cast("long")).alias("null_n"),
        F.sum(_out_of_range(config)).cast("long").alias("out_n"),
        F.avg("value").alias("mean"),
        F.stddev("value").alias("stddev"),
        F.count("value").alias("value_n"),
    )


def _fmt(x: Column, digits: int) -> Column:
    return F.format_number(x, digits)


def quality_checks(df: DataFrame, config: LakeConfig = DEFAULT_CONFIG) -> DataFrame:
    """DQ2-4 (+ the empty-dataset row) from one grouped scan of ``df``."""
    stats = type_stats(df, config)
    configured = list(config.sensor_limits.keys())
    null_thr = _per_type(config, lambda l: F.lit(float(l.null_threshold)))
    has_range = _per_type(
        config, lambda l: F.lit(l.min_value is not None and l.max_value is not None)
    )
    rng_min = _per_type(config, lambda l: F.lit(l.min_value).cast("double"))
    rng_max = _per_type(config, lambda l: F.lit(l.max_value).cast("double"))

    null_rate = F.col("null_n") / F.col("n")
    in_range = F.lit(1.0) - F.col("out_n") / F.col("n")
    sd = F.coalesce(F.col("stddev"), F.lit(0.0))
    # D11: divide by |mean| so a negative mean cannot hide a wide spread.
    cv = F.when(F.col("mean") != 0, sd / F.abs(F.col("mean")) * 100).otherwise(F.lit(0.0))

    t = F.col("sensor_type")
    null_row = F.struct(
        F.concat(F.lit("null_check_"), t).alias("check_name"),
        F.lit("null").alias("check_type"),
        t.alias("sensor_type"),
        (null_rate <= null_thr).alias("success"),
        F.round(null_rate, 4).alias("observed_value"),
        F.concat(
            t, F.lit(": null rate "), _fmt(null_rate * 100, 2), F.lit("% (threshold: "),
            _fmt(null_thr * 100, 2), F.lit("%)"),
        ).alias("details"),
    )
    range_row = F.when(
        has_range,
        F.struct(
            F.concat(F.lit("range_check_"), t).alias("check_name"),
            F.lit("range").alias("check_type"),
            t.alias("sensor_type"),
            (in_range >= config.in_range_pass_rate).alias("success"),
            F.round(in_range, 4).alias("observed_value"),
            F.concat(
                t, F.lit(": "), _fmt(in_range * 100, 2), F.lit("% within ["),
                rng_min.cast("string"), F.lit(", "), rng_max.cast("string"), F.lit("], "),
                F.col("out_n").cast("string"), F.lit(" out of range"),
            ).alias("details"),
        ),
    )
    stat_row = F.when(
        F.col("value_n") > 0,
        F.struct(
            F.concat(F.lit("statistical_check_"), t).alias("check_name"),
            F.lit("statistical").alias("check_type"),
            t.alias("sensor_type"),
            (cv < config.max_cv_percent).alias("success"),
            F.round(cv, 2).alias("observed_value"),
            F.concat(
                t, F.lit(": CV="), _fmt(cv, 1), F.lit("%, mean="), _fmt(F.col("mean"), 2),
                F.lit(", stddev="), _fmt(sd, 2), F.lit(", n="), F.col("value_n").cast("string"),
            ).alias("details"),
        ),
    )
    # One global aggregate over the per-type table gives every check row, and
    # also the single ``non_empty_dataset`` failure when there was no input
    # at all (a global aggregate always yields a row). The collected list is
    # bounded by the configured sensor types; the input is scanned once.
    is_configured = F.col("sensor_type").isin(*configured)
    empty_row = F.struct(
        F.lit("non_empty_dataset").alias("check_name"),
        F.lit("dataset").alias("check_type"),
        F.lit(None).cast("string").alias("sensor_type"),
        F.lit(False).alias("success"),
        F.lit(0.0).alias("observed_value"),
        F.lit("Dataset is empty").alias("details"),
    )
    rolled = stats.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.flatten(
            F.collect_list(F.when(is_configured, F.array(null_row, range_row, stat_row)))
        ).alias("checks"),
    )
    return (
        rolled.select(
            F.explode(
                F.when(F.col("total") == 0, F.array(empty_row)).otherwise(F.col("checks"))
            ).alias("r")
        )
        .filter(F.col("r").isNotNull())
        .select("r.*")
    )


def run_suite(
    df: DataFrame, config: LakeConfig = DEFAULT_CONFIG, suite_name: str = "iot_quality_suite"
) -> DataFrame:
    """DQ5: schema checks + data checks, tagged with the suite name."""
    checks = schema_checks(df.sparkSession, df).unionByName(quality_checks(df, config))
    return checks.withColumn("suite_name", F.lit(suite_name))


def suite_summary(checks: DataFrame) -> DataFrame:
    """DQ5 roll-up: overall success, success rate (1.0 when empty), counts."""
    return checks.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("success")).alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("overall_success"),
        F.coalesce(F.avg(F.col("success").cast("double")), F.lit(1.0)).alias("success_rate"),
    )
