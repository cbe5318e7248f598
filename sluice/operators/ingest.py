"""Ingest-side operators: parse, validate, stamp (PRJ1-5, FIL1, FIL2).

All are narrow projections/filters: no shuffle, valid on streaming and batch
DataFrames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluice.config import (
    PIPELINE_VERSION,
    REQUIRED_COLUMNS,
    SENSOR_TYPES,
    SOURCE_LITERAL,
)
from sluice.operators.clean import DEFAULT_RULES, project
from sluice.schema import BRONZE_SCHEMA, EVENT_SCHEMA, conform


# The event time travels as text and is cast after parsing: ISO-8601 with a
# 'T' or a space, any fraction up to microseconds, optional zone; bad text is
# null (then rejected by validation) instead of taking the JSON parser's
# exception-driven fallback for every row.
EVENT_WIRE_SCHEMA = StructType(
    [
        StructField(f.name, StringType(), True) if f.name == "timestamp" else f
        for f in EVENT_SCHEMA.fields
    ]
)


#: Numbers from here on are epoch milliseconds (as seconds they lie beyond the year 5138).
MILLISECONDS_FROM = 100_000_000_000
#: Seconds of the years 1 to 9999, what a timestamp can hold.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def event_time(text: Column) -> Column:
    """Event time from wire text; null (then rejected by validation) for all that is none.

    A number of five digits or more is seconds since the epoch, with any fraction, or
    milliseconds if its size says so; numbers outside the years 1 to 9999 are null.
    All else is read as a timestamp; bad text is null.
    """
    number = text.try_cast("decimal(38,6)")
    seconds = F.when(F.abs(number) >= MILLISECONDS_FROM, number / 1000).otherwise(number)
    micros = (seconds * 1_000_000).try_cast("long")
    in_range = seconds.between(F.lit(FIRST_SECOND), F.lit(LAST_SECOND))
    return F.when(
        # The JSON reader hands large numbers over in scientific notation.
        text.rlike(r"^-?([0-9]{5,}(\.[0-9]+)?|[0-9]+(\.[0-9]+)?[eE][+-]?[0-9]+)$"),
        F.when(in_range, F.timestamp_micros(micros)),
    ).otherwise(text.try_cast("timestamp"))


def parse_records(records: DataFrame, raw: str | None = None) -> DataFrame:
    """PRJ1 + PRJ2: Kafka-shaped records -> event columns + source position.

    ``raw`` names a column that keeps the payload as it came.

    ``records`` has a binary or string ``value`` and the Kafka source columns
    ``timestamp``, ``partition``, ``offset``. Malformed JSON yields an all-null
    event (PERMISSIVE), removed later by :func:`validate_events`.
    """
    cols = set(records.columns)

    def opt(name: str, alias: str, dtype: str) -> Column:
        return (F.col(name) if name in cols else F.lit(None)).cast(dtype).alias(alias)

    # Emitted through a one-element ``inline``: predicates on the parsed
    # fields (validation, cleaning) cannot be pushed below a generator, so each
    # record is parsed once instead of once per predicate.
    parsed = records.select(
        F.inline(
            F.array(
                F.struct(
                    F.from_json(F.col("value").cast("string"), EVENT_WIRE_SCHEMA).alias("data"),
                    opt("timestamp", "kafka_timestamp", "timestamp"),
                    opt("partition", "kafka_partition", "int"),
                    opt("offset", "kafka_offset", "bigint"),
                    *([F.col("value").cast("string").alias(raw)] if raw else []),
                )
            )
        )
    )
    return parsed.select(
        *[
            event_time(F.col(f"data.{f.name}")).alias(f.name)
            if f.name == "timestamp"
            else F.col(f"data.{f.name}")
            for f in EVENT_SCHEMA.fields
        ],
        "kafka_timestamp",
        "kafka_partition",
        "kafka_offset",
        *([raw] if raw else []),
    )


def to_bronze(
    df: DataFrame,
    ingestion_ts: Column | None = None,
    source: str | None = SOURCE_LITERAL,
    pipeline_version: str | None = PIPELINE_VERSION,
) -> DataFrame:
    """PRJ3-5: stamp event_date, ingestion time and provenance; bronze schema.

    ``ingestion_ts`` defaults to an existing ``ingestion_timestamp`` column,
    else ``current_timestamp()``. The stream path passes ``source=None``.
    """
    if ingestion_ts is None:
        ingestion_ts = (
            F.col("ingestion_timestamp")
            if "ingestion_timestamp" in df.columns
            else F.current_timestamp()
        )
    stamped = (
        df.withColumn("ingestion_timestamp", ingestion_ts)
        .withColumn("event_date", F.to_date("timestamp"))
        .withColumn("source", F.lit(source).cast("string"))
        .withColumn("pipeline_version", F.lit(pipeline_version).cast("string"))
    )
    return conform(stamped, BRONZE_SCHEMA)


def valid_event_predicate(sensor_types: tuple[str, ...] = SENSOR_TYPES) -> Column:
    """FIL1 predicate: key fields present and a known sensor type."""
    return (
        F.col("event_id").isNotNull()
        & F.col("sensor_id").isNotNull()
        & F.col("timestamp").isNotNull()
        & F.col("value").isNotNull()
        & F.col("sensor_type").isin(*sensor_types)
    )


def validate_events(df: DataFrame, sensor_types: tuple[str, ...] = SENSOR_TYPES) -> DataFrame:
    """FIL1: stream/batch validation filter (one combined predicate)."""
    return df.filter(valid_event_predicate(sensor_types))


def contract_violations(df: DataFrame, sensor_types: tuple[str, ...] = SENSOR_TYPES) -> Column:
    """FIL2 rule list as one ``array<string>`` column (empty = valid).

    Rules: each required field present, sensor_type in the enum, quality_score
    within [0, 1] when present. Missing optional fields are not violations
    (they get their defaults in silver).
    """
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing_{c}")) for c in REQUIRED_COLUMNS]
    checks.append(
        F.when(
            F.col("sensor_type").isNotNull() & ~F.col("sensor_type").isin(*sensor_types),
            F.lit("invalid_sensor_type"),
        )
    )
    checks.append(
        F.when(
            F.col("quality_score").isNotNull()
            & ((F.col("quality_score") < 0.0) | (F.col("quality_score") > 1.0)),
            F.lit("quality_score_out_of_range"),
        )
    )
    return F.array_compact(F.array(*checks))


def with_violations(df: DataFrame, sensor_types: tuple[str, ...] = SENSOR_TYPES) -> DataFrame:
    """FIL2: add ``violations array<string>``."""
    return df.withColumn("violations", contract_violations(df, sensor_types))


def split_contract(
    df: DataFrame, sensor_types: tuple[str, ...] = SENSOR_TYPES
) -> tuple[DataFrame, DataFrame]:
    """FIL2: (valid rows with defaults applied, quarantined rows with reasons)."""
    tagged = with_violations(df, sensor_types)
    ok = F.size("violations") == 0
    valid = (
        tagged.filter(ok)
        .drop("violations")
    )
    return project(valid, DEFAULT_RULES), tagged.filter(~ok)


def violation_counts(df: DataFrame, sensor_types: tuple[str, ...] = SENSOR_TYPES) -> DataFrame:
    """FIL2 summary: rows per violated rule (plus ``valid``), one grouped pass.

    ``explode_outer`` keeps valid rows as a null rule, counted as ``valid``.
    Partial aggregation before the shuffle keeps this a tiny exchange.
    """
    tagged = with_violations(df, sensor_types)
    return (
        tagged.select(F.explode_outer("violations").alias("rule"))
        .select(F.coalesce("rule", F.lit("valid")).alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
