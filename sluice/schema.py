"""Fixed schemas of every layer.

Schemas are declared, never inferred: partition-column inference would turn a
facility called "001" into the integer 1, and an empty overwrite would leave a
table without a readable schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

EVENT_SCHEMA = StructType(
    [
        StructField("event_id", StringType(), False),
        StructField("sensor_id", StringType(), False),
        StructField("sensor_type", StringType(), False),
        StructField("facility_id", StringType(), False),
        StructField("timestamp", TimestampType(), False),
        StructField("value", DoubleType(), False),
        StructField("unit", StringType(), False),
        StructField("quality_score", DoubleType(), True),
        StructField("is_anomaly", BooleanType(), True),
        StructField("metadata", MapType(StringType(), StringType()), True),
    ]
)

# Columns added on the way into bronze. Both the stream and the batch path
# write this one schema; columns a path does not know are typed nulls.
BRONZE_EXTRA = StructType(
    [
        StructField("kafka_timestamp", TimestampType(), True),
        StructField("kafka_partition", IntegerType(), True),
        StructField("kafka_offset", LongType(), True),
        StructField("ingestion_timestamp", TimestampType(), True),
        StructField("source", StringType(), True),
        StructField("pipeline_version", StringType(), True),
        StructField("event_date", DateType(), True),
    ]
)

def nullable(schema: StructType) -> StructType:
    """Same fields, all nullable: stored layers hold whatever arrived; filters enforce."""
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])


BRONZE_SCHEMA = nullable(StructType(list(EVENT_SCHEMA.fields) + list(BRONZE_EXTRA.fields)))

SILVER_EXTRA = StructType(
    [
        StructField("rolling_mean", DoubleType(), True),
        StructField("rolling_stddev", DoubleType(), True),
        StructField("z_score", DoubleType(), True),
        StructField("hour_of_day", IntegerType(), True),
        StructField("day_of_week", IntegerType(), True),
        StructField("is_business_hours", BooleanType(), True),
    ]
)

SILVER_SCHEMA = StructType(list(BRONZE_SCHEMA.fields) + list(SILVER_EXTRA.fields))

KPI_SCHEMA = StructType(
    [
        StructField("facility_id", StringType(), True),
        StructField("sensor_type", StringType(), True),
        StructField("event_count", LongType(), True),
        StructField("avg_value", DoubleType(), True),
        StructField("min_value", DoubleType(), True),
        StructField("max_value", DoubleType(), True),
        StructField("stddev_value", DoubleType(), True),
        StructField("anomaly_count", LongType(), True),
        StructField("anomaly_rate", DoubleType(), True),
        StructField("avg_quality_score", DoubleType(), True),
        StructField("avg_z_score", DoubleType(), True),
        StructField("max_abs_z_score", DoubleType(), True),
        StructField("window_start", TimestampType(), True),
        StructField("window_end", TimestampType(), True),
        StructField("kpi_date", DateType(), True),
        StructField("computed_at", TimestampType(), True),
    ]
)

SEVERITY_SCHEMA = StructType(
    [
        StructField("facility_id", StringType(), True),
        StructField("score_date", DateType(), True),
        StructField("avg_abs_z_score", DoubleType(), True),
        StructField("anomaly_rate", DoubleType(), True),
        StructField("avg_quality", DoubleType(), True),
        StructField("total_events", LongType(), True),
        StructField("total_anomalies", LongType(), True),
        StructField("anomaly_severity", DoubleType(), True),
        StructField("severity_level", StringType(), True),
        StructField("computed_at", TimestampType(), True),
    ]
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: same order, casts, typed nulls for absent columns.

    Extra columns are dropped. A narrow projection; no shuffle.
    """
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in present:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)
