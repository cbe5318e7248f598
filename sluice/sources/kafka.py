"""Kafka source and sink (SRC1, SNK6) as plain Spark reads and writes.

The Kafka connector jar is deployment configuration; these functions only build
the reader/writer. Everything downstream takes the raw record DataFrame as an
argument, so tests feed the same shape from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# JSON timestamps keep microseconds (the default pattern truncates to ms).
MICROS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
JSON_OPTIONS = {"timestampFormat": MICROS_FORMAT}

PUBLISHED_COLUMNS = (
    "event_id",
    "sensor_id",
    "sensor_type",
    "facility_id",
    "timestamp",
    "value",
    "unit",
    "quality_score",
    "is_anomaly",
    "metadata",
)


# The connector options of the reader and the writer.
SOURCE_OPTIONS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}
SINK_OPTIONS = {"kafka.compression.type": "gzip", "kafka.acks": "all", "kafka.retries": "3"}


def source_options(bootstrap_servers: str, topic: str, extra: dict[str, str] | None = None) -> dict[str, str]:
    """SRC1: one topic from its earliest offset, tolerating lost data; ``extra`` wins."""
    named = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic}
    return {**named, **SOURCE_OPTIONS, **(extra or {})}


def sink_options(bootstrap_servers: str, topic: str, extra: dict[str, str] | None = None) -> dict[str, str]:
    """SNK6: compressed, acknowledged by all replicas, retried; ``extra`` wins."""
    named = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    return {**named, **SINK_OPTIONS, **(extra or {})}


def read_kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    extra_options: dict[str, str] | None = None,
) -> DataFrame:
    """SRC1: the record stream of one topic."""
    extra = {"startingOffsets": starting_offsets, **(extra_options or {})}
    return spark.readStream.format("kafka").options(**source_options(bootstrap_servers, topic, extra)).load()


def to_kafka_records(
    df: DataFrame,
    columns: tuple[str, ...] = PUBLISHED_COLUMNS,
    passthrough: tuple[str, ...] = (),
) -> DataFrame:
    """SNK6: one Kafka record per event; key = sensor_id or 'unknown', value = JSON.

    Absent columns are skipped; the payload keeps microsecond timestamps.
    ``passthrough`` columns are kept next to key and value.
    """
    present = [c for c in columns if c in df.columns]
    return df.select(
        F.coalesce(F.col("sensor_id").cast("string"), F.lit("unknown")).alias("key"),
        F.to_json(F.struct(*present), JSON_OPTIONS).alias("value"),
        *passthrough,
    )


def write_kafka(
    df: DataFrame,
    bootstrap_servers: str,
    topic: str,
    extra_options: dict[str, str] | None = None,
) -> None:
    """SNK6 batch publish; Spark parallelises per partition."""
    options = sink_options(bootstrap_servers, topic, extra_options)
    to_kafka_records(df).write.format("kafka").options(**options).save()
