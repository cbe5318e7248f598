"""Structured Streaming jobs (STR1-4, SNK1).

* STR1/SNK1: records -> parse -> validate -> bronze. Each micro-batch is written
  to its own folder beside the batch loads of the same table, so a restart
  (STR2) repeats a batch without doubling it and a reader sees both parts.
* STR3: two forms. :func:`dedup_stream` passes the first copy that a micro-batch
  sees on at once (``dropDuplicatesWithinWatermark``). :func:`first_copy_stream` decides as
  WIN1 does, by order of arrival, and passes an event on when the watermark says that no
  copy of it can count any more. State is bounded by the watermark in both.
* STR4: z-free KPIs over a watermarked stream in append mode: a window is
  emitted once the watermark passes its end and never changes afterwards. Chained
  behind :func:`first_copy_stream` in one query, re-sent records count once; Spark hands
  the watermark from one stateful operator to the next.
* FIL2: :func:`start_quarantine_sink` feeds valid rows to bronze and rejected ones,
  with reasons and payload, to a quarantine table, from one parse of each micro-batch.

The record source is injected: production passes the Kafka source
(:func:`sluice.sources.kafka.read_kafka_stream`); tests and the bench pass
:func:`file_record_stream`, which serves the driver's ``events`` table in the
same record shape.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluice.config import DEFAULT_CONFIG, LakeConfig
from sluice.operators.aggregate import stream_kpis
from sluice.operators.clean import clean
from sluice.operators.ingest import parse_records, to_bronze, validate_events, with_violations
from sluice.schema import BRONZE_SCHEMA, EVENT_SCHEMA
from sluice.session import delete_path, scratch_path
from sluice.sources.fixtures import sensor_events
from sluice.sources.kafka import to_kafka_records
from sluice.sources.tables import read_table, stream_part, write_partitioned

QUARANTINE_COLUMNS = (*EVENT_SCHEMA.fieldNames(), "kafka_timestamp", "kafka_partition", "kafka_offset")

EVENTS_SOURCE_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING"
)


def file_record_stream(
    spark: SparkSession,
    sf_dir: str,
    table: str = "events",
    with_resends: bool = True,
    max_files_per_trigger: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Kafka-shaped records (key, value, timestamp, partition, offset) from a Parquet table.

    ``timestamp`` plays the broker append time (the event's arrival time),
    ``offset`` the position in the partition. A topic is read by as many tasks
    as it has partitions; a single Parquet file is a couple of splits, so the
    events are spread round-robin over ``partitions`` (default: the session's
    parallelism) to give the stand-in the same parallelism.
    """
    reader = spark.readStream.schema(EVENTS_SOURCE_SCHEMA).option(
        "pathGlobFilter", f"{table}.parquet"
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    n = partitions or spark.sparkContext.defaultParallelism
    events = reader.parquet(sf_dir).repartition(n)
    raw = sensor_events(events, with_resends=with_resends).withColumn(
        "_offset", F.col("event_id").cast("long")
    )
    return to_kafka_records(raw, passthrough=("ingestion_timestamp", "_offset")).select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.col("ingestion_timestamp").alias("timestamp"),
        F.spark_partition_id().alias("partition"),
        F.col("_offset").alias("offset"),
    )


RECORD_SCHEMA = "key BINARY, value BINARY, timestamp TIMESTAMP, partition INT, offset BIGINT"

#: Bytes of a row group in files that a later job reads. Readers divide a file between its
#: row groups only, and by Parquet's default (128 MB) all that one task wrote is often one.
ROW_GROUP_BYTES = 8 * 1024 * 1024


def write_divisible(df: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """Write files that readers can divide, however much of them one task writes: row
    groups of :data:`ROW_GROUP_BYTES`, or of the session's ``parquet.block.size`` if that
    is less."""
    spark, key = df.sparkSession, "parquet.block.size"
    own = spark.conf.get(key, None) or spark.sparkContext._jsc.hadoopConfiguration().get(key)
    size = min(ROW_GROUP_BYTES, int(own)) if own else ROW_GROUP_BYTES
    df.write.mode(mode).option(key, str(size)).parquet(folder)


def write_arrivals(records: DataFrame, folder: str, since: str | None, until: str | None) -> None:
    """Append the Kafka-shaped records that arrive in a span of time to a folder: a
    stand-in for a topic that a stream follows."""
    if since is not None:
        records = records.filter(F.col("timestamp") >= F.lit(since).cast("timestamp"))
    if until is not None:
        records = records.filter(F.col("timestamp") < F.lit(until).cast("timestamp"))
    write_divisible(records, folder, "append")


def arrival_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The records of :func:`write_arrivals`. A run with ``availableNow`` takes all that
    came since the last one as one micro-batch."""
    return spark.readStream.schema(RECORD_SCHEMA).parquet(folder)


def bronze_stream(records: DataFrame) -> DataFrame:
    """STR1 transformation: PRJ1/PRJ2 parse, FIL1 validate, PRJ3-4 stamp (stream path)."""
    return to_bronze(
        validate_events(parse_records(records)),
        ingestion_ts=F.current_timestamp(),
        source=None,
        pipeline_version=None,
    )


def write_stream_batch(
    batch: DataFrame, output_path: str, source_id: str, batch_id: int, config: LakeConfig = DEFAULT_CONFIG
) -> None:
    """SNK1, one micro-batch: its own folder of the bronze table's stream part.

    The folder is named by the stream and the batch, and written with overwrite: a
    batch that is run again after a failure replaces its own rows and no others.
    It is an ordinary batch write, so the rebalance hint lets adaptive execution
    split a folder that holds most of the batch (live data is one day).
    """
    path = f"{stream_part(output_path)}/batch={source_id}-{batch_id}"
    write_partitioned(batch, path, config.bronze_partitions, "overwrite", name="stream_bronze")


def start_bronze_sink(
    df: DataFrame,
    output_path: str,
    checkpoint_dir: str,
    config: LakeConfig = DEFAULT_CONFIG,
    processing_time: str | None = "30 seconds",
    available_now: bool = False,
    query_name: str | None = None,
) -> StreamingQuery:
    """SNK1: append micro-batches to the stream part of a bronze table; returns the
    running query. The checkpoint folder identifies the stream, so several streams
    and any number of batch loads can feed one table."""
    return _start_sink(
        df, write_stream_batch, output_path, checkpoint_dir, config, processing_time, available_now, query_name
    )


def _start_sink(
    df, write, output_path, checkpoint_dir, config, processing_time, available_now, query_name=None
) -> StreamingQuery:
    source_id = hashlib.sha256(checkpoint_dir.rstrip("/").encode()).hexdigest()[:12]
    writer = df.writeStream.option("checkpointLocation", checkpoint_dir).foreachBatch(
        lambda batch, batch_id: write(batch, output_path, source_id, batch_id, config)
    )
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_bronze_ingest(
    records: DataFrame,
    output_path: str,
    checkpoint_dir: str,
    config: LakeConfig = DEFAULT_CONFIG,
    available_now: bool = True,
    metric: str | None = None,
) -> StreamingQuery:
    """PIPE4 / STR1: the stream ingest job; with ``available_now`` it drains and stops.

    ``metric`` names an observed row count of what is written, which listeners see
    (:class:`sluice.streaming.lineage.StreamLineage`).
    """
    rows = bronze_stream(records)
    if metric:
        rows = rows.observe(metric, F.count(F.lit(1)).alias("n"))
    query = start_bronze_sink(rows, output_path, checkpoint_dir, config, available_now=available_now)
    if available_now:
        query.awaitTermination()
    return query


def dedup_stream(
    df: DataFrame, config: LakeConfig = DEFAULT_CONFIG, key: str = "event_id"
) -> DataFrame:
    """STR3: drop re-deliveries of an event id within the dedup window (event time)."""
    return df.withWatermark("timestamp", f"{config.dedup_window_hours} hours").dropDuplicatesWithinWatermark(
        [key]
    )


#: Arrival order of copies: broker time, then source position, then value.
ARRIVAL_ORDER = ("kafka_timestamp", "kafka_partition", "kafka_offset", "value")


def first_copy_stream(df: DataFrame, delay: str) -> DataFrame:
    """STR3 with a defined winner: of all copies of an event the first by arrival.

    ``delay`` is how long, in event time, copies may follow; an event is passed on when
    the watermark (latest event time less ``delay``) passes its time. Copies of an event
    carry its id and its time; should an id come with several times, the one passed on
    first counts. Copies that come after the watermark passed them are dropped.
    """
    rest = [c for c in df.columns if c not in ("event_id", "timestamp")]
    order = F.struct(*[F.col(c) for c in ARRIVAL_ORDER if c in df.columns])
    firsts = (
        df.withWatermark("timestamp", delay)
        .groupBy("event_id", "timestamp")
        .agg(F.min_by(F.struct(*rest), order).alias("_first"))
        .select("event_id", "timestamp", *[F.col(f"_first.{c}").alias(c) for c in rest])
    )
    return firsts.dropDuplicatesWithinWatermark(["event_id"]).select(df.columns)


def kpi_stream(
    df: DataFrame, config: LakeConfig = DEFAULT_CONFIG, delay: str = "1 hour"
) -> DataFrame:
    """STR4: z-free KPIs (8 of 10 measures; z needs a row frame, which streams lack)."""
    return stream_kpis(df.withWatermark("timestamp", delay), config.kpi_window_minutes)


def clean_stream(records: DataFrame, config: LakeConfig = DEFAULT_CONFIG) -> DataFrame:
    """Stream-side silver cleaning: parse, validate, defaults/trim (all narrow)."""
    return clean(validate_events(parse_records(records)), config.sensor_types)


def deduped_kpi_stream(
    records: DataFrame, config: LakeConfig = DEFAULT_CONFIG, delay: str = "2 hours"
) -> DataFrame:
    """STR3 feeding STR4: KPIs of closed windows over events that may be re-sent. The
    one watermark, ``delay`` behind the latest event, closes both."""
    firsts = first_copy_stream(validate_events(parse_records(records)), delay)
    return stream_kpis(clean(firsts, config.sensor_types), config.kpi_window_minutes)


def quarantine_part(path: str) -> str:
    """Folder of the rejected rows of a bronze table's streams."""
    return f"{path.rstrip('/')}_quarantine"


RAW_COLUMN = "raw_value"


def write_contract_batch(
    batch: DataFrame, output_path: str, source_id: str, batch_id: int, config: LakeConfig = DEFAULT_CONFIG
) -> None:
    """FIL2, one micro-batch of parsed rows: rejected ones to the quarantine table, then
    valid ones to bronze, each to a folder of this batch that running it again replaces.

    The rows are parsed once and staged as files, which both sinks read in splits of bounded
    size: blocks kept in memory would be as large as the files or topic partitions that the
    source's tasks read. Only rejected rows keep their payload.
    """
    spark = batch.sparkSession
    ok = F.size("violations") == 0
    parsed = with_violations(batch, config.sensor_types).withColumn(RAW_COLUMN, F.when(~ok, F.col(RAW_COLUMN)))
    staged = scratch_path(spark, "contract-batch")
    try:
        write_divisible(parsed, staged)
        tagged = spark.read.schema(parsed.schema).parquet(staged)
        rejected = tagged.filter(~ok).withColumn("rejected_at", F.current_timestamp())
        folder = f"batch={source_id}-{batch_id}"
        write_partitioned(
            rejected, f"{quarantine_part(output_path)}/{folder}", (), "overwrite", name="quarantine"
        )
        valid = to_bronze(
            tagged.filter(ok).drop("violations", RAW_COLUMN), F.current_timestamp(), None, None
        )
        write_stream_batch(valid, output_path, source_id, batch_id, config)
    finally:
        delete_path(spark, staged)


def start_quarantine_sink(
    records: DataFrame,
    output_path: str,
    checkpoint_dir: str,
    config: LakeConfig = DEFAULT_CONFIG,
    processing_time: str | None = "30 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    """FIL2 in STR1: every record ends up in bronze or, with reasons, in quarantine."""
    parsed = parse_records(records, raw=RAW_COLUMN)
    return _start_sink(
        parsed, write_contract_batch, output_path, checkpoint_dir, config, processing_time, available_now
    )


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Rejected rows of a bronze table: event columns, payload and ``violations``."""
    fields = [f for f in BRONZE_SCHEMA.fields if f.name in QUARANTINE_COLUMNS]
    schema = T.StructType(
        [
            *fields,
            T.StructField(RAW_COLUMN, T.StringType()),
            T.StructField("violations", T.ArrayType(T.StringType())),
            T.StructField("rejected_at", T.TimestampType()),
        ]
    )
    return read_table(spark, quarantine_part(path), schema).select(schema.fieldNames())


def drain_to_parquet(
    df: DataFrame, output_path: str, checkpoint_dir: str, partitions: tuple[str, ...] = ()
) -> None:
    """Run a streaming DataFrame to completion (availableNow) into Parquet files."""
    writer = (
        df.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_dir)
        .option("path", output_path)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.start().awaitTermination()
