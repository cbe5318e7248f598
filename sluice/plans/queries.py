"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They read the driver's tables (``events``, ``lineitem``) through the fixture
adapter, so their work grows with the scale factor. Computed doubles are
rounded to 6 digits for the oracle comparison (the library functions
themselves return full precision).
"""

from __future__ import annotations

import datetime as dt
import functools
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.config import DEFAULT_CONFIG
from sluice.operators.aggregate import (
    aggregate_kpis,
    anomaly_scores,
    kpis_from_base,
    severity_from_base,
    window_base,
)
from sluice.operators.clean import clean
from sluice.operators.day_profile import (
    DISTINCT_ERROR,
    RANK_ERROR,
    merged_profile,
    read_sketches,
    update_days,
)
from sluice.operators.dedup import dedup_first
from sluice.operators.enrich import enrich, time_features
from sluice.operators.ingest import (
    parse_records,
    split_contract,
    validate_events,
    violation_counts,
)
from sluice.operators.profile import profile, report_flags
from sluice.operators.quality import run_suite, suite_summary
from sluice.sources.fixtures import fixture_events, load_table
from sluice.operators.governance import (
    LineageLog,
    append_sla_history,
    as_sla_rows,
    completeness,
    freshness,
    layer_counts,
    lineage_runs,
    lineage_steps,
    read_sla_history,
    recent_checks,
    sla_alerts,
    sla_dashboard,
)
from sluice.plans.gold import process_gold_incremental
from sluice.plans.medallion import ingest_bronze, process_gold, process_silver
from sluice.session import scratch_path, stage_table
from sluice.sources.kafka import to_kafka_records
from sluice.streaming.folding import fold_closed_days
from sluice.streaming.lineage import StreamLineage
from sluice.streaming.jobs import (
    arrival_stream,
    clean_stream,
    dedup_stream,
    deduped_kpi_stream,
    drain_to_parquet,
    file_record_stream,
    first_copy_stream,
    kpi_stream,
    read_quarantine,
    run_bronze_ingest,
    start_quarantine_sink,
    write_arrivals,
)
from sluice.sources.tables import (
    LakePaths,
    bronze_stats,
    expired_partitions,
    gold_facilities,
    gold_stats,
    read_bronze,
    read_kpis,
    read_severity,
    read_silver,
    silver_stats,
)

QueryFn = Callable[[SparkSession, str], DataFrame]


#: Computed doubles of a KPI row.
KPI_DOUBLES = (
    "avg_value", "stddev_value", "anomaly_rate", "avg_quality_score", "avg_z_score", "max_abs_z_score"
)


def r6(*cols: str) -> dict:
    """Tie-stable 6-digit rounding (same rule as the oracle SQL)."""
    return {c: F.round(F.col(c) + F.lit(1e-9), 6) for c in cols}


def silver_frame(spark: SparkSession, sf_dir: str, strategy: str = "chunked") -> DataFrame:
    """Bronze fixture -> dedup -> clean -> enrich (the silver rows, not written)."""
    return enrich(clean(dedup_first(fixture_events(spark, sf_dir))), DEFAULT_CONFIG, strategy)


def plain_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows without the rolling step: all that its time and quality columns need."""
    return time_features(clean(dedup_first(fixture_events(spark, sf_dir))))


def q_severity_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: AGG2 + PRJ15/16 over the whole silver chain."""
    sev = anomaly_scores(silver_frame(spark, sf_dir), computed_at=False)
    return sev.withColumns(
        r6("avg_abs_z_score", "anomaly_rate", "avg_quality", "anomaly_severity")
    )


def q_kpi_15min(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpis = aggregate_kpis(silver_frame(spark, sf_dir), computed_at=False)
    return kpis.withColumns(r6(*KPI_DOUBLES))


def q_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_first(fixture_events(spark, sf_dir)).select(
        "event_id", "sensor_id", "facility_id", "timestamp", "value", "ingestion_timestamp"
    )


def q_clean_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(dedup_first(fixture_events(spark, sf_dir))).select(
        "event_id", "sensor_id", "sensor_type", "facility_id", "value", "quality_score", "is_anomaly"
    )


def q_clean_text_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ7: values that arrive as text; what is no number is dropped, never an error."""
    number = F.col("event_id").cast("long")
    text = (
        F.when(number % 17 == 0, F.lit("n/a"))
        .when(number % 19 == 0, F.lit("12,5"))
        .when(number % 23 == 0, F.lit(""))
        .when(number % 29 == 0, F.concat(F.lit(" "), F.col("value").cast("string")))
        .otherwise(F.col("value").cast("string"))
    )
    events = fixture_events(spark, sf_dir, with_resends=False).withColumn("value", text)
    return clean(events).select("event_id", "sensor_type", "facility_id", "value")


def q_time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_silver(spark, sf_dir).select(
        "event_id", "event_date", "hour_of_day", "day_of_week", "is_business_hours"
    )


def q_rolling_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        silver_frame(spark, sf_dir)
        .select("event_id", "sensor_id", "sensor_type", "rolling_mean", "rolling_stddev", "z_score")
        .withColumns(r6("rolling_mean", "rolling_stddev", "z_score"))
    )


def q_stream_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_events(fixture_events(spark, sf_dir)).select(
        "event_id", "sensor_id", "sensor_type", "facility_id", "timestamp", "value", "event_date"
    )


def q_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violation_counts(fixture_events(spark, sf_dir))


def q_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK6 then PRJ1: publish-shaped records parse back to the same events."""
    events = fixture_events(spark, sf_dir)
    # Event times as numbers too: epoch seconds, milliseconds, fractions, and numbers
    # that are no time at all.
    number = F.col("event_id").cast("long")
    micros = F.unix_micros("timestamp")
    wire = (
        F.when(number % 7 == 0, F.unix_seconds("timestamp").cast("string"))
        .when(number % 11 == 1, F.unix_millis("timestamp").cast("string"))
        .when(number % 13 == 2, F.lit("1.7E17"))
        .when(number % 13 == 3, F.lit("-99999999999999999999"))
        .when(number % 17 == 4, (micros.cast("decimal(20,0)") / 1_000_000).cast("decimal(20,6)").cast("string"))
    )
    records = to_kafka_records(events, passthrough=("event_id", "timestamp")).withColumn(
        "value",
        F.when(
            wire.isNotNull(),
            F.regexp_replace(
                "value", F.lit('"timestamp":"[^"]*"'), F.concat(F.lit('"timestamp":'), wire)
            ),
        ).otherwise(F.col("value")),
    ).select("key", "value")
    parsed = parse_records(records.withColumn("value", F.col("value").cast("binary")))
    return parsed.select(
        F.coalesce("sensor_id", F.lit("unknown")).alias("key"),
        "event_id",
        "sensor_id",
        "sensor_type",
        "facility_id",
        "timestamp",
        "value",
        "unit",
        "quality_score",
        "is_anomaly",
        F.col("metadata").getItem("k").alias("meta_k"),
    )


QUERIES: dict[str, QueryFn] = {
    "severity_daily": q_severity_daily,
    "kpi_15min": q_kpi_15min,
    "dedup_first": q_dedup_first,
    "clean_defaults": q_clean_defaults,
    "clean_text_values": q_clean_text_values,
    "time_features": q_time_features,
    "rolling_zscore": q_rolling_zscore,
    "stream_validate": q_stream_validate,
    "contract_violations": q_contract_violations,
    "json_roundtrip": q_json_roundtrip,
}


# ---------------------------------------------------------------------------
# Tables, stats and pipelines
# ---------------------------------------------------------------------------

INCREMENTAL_CUT = "2024-01-15 00:00:00"
RANGE_START, RANGE_END, RANGE_TYPE = "2024-01-05", "2024-01-20", "temperature"


def q_bronze_range_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIPE1/SNK2 write, then SRC2 with FIL5/FIL6 pruning on the partition columns."""
    root = LakePaths(scratch_path(spark, "bronze-range"))
    ingest_bronze(fixture_events(spark, sf_dir), root.bronze)
    return read_bronze(spark, root.bronze, RANGE_START, RANGE_END, RANGE_TYPE).select(
        "event_id",
        "sensor_id",
        "sensor_type",
        "facility_id",
        "timestamp",
        "value",
        "ingestion_timestamp",
        "event_date",
        "source",
        "pipeline_version",
    )


def q_bronze_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_stats(fixture_events(spark, sf_dir))


def q_silver_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_stats(plain_silver(spark, sf_dir)).withColumns(
        r6("avg_quality_score", "anomaly_rate")
    )


def q_gold_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Row counts need no z-score; the base is shared by both tables.
    silver = plain_silver(spark, sf_dir).withColumn("z_score", F.lit(0.0))
    minutes = DEFAULT_CONFIG.kpi_window_minutes
    base = stage_table(window_base(silver, minutes), "gold-stats")
    return gold_stats(kpis_from_base(base, minutes), severity_from_base(base))


def q_gold_facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET1: the distinct facilities of the KPI table."""
    silver = plain_silver(spark, sf_dir).withColumn("z_score", F.lit(0.0))
    minutes = DEFAULT_CONFIG.kpi_window_minutes
    return gold_facilities(kpis_from_base(window_base(silver, minutes), minutes))


def q_expired_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expired_partitions(fixture_events(spark, sf_dir), "2024-02-10", 30)


def hard_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze fixture with copies re-sent 30 hours later and, among the rows
    that arrive before the cut, event times that are missing."""
    bronze = fixture_events(spark, sf_dir)
    number = F.col("event_id").cast("long")
    first = fixture_events(spark, sf_dir, with_resends=False).filter(number % 50 == 7)
    late = first.withColumns(
        {
            "value": F.col("value") + 2,
            "ingestion_timestamp": F.col("ingestion_timestamp") + F.expr("INTERVAL 30 HOURS"),
        }
    )
    untimed = (number % 211 == 3) & (
        F.col("ingestion_timestamp") < F.lit(INCREMENTAL_CUT).cast("timestamp")
    )
    return bronze.unionByName(late).withColumns(
        {c: F.when(~untimed, F.col(c)) for c in ("timestamp", "event_date")}
    )


def q_silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bronze batches split by arrival time, two incremental silver runs.

    The final silver table must hold exactly the rows of a full reload, rolling
    columns included: re-sent copies of first-batch events are removed across
    batches however late they come (D4), and frames continue (D5).
    """
    root = LakePaths(scratch_path(spark, "silver-incremental"))
    bronze = hard_bronze(spark, sf_dir)
    cut = F.lit(INCREMENTAL_CUT).cast("timestamp")
    ingest_bronze(bronze.filter(F.col("ingestion_timestamp") < cut), root.bronze)
    process_silver(spark, root.bronze, root.silver)
    ingest_bronze(bronze.filter(F.col("ingestion_timestamp") >= cut), root.bronze)
    process_silver(spark, root.bronze, root.silver)
    return _silver_rows(spark, root)


def _silver_rows(spark: SparkSession, root: LakePaths) -> DataFrame:
    return read_silver(spark, root.silver).select(
        "event_id",
        "sensor_id",
        "sensor_type",
        "facility_id",
        "timestamp",
        "value",
        "quality_score",
        "is_anomaly",
        "ingestion_timestamp",
        "event_date",
        "rolling_mean",
        "rolling_stddev",
        "z_score",
    ).withColumns(r6("rolling_mean", "rolling_stddev", "z_score"))


def q_silver_two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL4, D4, D5 with writers that overlap: three bronze batches whose stamps and event
    times interleave, a silver run behind each. Later batches hold rows that are stamped
    before, or as, rows taken already, first copies of events taken, and readings that
    fall between those of silver; the table is that of a full reload."""
    root = LakePaths(scratch_path(spark, "silver-writers"))
    bronze = hard_bronze(spark, sf_dir)
    late = F.col("event_id").cast("long") % 97 == 5
    cut = F.col("ingestion_timestamp") < F.lit(INCREMENTAL_CUT).cast("timestamp")
    for part in (bronze.filter(~cut & ~late), bronze.filter(cut & ~late), bronze.filter(late)):
        ingest_bronze(part, root.bronze)
        process_silver(spark, root.bronze, root.silver)
    return _silver_rows(spark, root)


def q_gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK4, PIPE3: two bronze batches, each followed by silver and by a gold run that
    merges the windows it touches; the KPI table is that of one full run."""
    root = LakePaths(scratch_path(spark, "gold-incremental"))
    bronze = hard_bronze(spark, sf_dir)
    cut = F.col("ingestion_timestamp") < F.lit(INCREMENTAL_CUT).cast("timestamp")
    for part in (bronze.filter(cut), bronze.filter(~cut)):
        ingest_bronze(part, root.bronze)
        process_silver(spark, root.bronze, root.silver)
        process_gold_incremental(spark, root.silver, root.kpis, root.severity)
    return read_kpis(spark, root.kpis).drop("computed_at").withColumns(r6(*KPI_DOUBLES))


def _gold_tables(spark: SparkSession, sf_dir: str) -> LakePaths:
    """Bronze, silver and gold written by the composite jobs, untimed rows included."""
    root = LakePaths(scratch_path(spark, "gold"))
    ingest_bronze(hard_bronze(spark, sf_dir), root.bronze)
    process_silver(spark, root.bronze, root.silver)
    process_gold(spark, root.silver, root.kpis, root.severity)
    return root


def q_gold_kpis_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIPE3/SNK4, then SRC4 with FIL6 on the partition columns."""
    root = _gold_tables(spark, sf_dir)
    return (
        read_kpis(spark, root.kpis, "PLANT-A", "2024-01-10")
        .drop("computed_at")
        .withColumns(r6(*KPI_DOUBLES))
    )


def q_gold_severity_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIPE3/SNK5, then SRC5 with FIL6; the null day holds the rows without event time."""
    root = _gold_tables(spark, sf_dir)
    return (
        read_severity(spark, root.severity, "PLANT-B")
        .drop("computed_at")
        .withColumns(r6("avg_abs_z_score", "anomaly_rate", "avg_quality", "anomaly_severity"))
    )


def q_bronze_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1 then SNK2 into one bronze table: streamed and batch rows are both read."""
    root = LakePaths(scratch_path(spark, "bronze-mixed"))
    run_bronze_ingest(file_record_stream(spark, sf_dir), root.bronze, f"{root.root}/_ckpt")
    ingest_bronze(fixture_events(spark, sf_dir), root.bronze)
    return read_bronze(spark, root.bronze).select(
        "event_id", "sensor_type", "facility_id", "timestamp", "value", "event_date", "source"
    )


def q_contract_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL2: valid rows with their defaults and quarantined rows with their reasons."""
    valid, bad = split_contract(hard_bronze(spark, sf_dir))
    columns = ("event_id", "sensor_type", "timestamp", "value", "quality_score", "is_anomaly")
    return valid.select(*columns, F.lit("").alias("reasons")).unionByName(
        bad.select(*columns, F.array_join("violations", ",").alias("reasons"))
    )


QUERIES.update(
    {
        "gold_kpis_table": q_gold_kpis_table,
        "gold_severity_table": q_gold_severity_table,
        "bronze_mixed": q_bronze_mixed,
        "contract_quarantine": q_contract_quarantine,
        "bronze_range_read": q_bronze_range_read,
        "bronze_stats": q_bronze_stats,
        "silver_stats": q_silver_stats,
        "gold_stats": q_gold_stats,
        "gold_facilities": q_gold_facilities,
        "expired_partitions": q_expired_partitions,
        "silver_incremental": q_silver_incremental,
        "silver_two_writers": q_silver_two_writers,
        "gold_incremental": q_gold_incremental,
    }
)


# ---------------------------------------------------------------------------
# Quality and profiling
# ---------------------------------------------------------------------------

CHECK_COLUMNS = ("check_name", "check_type", "sensor_type", "success", "observed_value")


def q_quality_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ1-5 over the raw bronze rows (one grouped scan + schema metadata)."""
    return run_suite(fixture_events(spark, sf_dir)).select(*CHECK_COLUMNS)


def q_quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suite_summary(run_suite(fixture_events(spark, sf_dir))).withColumns(
        r6("success_rate")
    )


def q_profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRF1 over the whole lineitem table, exact at any size."""
    return profile(load_table(spark, sf_dir, "lineitem")).withColumns(
        r6("null_rate", "mean", "stddev")
    )


def q_profile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRF2 per-column flags over the profile of the raw bronze rows."""
    return report_flags(profile(fixture_events(spark, sf_dir))).drop("row_count")


PROFILE_DAYS = (dt.date(2024, 1, 5), dt.date(2024, 1, 20))


def q_profile_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRF1 over a span of days from the persisted sketches of single days, one of which
    changed and was sketched again; estimates are held against exact values."""
    path = scratch_path(spark, "day-sketches")
    columns = ("event_id", "sensor_id", "sensor_type", "facility_id", "timestamp", "value",
               "quality_score", "is_anomaly", "event_date")
    events = fixture_events(spark, sf_dir).select(*columns)
    late = F.col("event_date") == F.lit(PROFILE_DAYS[0])
    update_days(events.filter(~(late & (F.col("sensor_id") == "S-3"))), "event_date", path)
    update_days(events, "event_date", path, [PROFILE_DAYS[0]])
    span = F.col("day").between(*[F.lit(d) for d in PROFILE_DAYS])
    merged = stage_table(merged_profile(read_sketches(spark, path).filter(span)), "day-profile")
    rows = events.filter(F.col("event_date").between(*[F.lit(d) for d in PROFILE_DAYS])).drop("event_date")
    exact = profile(rows).select("column_name", F.col("distinct_count").alias("exact"))
    # Ranks of the estimated quantiles among all values, both numeric columns in one pass.
    found = {r["column_name"]: r for r in merged.filter("median is not null").collect()}
    shares = []
    for name, r in found.items():
        for label, fraction in (("p25", 0.25), ("median", 0.5), ("p75", 0.75)):
            below = F.avg((F.col(name) < F.lit(r[label])).cast("double")) <= F.lit(fraction + RANK_ERROR)
            upto = F.avg((F.col(name) <= F.lit(r[label])).cast("double")) >= F.lit(fraction - RANK_ERROR)
            shares.append((name, below & upto))
    ranks = rows.agg(
        *[F.lit(True).alias("_any")],
        *[
            functools.reduce(lambda a, b: a & b, [ok for n, ok in shares if n == name]).alias(name)
            for name in found
        ],
    )
    ranked = ranks.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("quantiles_ok")) for n in found]))
    )
    off = F.abs(F.col("distinct_count") - F.col("exact")) <= F.ceil(F.col("exact") * F.lit(DISTINCT_ERROR))
    return (
        merged.join(exact, "column_name")
        .join(ranked, "column_name", "left")
        .select(
            "column_name", "row_count", "null_count", "min", "max", "mean", "stddev",
            off.alias("distinct_ok"), "quantiles_ok",
        )
        .withColumns(r6("mean", "stddev"))
    )


QUERIES.update(
    {
        "profile_days": q_profile_days,
        "quality_suite": q_quality_suite,
        "quality_summary": q_quality_summary,
        "profile_columns": q_profile_columns,
        "profile_report": q_profile_report,
    }
)


# ---------------------------------------------------------------------------
# Streaming (file-backed record source, availableNow triggers)
# ---------------------------------------------------------------------------

STREAM_KPI_DELAY = "1 hour"


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1/SNK1/PIPE4: records -> parse -> validate -> partitioned bronze with checkpoint."""
    root = scratch_path(spark, "stream-ingest")
    run_bronze_ingest(file_record_stream(spark, sf_dir), f"{root}/bronze", f"{root}/_ckpt")
    return read_bronze(spark, f"{root}/bronze").select(
        "event_id",
        "sensor_id",
        "sensor_type",
        "facility_id",
        "timestamp",
        "value",
        "quality_score",
        "is_anomaly",
        "kafka_timestamp",
        "kafka_offset",
        "event_date",
    )


def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR3: watermark dedup of re-delivered records; one row per event id survives."""
    root = scratch_path(spark, "stream-dedup")
    deduped = dedup_stream(parse_records(file_record_stream(spark, sf_dir))).select(
        "event_id", "sensor_id", "sensor_type", "timestamp"
    )
    drain_to_parquet(deduped, f"{root}/out", f"{root}/_ckpt")
    return spark.read.schema(deduped.schema).parquet(f"{root}/out")


def q_stream_kpi_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR4: KPI windows closed by the watermark (max event time - 1 hour)."""
    root = scratch_path(spark, "stream-kpi")
    records = file_record_stream(spark, sf_dir, with_resends=False)
    kpis = kpi_stream(clean_stream(records), delay=STREAM_KPI_DELAY)
    drain_to_parquet(kpis, f"{root}/out", f"{root}/_ckpt")
    return (
        spark.read.schema(kpis.schema)
        .parquet(f"{root}/out")
        .withColumns(r6("avg_value", "stddev_value", "anomaly_rate", "avg_quality_score"))
    )


#: Spans of arrival time; the stream is stopped and started again between them.
ARRIVAL_CUTS = ("2024-01-08 12:00:00", "2024-01-15 00:00:00", "2024-01-23 07:00:00")
RESEND_DELAY = "2 hours"


def arrivals(events: DataFrame) -> DataFrame:
    """Kafka-shaped records of raw events, in the order of their ids."""
    number = F.col("event_id").cast("long").alias("_offset")
    records = to_kafka_records(events.select("*", number), passthrough=("ingestion_timestamp", "_offset"))
    return records.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.col("ingestion_timestamp").alias("timestamp"),
        F.lit(0).alias("partition"),
        F.col("_offset").alias("offset"),
    )


def _with_restarts(spark: SparkSession, records: DataFrame, root: str, run) -> None:
    """Let the records arrive span by span, with a run of the stream behind each: a
    micro-batch per span and a restart between them."""
    bounds = (None, *ARRIVAL_CUTS, None)
    for since, until in zip(bounds, bounds[1:], strict=False):
        write_arrivals(records, f"{root}/in", since, until)
        run(arrival_stream(spark, f"{root}/in"))


def q_stream_first_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR3 with a defined winner over four micro-batches with restarts: of all copies
    that arrive in time the first one, with its value."""
    root = scratch_path(spark, "stream-first")

    def run(records: DataFrame) -> None:
        firsts = first_copy_stream(parse_records(records), RESEND_DELAY)
        kept = firsts.select("event_id", "sensor_id", "sensor_type", "timestamp", "value", "kafka_timestamp")
        drain_to_parquet(kept, f"{root}/out", f"{root}/_ckpt")

    _with_restarts(spark, arrivals(fixture_events(spark, sf_dir)), root, run)
    return spark.read.parquet(f"{root}/out")


def q_stream_kpi_resends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR3 feeding STR4 in one query, with re-sends, copies that come too late, four
    micro-batches and restarts: the KPIs of all closed windows."""
    root = scratch_path(spark, "stream-kpi-resends")

    def run(records: DataFrame) -> None:
        drain_to_parquet(deduped_kpi_stream(records, delay=RESEND_DELAY), f"{root}/out", f"{root}/_ckpt")

    first = fixture_events(spark, sf_dir, with_resends=False).filter(F.col("event_id").cast("long") % 50 == 7)
    late = first.withColumns(
        {
            "value": F.col("value") + 2,
            "ingestion_timestamp": F.col("ingestion_timestamp") + F.expr("INTERVAL 30 HOURS"),
        }
    )
    _with_restarts(spark, arrivals(fixture_events(spark, sf_dir).unionByName(late)), root, run)
    return (
        spark.read.parquet(f"{root}/out")
        .withColumns(r6("avg_value", "stddev_value", "anomaly_rate", "avg_quality_score"))
    )


def q_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL2 in STR1: every record, broken ones too, is in bronze or in quarantine."""
    root = scratch_path(spark, "stream-quarantine")
    good = arrivals(hard_bronze(spark, sf_dir))
    broken = good.filter(F.col("offset") % 301 == 0).withColumn(
        "value", F.lit('{"event_id": "cut off').cast("binary")
    )

    def run(records: DataFrame) -> None:
        start_quarantine_sink(records, f"{root}/bronze", f"{root}/_ckpt", available_now=True).awaitTermination()

    _with_restarts(spark, good.unionByName(broken), root, run)
    columns = ("event_id", "sensor_type", "timestamp", "value", "quality_score", "is_anomaly")
    rejected = read_quarantine(spark, f"{root}/bronze")
    return read_bronze(spark, f"{root}/bronze").select(*columns, F.lit("").alias("reasons")).unionByName(
        rejected.select(*columns, F.array_join("violations", ",").alias("reasons"))
    )


def q_bronze_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1 with upkeep: streamed and batch rows of one table after its closed days were
    folded into one folder, twice."""
    root = LakePaths(scratch_path(spark, "bronze-folded"))

    def run(records: DataFrame) -> None:
        run_bronze_ingest(records, root.bronze, f"{root.root}/_ckpt")
        fold_closed_days(spark, root.bronze, dt.date(2024, 1, 21))

    _with_restarts(spark, arrivals(fixture_events(spark, sf_dir)), root.root, run)
    ingest_bronze(fixture_events(spark, sf_dir), root.bronze)
    return read_bronze(spark, root.bronze).select(
        "event_id", "sensor_type", "facility_id", "timestamp", "value", "event_date", "source"
    )


QUERIES.update(
    {
        "stream_ingest": q_stream_ingest,
        "stream_dedup": q_stream_dedup,
        "stream_kpi_closed": q_stream_kpi_closed,
        "stream_first_copy": q_stream_first_copy,
        "stream_kpi_resends": q_stream_kpi_resends,
        "stream_quarantine": q_stream_quarantine,
        "bronze_folded": q_bronze_folded,
    }
)


# ---------------------------------------------------------------------------
# Governance: lineage and SLA checks
# ---------------------------------------------------------------------------

SLA_AS_OF = "2024-01-31 00:30:00"


def q_lineage_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIN1-4: a stream run and bronze -> silver -> gold with a lineage log; every count
    comes from the jobs themselves."""
    root = LakePaths(scratch_path(spark, "lineage"))
    log = LineageLog(spark, root.lineage)
    log.start_pipeline()
    raw = fixture_events(spark, sf_dir)
    streamed = f"{root.root}/streamed"
    write_arrivals(arrivals(raw), f"{root.root}/in", None, None)
    with StreamLineage(spark, "stream_bronze") as listener:
        records = arrival_stream(spark, f"{root.root}/in")
        run_bronze_ingest(records, streamed, f"{root.root}/_ckpt", metric="stream_bronze")
    listener.record(log, "source", "bronze", "append")
    with log.step("ingest_bronze", "source", "bronze", "append") as counts:
        ingest_bronze(raw, root.bronze, counts=counts)
    with log.step("process_silver", "bronze", "silver", "dedup_clean_enrich") as counts:
        process_silver(spark, root.bronze, root.silver, counts=counts)
    gold = process_gold(spark, root.silver, root.kpis, root.severity)
    for name, rows in (("aggregate_kpis", "kpi_rows"), ("score_anomalies", "severity_rows")):
        with log.step(name, "silver", "gold", "aggregate") as counts:
            counts.update(input=gold["input_rows"], output=gold[rows])
    log.complete_pipeline()
    table = log.table()
    runs = lineage_runs(table).select("pipeline_id", "total_steps", F.col("completed_at").isNotNull().alias("completed"))
    return lineage_steps(table).join(runs, "pipeline_id").select(
        "name",
        "source_layer",
        "target_layer",
        "operation",
        "input_count",
        "output_count",
        "total_steps",
        "completed",
    )


def _sla_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = plain_silver(spark, sf_dir)
    bronze = fixture_events(spark, sf_dir)
    fresh = freshness(silver, SLA_AS_OF, by="facility_id").drop("facility_id")
    fresh_all = freshness(silver, SLA_AS_OF)
    expected = layer_counts(
        {
            "bronze": bronze,
            "silver": bronze.select("event_id").distinct(),
            "gold": silver.select("facility_id", F.to_date("timestamp")).distinct(),
        }
    ).withColumnRenamed("actual_count", "expected_count")
    actual = layer_counts(
        {
            "bronze": validate_events(bronze),
            "silver": silver,
            "gold": anomaly_scores(silver.withColumn("z_score", F.lit(0.0))),
        }
    )
    comp = completeness(actual, expected, SLA_AS_OF)
    return as_sla_rows(fresh.unionByName(fresh_all)).unionByName(as_sla_rows(comp))


def q_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SLA1 per facility and overall at a fixed as-of time."""
    silver = plain_silver(spark, sf_dir)
    per = freshness(silver, SLA_AS_OF, by="facility_id").drop("facility_id")
    overall = freshness(silver, SLA_AS_OF)
    return per.unionByName(overall).select(
        "name", "latest_event", "status", "metric_value", "threshold"
    )


def q_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _sla_checks(spark, sf_dir)
        .filter(F.col("name").startswith("data_completeness"))
        .select("name", "status", "metric_value", "threshold")
    )


def q_sla_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sla_alerts(_sla_checks(spark, sf_dir)).select("name", "status", "metric_value")


def q_sla_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SLA4 over an SLA history table written by two check runs."""
    path = scratch_path(spark, "sla") + "/sla_checks"
    checks = _sla_checks(spark, sf_dir)
    append_sla_history(spark, checks.filter(F.col("name").startswith("data_completeness")), path)
    append_sla_history(spark, checks.filter(F.col("name").startswith("data_freshness")), path)
    return sla_dashboard(read_sla_history(spark, path))


def q_sla_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SLA4, LIM2: the newest checks of an SLA history (a top-k report)."""
    path = scratch_path(spark, "sla-recent") + "/sla_checks"
    checks = _sla_checks(spark, sf_dir)
    append_sla_history(spark, checks, path)
    older = checks.withColumn("checked_at", F.col("checked_at") - F.expr("INTERVAL 1 DAY"))
    append_sla_history(spark, older, path)
    return recent_checks(read_sla_history(spark, path), 9).select(
        "name", "status", "metric_value", "checked_at"
    )


QUERIES.update(
    {
        "sla_recent": q_sla_recent,
        "lineage_runs": q_lineage_runs,
        "freshness": q_freshness,
        "completeness": q_completeness,
        "sla_alerts": q_sla_alerts,
        "sla_dashboard": q_sla_dashboard,
    }
)
