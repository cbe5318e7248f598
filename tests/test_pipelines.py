from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SMOKE, bronze_rows, event
from sluice.operators.aggregate import aggregate_kpis
from sluice.plans.medallion import Lakehouse, ingest_bronze, process_silver
from sluice.sources.fixtures import fixture_events
from sluice.sources.tables import (
    LakePaths,
    expired_partitions,
    purge_partitions,
    read_bronze,
    read_kpis,
    read_silver,
    write_partitioned,
)
from sluice.streaming.jobs import file_record_stream, run_bronze_ingest

SILVER_COLS = ("event_id", "facility_id", "value", "rolling_mean", "rolling_stddev", "z_score", "event_date")


import dataclasses

import pytest

from sluice.config import DEFAULT_CONFIG


@pytest.mark.parametrize("history_days", [2, 40])
def test_incremental_equals_full_for_ordered_arrivals(spark, tmp_root, history_days):
    """history_days=2 exercises the older-partition fallback, 40 the recent-only path."""
    cfg = dataclasses.replace(DEFAULT_CONFIG, history_days=history_days)
    rows = fixture_events(spark, SMOKE).drop("ingestion_timestamp")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp")
    inc = LakePaths(f"{tmp_root}/inc")
    ingest_bronze(rows.filter(F.col("timestamp") < cut), inc.bronze, ingestion_ts=F.lit("2024-02-01").cast("timestamp"))
    n1 = process_silver(spark, inc.bronze, inc.silver, cfg)
    ingest_bronze(rows.filter(F.col("timestamp") >= cut), inc.bronze, ingestion_ts=F.lit("2024-02-02").cast("timestamp"))
    n2 = process_silver(spark, inc.bronze, inc.silver, cfg)
    assert process_silver(spark, inc.bronze, inc.silver, cfg) == 0  # nothing new

    full = LakePaths(f"{tmp_root}/full")
    ingest_bronze(rows, full.bronze, ingestion_ts=F.lit("2024-02-01").cast("timestamp"))
    n_full = process_silver(spark, full.bronze, full.silver, incremental=False)
    assert n1 + n2 == n_full and n1 > 0 and n2 > 0

    a = read_silver(spark, inc.silver).select(*SILVER_COLS)
    b = read_silver(spark, full.silver).select(*SILVER_COLS)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_resend_in_later_batch_is_dropped(spark, tmp_root):
    p = LakePaths(tmp_root)
    ingest_bronze(bronze_rows(spark, [event(1, value=1.0, ingest="2024-01-01 00:00:00")]), p.bronze)
    assert process_silver(spark, p.bronze, p.silver) == 1
    later = [event(1, value=2.0, ingest="2024-01-01 05:00:00"), event(2, t="2024-01-01 01:00:00", ingest="2024-01-01 05:00:00")]
    ingest_bronze(bronze_rows(spark, later), p.bronze)
    assert process_silver(spark, p.bronze, p.silver) == 1
    assert sorted(r[0] for r in read_silver(spark, p.silver).select("event_id").collect()) == ["1", "2"]


def test_partition_pruning_and_string_partitions(spark, tmp_root):
    p = LakePaths(tmp_root)
    ingest_bronze(bronze_rows(spark, [event(1, fac="001", t="2024-01-02 00:00:00")]), p.bronze)
    df = read_bronze(spark, p.bronze, "2024-01-01", "2024-01-03", "temperature")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_date" in plan and "sensor_type" in plan
    assert df.count() == 1
    process_silver(spark, p.bronze, p.silver)
    r = read_silver(spark, p.silver, facility_id="001").first()
    assert r["facility_id"] == "001"  # not inferred as an integer


def test_empty_overwrite_stays_readable(spark, tmp_root):
    p = LakePaths(tmp_root)
    empty = aggregate_kpis(read_silver(spark, p.silver))
    assert write_partitioned(empty, p.kpis, ("kpi_date", "facility_id"), "overwrite") == 0
    assert read_kpis(spark, p.kpis).count() == 0


def test_expired_partitions_and_purge(spark, tmp_root):
    p = LakePaths(tmp_root)
    rows = [event(i, t=f"2024-01-{d:02d} 00:00:00") for i, d in enumerate((1, 1, 2, 20))]
    ingest_bronze(bronze_rows(spark, rows), p.bronze, ingestion_ts=F.current_timestamp())
    exp = {str(r["event_date"]): r["row_count"] for r in expired_partitions(read_bronze(spark, p.bronze), "2024-01-13", 10).collect()}
    assert exp == {"2024-01-01": 2, "2024-01-02": 1}
    assert purge_partitions(spark, p.bronze, [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]) == 2
    assert read_bronze(spark, p.bronze).count() == 1


def test_lakehouse_facade_end_to_end(spark, tmp_root):
    lake = Lakehouse(spark, tmp_root)
    n = lake.ingest(fixture_events(spark, SMOKE))
    assert n == lake.bronze().count()
    s = lake.process_silver()
    g = lake.process_gold()
    assert s == lake.silver().count() and g["severity_rows"] == lake.severity().count()
    stats = lake.gold_stats().first()
    assert stats["total_kpi_rows"] == g["kpi_rows"] and stats["facility_count"] == 3
    from sluice.sources.tables import gold_facilities

    assert sorted(r[0] for r in gold_facilities(lake.kpis()).collect()) == ["PLANT-A", "PLANT-B", "PLANT-C"]
    totals = [r for r in lake.bronze_stats().collect() if r["is_total"]]
    assert totals[0]["row_count"] == n
    assert lake.expired("2024-02-10").count() == 0  # 90-day retention keeps January


def test_stream_restart_adds_nothing(spark, tmp_root):
    out, ckpt = f"{tmp_root}/bronze", f"{tmp_root}/ckpt"
    run_bronze_ingest(file_record_stream(spark, SMOKE), out, ckpt)
    first = read_bronze(spark, out).count()
    run_bronze_ingest(file_record_stream(spark, SMOKE), out, ckpt)
    assert read_bronze(spark, out).count() == first > 0
    assert os.path.isdir(ckpt)


def test_one_bronze_for_stream_and_batch_in_both_orders(spark, tmp_root):
    batch = bronze_rows(spark, [event(f"b{i}") for i in range(7)])
    for order in ("stream first", "batch first"):
        root = f"{tmp_root}/{order[:5]}"
        out, ckpt = f"{root}/bronze", f"{root}/ckpt"
        if order == "batch first":
            ingest_bronze(batch, out)
        run_bronze_ingest(file_record_stream(spark, SMOKE), out, ckpt)
        streamed = read_bronze(spark, out).filter("kafka_offset is not null").count()
        if order == "stream first":
            ingest_bronze(batch, out)
        assert streamed > 0 and read_bronze(spark, out).count() == streamed + 7


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_root):
    from sluice.streaming.jobs import write_stream_batch

    rows = bronze_rows(spark, [event(i, t=f"2024-01-0{1 + i % 3} 00:00:00") for i in range(30)])
    rows = rows.withColumn("event_date", F.to_date("timestamp"))
    for _ in range(2):
        write_stream_batch(rows, f"{tmp_root}/bronze", "s1", 0)
    write_stream_batch(rows, f"{tmp_root}/bronze", "s2", 0)
    assert read_bronze(spark, f"{tmp_root}/bronze").count() == 60
    assert read_bronze(spark, f"{tmp_root}/bronze", "2024-01-02", "2024-01-02").count() == 20


def test_a_streamed_day_is_spread_over_tasks(spark, tmp_root):
    """One day and type in a micro-batch: adaptive execution splits the folder."""
    from sluice.streaming.jobs import write_stream_batch

    keep = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(0, 40_000, 1, 8).select(
            F.col("id").cast("string").alias("event_id"), F.rand(1).alias("value"),
            F.lit("temperature").alias("sensor_type"), F.lit("2024-01-01").cast("date").alias("event_date"),
        )
        write_stream_batch(rows, f"{tmp_root}/bronze", "s", 0)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", keep)
    files = os.listdir(f"{tmp_root}/bronze_stream/batch=s-0/event_date=2024-01-01/sensor_type=temperature")
    assert sum(f.endswith(".parquet") for f in files) > 2


def test_purge_of_a_streamed_table_and_listed_rows(spark, tmp_root):
    lake = Lakehouse(spark, tmp_root)
    lake.ingest(bronze_rows(spark, [event(1, t="2023-01-01 00:00:00"), event(2)]))
    run_bronze_ingest(file_record_stream(spark, SMOKE), lake.paths.bronze, f"{tmp_root}/ckpt")
    before = lake.bronze().count()
    listed = lake.expired("2024-04-10", purge=True)
    gone = {str(r["event_date"]): r["row_count"] for r in listed.collect()}
    assert "2023-01-01" in gone and len(gone) > 3
    assert lake.bronze().count() == before - sum(gone.values())


def test_a_copy_re_sent_days_later_is_dropped(spark, tmp_root):
    p = LakePaths(tmp_root)
    ingest_bronze(bronze_rows(spark, [event(1, ingest="2024-01-01 00:00:00")]), p.bronze)
    process_silver(spark, p.bronze, p.silver)
    later = [event(1, value=9.0, ingest="2024-01-09 00:00:00"), event(2, ingest="2024-01-09 00:00:00")]
    ingest_bronze(bronze_rows(spark, later), p.bronze)
    assert process_silver(spark, p.bronze, p.silver) == 1
    assert read_silver(spark, p.silver).count() == 2


def test_rows_without_event_time_stay_in_the_history(spark, tmp_root):
    full, steps = LakePaths(f"{tmp_root}/full"), LakePaths(f"{tmp_root}/steps")
    first = [event(i, t=None, ingest="2024-01-01 00:00:00", value=float(i)) for i in range(5)]
    first += [event(10 + i, t=f"2024-01-01 0{i}:00:00", ingest="2024-01-01 10:00:00") for i in range(3)]
    second = [event(20 + i, t=f"2024-01-05 0{i}:00:00", ingest="2024-01-05 10:00:00") for i in range(3)]
    ingest_bronze(bronze_rows(spark, first + second), full.bronze)
    process_silver(spark, full.bronze, full.silver)
    for part in (first, second):
        ingest_bronze(bronze_rows(spark, part), steps.bronze)
        process_silver(spark, steps.bronze, steps.silver)

    def means(p):
        return {r[0]: r[1] for r in read_silver(spark, p.silver).select("event_id", "rolling_mean").collect()}

    assert means(full) == means(steps) and len(means(full)) == 11


def test_recorded_mark_is_a_lower_bound(spark, tmp_root):
    from sluice.sources.tables import marks_path, read_high_water_mark, recorded_mark

    p = LakePaths(tmp_root)
    ingest_bronze(bronze_rows(spark, [event(1, ingest="2024-01-01 00:00:00")]), p.bronze)
    process_silver(spark, p.bronze, p.silver)
    assert str(recorded_mark(spark, p.silver)) == "2024-01-01 00:00:00"
    # a run that wrote silver but died before recording its mark
    later = bronze_rows(spark, [event(2, ingest="2024-01-02 00:00:00")])
    ingest_bronze(later, p.bronze)
    from sluice.plans.medallion import silver_batch

    write_partitioned(silver_batch(spark, p.bronze, p.silver), p.silver, ("event_date", "facility_id"))
    mark = read_high_water_mark(read_silver(spark, p.silver), at_least=recorded_mark(spark, p.silver))
    assert str(mark) == "2024-01-02 00:00:00"
    assert process_silver(spark, p.bronze, p.silver) == 0  # nothing is processed twice
    assert read_silver(spark, p.silver).count() == 2
    assert marks_path(p.silver).endswith("_marks")


def test_stats_of_an_empty_lake_are_zero_rows(spark, tmp_root):
    lake = Lakehouse(spark, tmp_root)
    totals = [r for r in lake.bronze_stats().collect() if r["is_total"]]
    assert len(totals) == 1 and totals[0]["row_count"] == 0
    assert lake.silver_stats().first()["total_rows"] == 0
    g = lake.gold_stats().first()
    assert g["total_kpi_rows"] == 0 and g["facility_count"] == 0


def test_history_with_registry_reads_older_rows_only_when_needed(spark, tmp_root):
    from sluice.plans.medallion import with_history
    from sluice.schema import SILVER_SCHEMA

    base = dt.datetime(2024, 1, 1)
    old_rows = [event(i, sensor="A", t=base + dt.timedelta(hours=i), value=float(i)) for i in range(120)]
    silver = bronze_rows(spark, old_rows).select(*[c for c in SILVER_SCHEMA.fieldNames() if c in BRONZE_COLS])
    new = bronze_rows(
        spark,
        [event(1000, sensor="A", t="2024-03-01 00:00:00"), event(1001, sensor="B", t="2024-03-01 00:00:00")],
    )
    registry = spark.createDataFrame(
        [("A", "temperature", dt.date(2024, 1, 1))], "sensor_id string, sensor_type string, first_event_date date"
    )
    since = dt.date(2024, 2, 28)
    out = with_history(new, silver, 99, since, registry)
    hist = out.filter(F.col("_hist"))
    assert hist.filter(F.col("sensor_id") == "A").count() == 99  # found in older partitions
    assert hist.filter(F.col("sensor_id") == "B").count() == 0
    assert sorted(int(r[0]) for r in hist.select("event_id").collect())[0] == 21


BRONZE_COLS = set(
    "event_id sensor_id sensor_type facility_id timestamp value unit quality_score is_anomaly "
    "ingestion_timestamp event_date".split()
)
