"""Streams: winners, chained state, quarantine, folding, odd event times."""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import bronze_rows, event
from sluice.operators.ingest import event_time, parse_records, validate_events
from sluice.config import DEFAULT_CONFIG
from sluice.plans import medallion
from sluice.plans.medallion import ingest_bronze
from sluice.sources.journal import Journal
from sluice.sources.tables import (
    LakePaths,
    bronze_batches,
    marks_path,
    read_bronze,
    read_silver,
    replaced_days,
    stream_part,
)
from sluice.streaming import folding
from sluice.streaming.folding import fold_closed_days
from sluice.streaming.jobs import (
    RECORD_SCHEMA,
    arrival_stream,
    deduped_kpi_stream,
    drain_to_parquet,
    first_copy_stream,
    read_quarantine,
    start_quarantine_sink,
    write_arrivals,
    write_contract_batch,
    write_stream_batch,
)

DAY = "2024-01-01"
CFG = dataclasses.replace(DEFAULT_CONFIG, key_buckets=2)


def process_silver(spark, bronze, silver):
    return medallion.process_silver(spark, bronze, silver, CFG)


def record(eid, t, value, offset, arrives, **kw):
    body = {"event_id": eid, "sensor_id": "S", "sensor_type": "temperature", "facility_id": "P",
            "timestamp": f"{DAY}T{t}Z", "value": value, "unit": "celsius", **kw}
    return (b"S", json.dumps(body).encode(), dt.datetime.fromisoformat(f"{DAY} {arrives}"), 0, offset)


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, RECORD_SCHEMA).write.mode("append").parquet(folder)


def test_the_first_copy_by_arrival_wins_and_late_copies_are_dropped(spark, tmp_root):
    src, out = f"{tmp_root}/in", f"{tmp_root}/out"
    batches = [
        # Both copies in one micro-batch, the earlier arrival listed last.
        [record("a", "01:00:00", 2.0, 5, "01:09:00"), record("a", "01:00:00", 1.0, 4, "01:01:00"),
         record("b", "01:30:00", 3.0, 6, "01:30:00")],
        # A copy in a later micro-batch, in time; the watermark then passes both.
        [record("b", "01:30:00", 9.0, 7, "02:00:00"), record("c", "05:00:00", 4.0, 8, "05:00:00")],
        # Copies behind the watermark, and an event that closes c.
        [record("a", "01:00:00", 8.0, 9, "06:00:00"), record("d", "09:00:00", 5.0, 10, "09:00:00")],
    ]
    for rows in batches:
        arrive(spark, src, rows)
        firsts = first_copy_stream(parse_records(arrival_stream(spark, src)), "1 hour")
        drain_to_parquet(firsts.select("event_id", "value"), out, f"{tmp_root}/ckpt")
    got = sorted((r.event_id, r.value) for r in spark.read.parquet(out).collect())
    assert got == [("a", 1.0), ("b", 3.0), ("c", 4.0)]  # d is not closed yet


def test_kpis_count_re_sent_records_once(spark, tmp_root):
    src, out = f"{tmp_root}/in", f"{tmp_root}/out"
    for hour in range(1, 7):
        rows = [record(f"e{hour}", f"0{hour}:05:00", float(hour), 10 * hour, f"0{hour}:05:01")]
        rows += [record(f"e{hour}", f"0{hour}:05:00", 99.0, 10 * hour + n, f"0{hour}:40:0{n}") for n in (1, 2)]
        arrive(spark, src, rows)
        kpis = deduped_kpi_stream(arrival_stream(spark, src), delay="2 hours")
        drain_to_parquet(kpis, out, f"{tmp_root}/ckpt")
    got = sorted((r.window_start.hour, r.event_count, r.max_value) for r in spark.read.parquet(out).collect())
    assert got == [(h, 1, float(h)) for h in range(1, 4)]


def test_every_record_is_in_bronze_or_in_quarantine(spark, tmp_root):
    src, path = f"{tmp_root}/in", f"{tmp_root}/bronze"
    rows = [record(f"e{i}", "01:00:00", float(i), i, "01:00:00") for i in range(20)]
    rows += [record("bad", "01:00:00", 1.0, 30, "01:00:00", quality_score=7.0),
             record(None, "01:00:00", 1.0, 31, "01:00:00"), (b"k", b"{broken", None, 0, 32), (None, None, None, 0, 33)]
    for part in (rows[:10], rows[10:]):
        arrive(spark, src, part)
        start_quarantine_sink(arrival_stream(spark, src), path, f"{tmp_root}/ckpt", available_now=True).awaitTermination()
    bad = {r.kafka_offset: (r.violations, r.raw_value) for r in read_quarantine(spark, path).collect()}
    assert read_bronze(spark, path).count() == 20 and set(bad) == {30, 31, 32, 33}
    assert bad[30][0] == ["quality_score_out_of_range"] and bad[31][0] == ["missing_event_id"]
    assert bad[32] == ([f"missing_{c}" for c in ("event_id", "sensor_id", "sensor_type", "facility_id",
                                                  "timestamp", "value", "unit")], "{broken")


def test_a_micro_batch_that_dies_between_its_sinks_is_run_again(spark, tmp_root, monkeypatch):
    from sluice.streaming import jobs

    path = f"{tmp_root}/bronze"
    rows = [record(f"e{i}", "01:00:00", float(i), i, "01:00:00") for i in range(5)] + [(b"k", b"{", None, 0, 9)]
    parsed = parse_records(spark.createDataFrame(rows, RECORD_SCHEMA), raw="raw_value")

    def dies(*args, **kw):
        raise RuntimeError("dies")

    monkeypatch.setattr(jobs, "write_stream_batch", dies)
    with pytest.raises(RuntimeError):
        write_contract_batch(parsed, path, "s", 0)
    monkeypatch.undo()
    write_contract_batch(parsed, path, "s", 0)
    assert read_bronze(spark, path).count() == 5 and read_quarantine(spark, path).count() == 1


def test_no_task_keeps_a_whole_split_of_the_source(spark, tmp_root):
    rows = [record(f"e{i}", "01:00:00", float(i), i, "01:00:00", sensor_type="none") for i in range(4000)]
    spark.createDataFrame(rows, RECORD_SCHEMA).coalesce(1).write.parquet(f"{tmp_root}/in")
    batch = parse_records(spark.read.parquet(f"{tmp_root}/in"), raw="raw_value")
    assert batch.rdd.getNumPartitions() == 1
    path, split, block = f"{tmp_root}/bronze", "spark.sql.files.maxPartitionBytes", "parquet.block.size"
    before = spark.conf.get(split)
    spark.conf.set(split, "8k")
    spark.conf.set(block, "32768")
    try:
        write_contract_batch(batch, path, "s", 0)
    finally:
        spark.conf.set(split, before)
        spark.conf.unset(block)
    rejected = read_quarantine(spark, path)
    assert rejected.count() == 4000 and rejected.filter("raw_value is null").isEmpty()
    per_task = [r["count"] for r in rejected.groupBy(F.input_file_name()).count().collect()]
    assert max(per_task) <= 2000


def test_what_one_task_wrote_is_read_by_several(spark, tmp_root):
    # 40 MB of payload that does not compress, from one task.
    value = F.concat(F.lit("{broken"), F.expr("randstr(20000, 7)")).cast("binary")
    at = F.lit("2024-01-01 01:00:00").cast("timestamp")
    records = spark.range(0, 2000, numPartitions=1).select(
        F.lit(b"S").alias("key"), value.alias("value"), at.alias("timestamp"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"),
    )
    src, path, split = f"{tmp_root}/in", f"{tmp_root}/bronze", "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(split)
    spark.conf.set(split, "4m")
    try:
        write_arrivals(records, src, None, "2024-01-02")
        arrived = spark.read.schema(RECORD_SCHEMA).parquet(src)
        one = arrived.select("value").groupBy(F.spark_partition_id()).count().collect()
        # All of it from one task, as a topic partition is: staged, then read in splits.
        batch = parse_records(arrived.coalesce(1), raw="raw_value")
        write_contract_batch(batch, path, "s", 0)
    finally:
        spark.conf.set(split, before)
    rejected = read_quarantine(spark, path)
    per_task = [r["count"] for r in rejected.groupBy(F.input_file_name()).count().collect()]
    for read in ([r["count"] for r in one], per_task):
        assert sum(read) == 2000 and max(read) <= 700
    assert rejected.select("raw_value").distinct().count() == 2000


def streamed(spark, path, batches=4):
    for n in range(batches):
        rows = [event(f"{n}-{i}", t=f"2024-01-0{1 + (i + n) % 4} 0{n}:00:00") for i in range(8)]
        rows.append(event(f"{n}-untimed", t=None))
        df = bronze_rows(spark, rows).withColumn("event_date", F.to_date("timestamp"))
        write_stream_batch(df, path, "s", n)


def ids(spark, path):
    return sorted(r[0] for r in read_bronze(spark, path).select("event_id").collect())


FOLD_STEPS = [
    ("write_partitioned", "after"), ("write_text", "after"), ("_enter", "after"),
    ("rename_path", "after"), ("delete_path", "before"), ("clean_up", "before"),
]


@pytest.mark.parametrize(("where", "moment"), FOLD_STEPS)
def test_folding_may_die_anywhere_and_rows_are_read_once(spark, tmp_root, monkeypatch, where, moment):
    p = LakePaths(tmp_root)
    streamed(spark, p.bronze, 3)
    ingest_bronze(bronze_rows(spark, [event("batch", t="2024-01-01 00:00:00")]), p.bronze)
    process_silver(spark, p.bronze, p.silver)
    want = ids(spark, p.bronze)
    real, calls = getattr(folding, where), []

    def step(*args, **kw):
        calls.append(1)
        dies = len(calls) == (2 if where in ("clean_up", "delete_path") else 1)
        if dies and moment == "before":
            raise RuntimeError(where)
        out = real(*args, **kw)
        if dies:
            raise RuntimeError(where)
        return out

    monkeypatch.setattr(folding, where, step)
    with pytest.raises(RuntimeError):
        fold_closed_days(spark, p.bronze, dt.date(2024, 1, 4), p.silver)
    monkeypatch.undo()
    assert ids(spark, p.bronze) == want
    fold_closed_days(spark, p.bronze, dt.date(2024, 1, 4), p.silver)
    assert ids(spark, p.bronze) == want and not replaced_days(spark, p.bronze)
    assert not [f for f in os.listdir(p.bronze) if f.startswith("_fold-")]
    assert process_silver(spark, p.bronze, p.silver) == 0
    assert read_silver(spark, p.silver).count() == len(want)


def test_closed_days_leave_the_stream_folders(spark, tmp_root):
    p = LakePaths(tmp_root)
    streamed(spark, p.bronze)
    want = ids(spark, p.bronze)
    n = fold_closed_days(spark, p.bronze, dt.date(2024, 1, 4))
    assert n == 3 * 6 and ids(spark, p.bronze) == want
    left = {b: os.listdir(f"{stream_part(p.bronze)}/batch={b}") for b in ("s-0", "s-3")}
    assert {f for f in left["s-0"] if "date" in f} == {
        "event_date=2024-01-04", "event_date=__HIVE_DEFAULT_PARTITION__"
    }
    assert len([f for f in left["s-3"] if "date" in f]) == 5  # the newest may be run again
    # One day is read from one folder and the newest micro-batch.
    files = [f for f in read_bronze(spark, p.bronze).inputFiles() if "event_date=2024-01-02" in f]
    assert len({os.path.dirname(f) for f in files}) == 2
    assert fold_closed_days(spark, p.bronze, dt.date(2024, 1, 4)) == 0


def test_only_what_silver_has_taken_is_folded(spark, tmp_root):
    p = LakePaths(tmp_root)
    streamed(spark, p.bronze, 2)
    assert fold_closed_days(spark, p.bronze, dt.date(2024, 1, 4), p.silver) == 0  # no silver yet
    process_silver(spark, p.bronze, p.silver)
    df = bronze_rows(spark, [event("new", t="2024-01-01 05:00:00")]).withColumn("event_date", F.to_date("timestamp"))
    write_stream_batch(df, p.bronze, "s", 2)
    write_stream_batch(df.withColumn("event_id", F.lit("newest")), p.bronze, "s", 3)
    assert fold_closed_days(spark, p.bronze, dt.date(2024, 1, 4), p.silver) == 12
    assert process_silver(spark, p.bronze, p.silver) == 2
    assert read_silver(spark, p.silver).count() == 20
    state = Journal(spark, marks_path(p.silver)).state()
    assert set(state["batches"]) == set(bronze_batches(spark, p.bronze))


def test_event_times_of_any_number(spark):
    cases = {
        "1704067200": "2024-01-01 00:00:00", "1704067200000": "2024-01-01 00:00:00",
        "1704067200.25": "2024-01-01 00:00:00.250000", "1.7040672E9": "2024-01-01 00:00:00",
        "1.7040672E12": "2024-01-01 00:00:00", "9999999999999": "2286-11-20 17:46:39.999000",
        "1.7E13": "2508-09-16 06:13:20", "9.9E13": "5107-03-10 08:00:00", "-86400": "1969-12-31 00:00:00",
        "1.7E15": None, "99999999999999999999": None, "-99999999999999999": None, "1E300": None,
        "-1E300": None, "1e-5": "1970-01-01 00:00:00.000010", "NaN": None, "x": None, "": None, None: None,
        "2024-01-01T00:00:00Z": "2024-01-01 00:00:00", "99999999999999": "5138-11-16 09:46:39.999000",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.s for r in df.select("t", event_time(F.col("t")).cast("string").alias("s")).collect()}
    short = {k: v and v.rstrip("0").rstrip(".") if v and "." in v else v for k, v in cases.items()}
    assert got == short


def test_one_odd_record_does_not_stop_the_others(spark):
    body = '{"event_id":"%s","sensor_id":"S","sensor_type":"pressure","facility_id":"P","timestamp":%s,"value":1.0,"unit":"bar"}'
    times = ["1.7E300", "9999999999999", "-1e30", "1704067200", "12345678901234567890123456789012345678901234567890", "true", "[1]"]
    rows = [(body % (i, t),) for i, t in enumerate(times)]
    got = validate_events(parse_records(spark.createDataFrame(rows, "value string"))).collect()
    assert sorted(r.event_id for r in got) == ["1", "3"]
