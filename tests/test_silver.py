from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import SMOKE, bronze_rows, event, ts
from sluice.operators.clean import clean
from sluice.operators.dedup import dedup_first
from sluice.operators.enrich import enrich, rolling_stats, time_features
from sluice.sources.fixtures import fixture_events


def test_dedup_keeps_first_arrival_and_breaks_ties(spark):
    rows = [
        event(1, value=5.0, ingest="2024-01-01 01:00:00"),
        event(1, value=6.0, ingest="2024-01-01 00:30:00"),  # earliest arrival wins
        event(2, value=9.0, t="2024-01-01 00:00:02", ingest="2024-01-01 02:00:00"),
        event(2, value=8.0, t="2024-01-01 00:00:01", ingest="2024-01-01 02:00:00"),  # tie -> earlier event time
        event(3, value=4.0, ingest="2024-01-01 03:00:00"),
        event(3, value=3.0, ingest="2024-01-01 03:00:00"),  # full tie -> smaller value
    ]
    got = {r["event_id"]: r["value"] for r in dedup_first(bronze_rows(spark, rows)).collect()}
    assert got == {"1": 6.0, "2": 8.0, "3": 3.0}


def test_dedup_runs_before_clean(spark):
    rows = [
        event(1, value=None, ingest="2024-01-01 00:00:00"),
        event(1, value=7.0, ingest="2024-01-01 01:00:00"),
    ]
    assert clean(dedup_first(bronze_rows(spark, rows))).count() == 0


def test_clean_defaults_trim_and_filters(spark):
    rows = [
        event(1, fac=" 001 ", sensor=" S-9 ", quality_score=None, is_anomaly=None),
        event(2, stype="unknown"),
        event(3, value=None),
    ]
    out = clean(bronze_rows(spark, rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert r["facility_id"] == "001" and r["sensor_id"] == "S-9"
    assert r["quality_score"] == 1.0 and r["is_anomaly"] is False


def test_single_and_constant_readings_give_zero_z(spark):
    rows = [event(1, sensor="A", value=3.0)] + [
        event(10 + i, sensor="B", t=f"2024-01-01 00:0{i}:00", value=2.0) for i in range(4)
    ]
    out = {r["event_id"]: r for r in enrich(clean(bronze_rows(spark, rows))).collect()}
    assert out["1"]["rolling_stddev"] is None and out["1"]["z_score"] == 0.0
    assert all(out[str(10 + i)]["z_score"] == 0.0 for i in range(4))
    assert out["13"]["rolling_stddev"] == 0.0


def test_rolling_frame_is_100_rows(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [event(i, sensor="A", t=base + dt.timedelta(minutes=i), value=float(i)) for i in range(150)]
    out = {int(r["event_id"]): r for r in rolling_stats(bronze_rows(spark, rows)).collect()}
    assert out[0]["rolling_mean"] == 0.0
    assert out[99]["rolling_mean"] == sum(range(100)) / 100
    assert out[149]["rolling_mean"] == sum(range(50, 150)) / 100


def test_chunked_equals_direct_bit_for_bit(spark):
    """Tiny chunks and minute buckets force many carries across chunk boundaries."""
    df = clean(dedup_first(fixture_events(spark, SMOKE)))
    direct = rolling_stats(df, strategy="direct").select("event_id", "rolling_mean", "rolling_stddev")
    chunked = rolling_stats(df, numbering="bucket", chunk_rows=120, bucket="minute").select(
        "event_id", F.col("rolling_mean").alias("m2"), F.col("rolling_stddev").alias("s2")
    )
    joined = direct.join(chunked, "event_id", "full")
    assert joined.count() == df.count()
    diff = joined.filter(
        ~F.col("rolling_mean").eqNullSafe(F.col("m2")) | ~F.col("rolling_stddev").eqNullSafe(F.col("s2"))
    )
    assert diff.count() == 0


def test_bucket_numbering_unstaged_matches(spark):
    df = clean(dedup_first(fixture_events(spark, SMOKE)))
    a = rolling_stats(df, numbering="bucket", chunk_rows=150, materialize=False).select("event_id", "rolling_mean")
    b = rolling_stats(df, strategy="direct").select("event_id", F.col("rolling_mean").alias("m"))
    assert a.join(b, "event_id").filter(~F.col("rolling_mean").eqNullSafe(F.col("m"))).count() == 0


def test_business_hours_edges(spark):
    # 2024-01-05 is a Friday, 06 Saturday, 07 Sunday
    cases = {}
    eid = 0
    for day in ("05", "06", "07"):
        for hour in (7, 8, 17, 18):
            eid += 1
            cases[str(eid)] = (day, hour)
    rows = [event(k, t=f"2024-01-{d} {h:02d}:30:00") for k, (d, h) in cases.items()]
    out = {r["event_id"]: r for r in time_features(bronze_rows(spark, rows)).collect()}
    for k, (d, h) in cases.items():
        r = out[k]
        assert r["hour_of_day"] == h
        assert r["day_of_week"] == {"05": 6, "06": 7, "07": 1}[d]
        assert r["is_business_hours"] == (d == "05" and h in (8, 17))


def test_timestamps_are_utc(spark):
    rows = [event(1, t="2024-01-01 23:30:00")]
    r = time_features(bronze_rows(spark, rows)).first()
    assert r["hour_of_day"] == 23 and str(r["event_date"]) == "2024-01-01"
    assert ts("2024-01-01 23:30:00") == r["timestamp"]


def test_range_numbering_matches_direct(spark):
    """Range-partitioned numbering: sensors cut across many partitions, tiny chunks."""
    df = clean(dedup_first(fixture_events(spark, SMOKE)))
    direct = rolling_stats(df, strategy="direct").select("event_id", "rolling_mean", "rolling_stddev")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        ranged = rolling_stats(df, numbering="range", chunk_rows=120).select(
            "event_id", F.col("rolling_mean").alias("m2"), F.col("rolling_stddev").alias("s2")
        )
        joined = direct.join(ranged, "event_id", "full")
        assert joined.count() == df.count()
        diff = joined.filter(
            ~F.col("rolling_mean").eqNullSafe(F.col("m2")) | ~F.col("rolling_stddev").eqNullSafe(F.col("s2"))
        )
        assert diff.count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
