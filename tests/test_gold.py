from __future__ import annotations

import datetime as dt

from sluice.operators.aggregate import aggregate_kpis, anomaly_scores
from sluice.functions.columns import severity_level


def test_severity_levels_are_strict(spark):
    df = spark.createDataFrame([(10.0,), (10.000001,), (25.0,), (50.0,), (50.5,)], "anomaly_severity double")
    got = [r[0] for r in df.select(severity_level()).collect()]
    assert got == ["NORMAL", "ELEVATED", "ELEVATED", "WARNING", "CRITICAL"]


def test_severity_formula(spark):
    # one facility-day: |z| avg 2, anomaly rate 0.5, quality 0.9
    silver = spark.createDataFrame(
        [("PLANT-A", dt.datetime(2024, 1, 1, 1), 1.0, True, 0.8), ("PLANT-A", dt.datetime(2024, 1, 1, 2), -3.0, False, 1.0)],
        "facility_id string, timestamp timestamp, z_score double, is_anomaly boolean, quality_score double",
    )
    r = anomaly_scores(silver).first()
    expected = 2.0 * 0.4 + 0.5 * 100 * 0.4 + (1 - 0.9) * 100 * 0.2
    assert abs(r["anomaly_severity"] - expected) < 1e-9
    assert r["severity_level"] == "ELEVATED"
    assert r["total_events"] == 2 and r["total_anomalies"] == 1


def test_kpi_windows_align_to_quarter_hours(spark):
    silver = spark.createDataFrame(
        [
            ("PLANT-A", "temperature", dt.datetime(2024, 1, 1, 10, 14, 59), 1.0, False, 1.0, 0.0),
            ("PLANT-A", "temperature", dt.datetime(2024, 1, 1, 10, 15, 0), 3.0, True, 0.5, 1.0),
            ("PLANT-A", "temperature", None, 3.0, True, 0.5, 1.0),
        ],
        "facility_id string, sensor_type string, timestamp timestamp, value double, "
        "is_anomaly boolean, quality_score double, z_score double",
    )
    out = aggregate_kpis(silver).orderBy("window_start").collect()
    assert len(out) == 2  # null event time falls out
    assert out[0]["window_start"] == dt.datetime(2024, 1, 1, 10, 0)
    assert out[1]["window_end"] == dt.datetime(2024, 1, 1, 10, 30)
    assert out[1]["anomaly_count"] == 1 and out[1]["stddev_value"] is None
    assert str(out[1]["kpi_date"]) == "2024-01-01"
