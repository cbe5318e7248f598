from __future__ import annotations

import json

from pyspark.sql import functions as F

from conftest import bronze_rows, event
from sluice.operators.ingest import (
    parse_records,
    split_contract,
    to_bronze,
    validate_events,
    violation_counts,
    with_violations,
)
from sluice.sources.kafka import to_kafka_records


def records(spark, payloads):
    rows = [(p if isinstance(p, str) else json.dumps(p),) for p in payloads]
    return spark.createDataFrame(rows, "value string").withColumn("value", F.col("value").cast("binary"))


GOOD = {
    "event_id": "r-17", "sensor_id": "P-4", "sensor_type": "pressure", "facility_id": "PLANT-C",
    "timestamp": "2023-06-30T23:15:42.123456Z", "value": 6.25, "unit": "bar", "quality_score": 0.5,
    "is_anomaly": True, "metadata": {"line": "7", "shift": "night"},
}


def test_parse_and_validate_drop_malformed_and_bad_values(spark):
    bad_value = dict(GOOD, event_id="e2", value="not-a-number")
    spaced = dict(GOOD, event_id="e3", timestamp="2024-01-01 10:00:00.5")
    unknown = dict(GOOD, event_id="e4", sensor_type="invalid_type")
    whole = dict(GOOD, event_id="n1", timestamp=1704067200)
    part = dict(GOOD, event_id="n2", timestamp=1704067200.25)
    df = parse_records(records(spark, [GOOD, "{not json", bad_value, spaced, unknown, whole, part]))
    rows = {r["event_id"]: r for r in df.collect() if r["event_id"]}
    assert rows["r-17"]["timestamp"].microsecond == 123456
    assert rows["r-17"]["metadata"] == {"line": "7", "shift": "night"}
    assert rows["e3"]["timestamp"].microsecond == 500000
    kept = sorted(r["event_id"] for r in validate_events(df).collect())
    # malformed JSON -> all null; text value -> null value; unknown type rejected
    assert kept == ["e3", "n1", "n2", "r-17"]
    assert str(rows["n1"]["timestamp"]) == "2024-01-01 00:00:00"
    assert str(rows["n2"]["timestamp"]) == "2024-01-01 00:00:00.250000"


def test_contract_rules(spark):
    df = parse_records(
        records(
            spark,
            [
                GOOD,
                dict(GOOD, event_id="q1", quality_score=1.5),
                dict(GOOD, event_id="q2", quality_score=-0.1),
                dict(GOOD, event_id="t1", sensor_type="invalid_type"),
                {"event_id": "only"},
                {},
                {k: v for k, v in GOOD.items() if k not in ("quality_score", "is_anomaly")} | {"event_id": "d1"},
            ],
        )
    )
    v = {r["event_id"]: r["violations"] for r in with_violations(df).collect()}
    assert v["r-17"] == []
    assert v["q1"] == ["quality_score_out_of_range"]
    assert v["q2"] == ["quality_score_out_of_range"]
    assert v["t1"] == ["invalid_sensor_type"]
    assert len(v["only"]) == 6
    assert len(v[None]) == 7
    valid, quarantine = split_contract(df)
    got = {r["event_id"]: r for r in valid.collect()}
    assert set(got) == {"r-17", "d1"}
    assert got["d1"]["quality_score"] == 1.0 and got["d1"]["is_anomaly"] is False
    assert quarantine.count() == 5
    counts = {r["rule"]: r["row_count"] for r in violation_counts(df).collect()}
    assert counts["valid"] == 2 and counts["quality_score_out_of_range"] == 2


def test_json_roundtrip_keeps_microseconds_and_key(spark):
    raw = bronze_rows(spark, [event(1, t="2024-01-01 00:00:00.000001"), event(2, sensor=None)])
    recs = to_kafka_records(raw)
    keys = sorted(r["key"] for r in recs.collect())
    assert keys == ["S-1", "unknown"]
    back = parse_records(recs).orderBy("event_id").collect()
    assert back[0]["timestamp"].microsecond == 1


def test_to_bronze_stamps(spark):
    raw = bronze_rows(spark, [event(1, t="2024-03-05 23:59:59")]).drop(
        "event_date", "source", "pipeline_version"
    )
    row = to_bronze(raw).first()
    assert str(row["event_date"]) == "2024-03-05"
    assert row["source"] == "kafka" and row["pipeline_version"] == "1.0.0"


def test_kafka_options_without_a_broker(spark):
    from pyspark.errors import AnalysisException

    from sluice.sources.kafka import read_kafka_stream, sink_options, source_options, write_kafka

    assert source_options("b:1", "t") == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "earliest", "failOnDataLoss": "false",
    }
    assert source_options("b:1", "t", {"maxOffsetsPerTrigger": "9", "startingOffsets": "latest"}) == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "latest", "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "9",
    }
    assert sink_options("b:1", "t", {"kafka.retries": "5"}) == {
        "kafka.bootstrap.servers": "b:1", "topic": "t", "kafka.compression.type": "gzip", "kafka.acks": "all",
        "kafka.retries": "5",
    }
    # Without the connector Spark names what is missing.
    for call in (lambda: read_kafka_stream(spark, "b:1", "t"), lambda: write_kafka(spark.range(1).selectExpr("'s' sensor_id", "'e' event_id"), "b:1", "t")):
        try:
            call()
            raise AssertionError("no connector is installed here")
        except AnalysisException as missing:
            assert "kafka" in str(missing).lower()
