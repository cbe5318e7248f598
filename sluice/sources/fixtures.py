"""Adapter from the driver's ``events`` table to raw sensor events.

A deterministic projection (plus one filtered copy for re-sent events) that
plants every defect the pipeline must handle: padded facility ids, null values
and scores, an unknown sensor type, and duplicate deliveries that arrive an
hour later with a different value. The same rules are written as SQL in
``sluice.plans.oracle`` so DuckDB can repeat them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from sluice.operators.ingest import to_bronze
from sluice.session import ensure_utc

# Fixed values of the adapter (see FIXTURES.md):
#   event type -> sensor type: click temperature, view vibration,
#                              purchase pressure, signup throughput,
#                              anything else 'unknown'
#   sensor type -> unit:       celsius, mm/s, bar, units/hr, else 'unknown'
#   facility by user_id mod 3: 0 PLANT-A, 1 PLANT-B, 2 PLANT-C
#   sensor id: 'S-' || user_id mod 10
#   padded facility when event_id mod 5 = 0; null value when mod 97 = 0;
#   null quality_score when mod 10 = 0, else (100 - event_id mod 40) / 100;
#   null is_anomaly when mod 13 = 0, else value > 150;
#   ingestion_timestamp = ts + (event_id mod 60) seconds;
#   re-sent copy when event_id mod 20 = 0: value + 1, ingestion + 1 hour.
EVENT_TYPE_TO_SENSOR = (
    ("click", "temperature"),
    ("view", "vibration"),
    ("purchase", "pressure"),
    ("signup", "throughput"),
)
SENSOR_TO_UNIT = (
    ("temperature", "celsius"),
    ("vibration", "mm/s"),
    ("pressure", "bar"),
    ("throughput", "units/hr"),
)
FACILITIES = ("PLANT-A", "PLANT-B", "PLANT-C")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table, as it is laid out."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(column, pairs, default):
    expr = None
    for key, val in pairs:
        expr = F.when(column == key, val) if expr is None else expr.when(column == key, val)
    return expr.otherwise(default)


def sensor_events(events: DataFrame, with_resends: bool = True) -> DataFrame:
    """``events`` -> raw sensor events (event schema + ``ingestion_timestamp``)."""
    eid = F.col("event_id")
    sensor_type = _case(F.col("event_type"), EVENT_TYPE_TO_SENSOR, F.lit("unknown"))
    facility = _case(F.pmod(F.col("user_id"), F.lit(3)), list(enumerate(FACILITIES)), F.lit(None))
    value = F.when(F.pmod(eid, F.lit(97)) == 0, F.lit(None).cast("double")).otherwise(
        F.col("value")
    )
    base = events.select(
        eid.cast("string").alias("event_id"),
        F.concat(F.lit("S-"), F.pmod(F.col("user_id"), F.lit(10)).cast("string")).alias(
            "sensor_id"
        ),
        sensor_type.alias("sensor_type"),
        F.when(
            F.pmod(eid, F.lit(5)) == 0, F.concat(F.lit(" "), facility, F.lit(" "))
        )
        .otherwise(facility)
        .alias("facility_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        value.alias("value"),
        F.when(F.pmod(eid, F.lit(10)) == 0, F.lit(None).cast("double"))
        .otherwise((F.lit(100) - F.pmod(eid, F.lit(40))) / F.lit(100.0))
        .alias("quality_score"),
        F.when(F.pmod(eid, F.lit(13)) == 0, F.lit(None).cast("boolean"))
        .otherwise(value > 150)
        .alias("is_anomaly"),
        F.from_json(F.col("props"), MapType(StringType(), StringType())).alias("metadata"),
        (F.col("ts").cast("timestamp") + F.make_interval(secs=F.pmod(eid, F.lit(60)))).alias(
            "ingestion_timestamp"
        ),
        eid.alias("_src_id"),
    ).withColumn("unit", _case(F.col("sensor_type"), SENSOR_TO_UNIT, F.lit("unknown")))
    if with_resends:
        resent = base.filter(F.pmod(F.col("_src_id"), F.lit(20)) == 0).select(
            *[
                (F.col("value") + 1).alias("value")
                if c == "value"
                else (F.col(c) + F.expr("INTERVAL 1 HOUR")).alias(c)
                if c == "ingestion_timestamp"
                else F.col(c)
                for c in base.columns
            ]
        )
        base = base.unionByName(resent)
    return base.drop("_src_id")


def fixture_events(spark: SparkSession, sf_dir: str, with_resends: bool = True) -> DataFrame:
    """Raw sensor events of ``sf_dir`` shaped as bronze rows (batch path)."""
    ensure_utc(spark)
    raw = sensor_events(load_table(spark, sf_dir, "events"), with_resends=with_resends)
    return to_bronze(raw)
