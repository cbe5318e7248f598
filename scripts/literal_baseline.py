"""Times of a literal, one-action-per-question rendering of the reference's steps.

The reference publishes no timings. This script runs its silver, gold, quality
and profile steps the plain way (one window per sensor, one job per check and
per column, every table from its own scan) beside this library's operators, on
the same tables and session, and prints one JSON line.

usage: python scripts/literal_baseline.py [sf_dir]
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrame, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from sluice.config import DEFAULT_CONFIG  # noqa: E402
from sluice.operators.aggregate import aggregate_kpis, anomaly_scores  # noqa: E402
from sluice.operators.profile import profile  # noqa: E402
from sluice.operators.quality import run_suite  # noqa: E402
from sluice.plans.queries import silver_frame  # noqa: E402
from sluice.session import build_session  # noqa: E402
from sluice.sources.fixtures import fixture_events, load_table  # noqa: E402


def literal_silver(bronze: DataFrame) -> DataFrame:
    first = Window.partitionBy("event_id").orderBy("ingestion_timestamp")
    frame = Window.partitionBy("sensor_id", "sensor_type").orderBy("timestamp").rowsBetween(-99, 0)
    rows = bronze.withColumn("n", F.row_number().over(first)).filter("n = 1").drop("n")
    rows = rows.fillna({"quality_score": 1.0, "is_anomaly": False}).filter("value is not null")
    mean, spread = F.avg("value").over(frame), F.stddev("value").over(frame)
    return rows.withColumn(
        "z_score", F.when(spread > 0, (F.col("value") - mean) / spread).otherwise(0.0)
    )


def literal_quality(bronze: DataFrame) -> int:
    """One job per check and sensor type."""
    done = 0
    for kind, limits in DEFAULT_CONFIG.sensor_limits.items():
        rows = bronze.filter(F.col("sensor_type") == kind)
        rows.count()
        rows.filter("value is null").count()
        rows.filter((F.col("value") < limits.min_value) | (F.col("value") > limits.max_value)).count()
        rows.agg(F.avg("value"), F.stddev("value")).first()
        done += 4
    return done


def literal_profile(table: DataFrame) -> int:
    """Three jobs per column."""
    table.count()
    for field in table.schema.fields:
        table.filter(F.col(field.name).isNull()).count()
        table.select(field.name).distinct().count()
        if field.dataType.typeName() in ("double", "integer", "long"):
            table.agg(F.min(field.name), F.max(field.name), F.avg(field.name)).first()
            table.approxQuantile(field.name, [0.25, 0.5, 0.75], 0.0)
    return len(table.columns)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", "literal-baseline")
    out: dict[str, dict[str, float]] = {}

    def timed(step: str, side: str, job) -> None:
        start = time.perf_counter()
        job()
        out.setdefault(step, {})[side] = round(time.perf_counter() - start, 2)

    for where in ("/root/testdata/sf0.001", sf_dir):  # the first round only warms up
        bronze = fixture_events(spark, where)
        lineitem = load_table(spark, where, "lineitem")
        silver = literal_silver(bronze)
        timed("severity", "literal", lambda s=silver: run(anomaly_scores(s)))
        timed("severity", "ours", lambda w=where: run(anomaly_scores(silver_frame(spark, w))))
        timed("kpis", "literal", lambda s=silver: run(aggregate_kpis(s)))
        timed("kpis", "ours", lambda w=where: run(aggregate_kpis(silver_frame(spark, w))))
        timed("quality", "literal", lambda b=bronze: literal_quality(b))
        timed("quality", "ours", lambda b=bronze: run(run_suite(b)))
        timed("profile", "literal", lambda t=lineitem: literal_profile(t))
        timed("profile", "ours", lambda t=lineitem: run(profile(t)))
    spark.stop()
    print(json.dumps({"sf_dir": sf_dir, "seconds": out}))


if __name__ == "__main__":
    main()
