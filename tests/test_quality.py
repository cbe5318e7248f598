from __future__ import annotations

from pyspark.sql import functions as F

from conftest import bronze_rows, event
from sluice.config import REQUIRED_COLUMNS
from sluice.operators.profile import profile, profile_report, report_flags
from sluice.operators.quality import quality_checks, run_suite, schema_checks, suite_summary


def checks_by_name(df):
    return {r["check_name"]: r for r in df.collect()}


def test_schema_check_all_and_missing(spark):
    full = bronze_rows(spark, [event(1)])
    assert all(r["success"] for r in schema_checks(spark, full).collect())
    two = full.select("event_id", "value")
    res = schema_checks(spark, two).collect()
    assert len(res) == 7 and sum(not r["success"] for r in res) == 5


def test_empty_dataset_single_failure(spark):
    empty = bronze_rows(spark, [])
    got = quality_checks(empty).collect()
    assert [(r["check_name"], r["success"]) for r in got] == [("non_empty_dataset", False)]
    summary = suite_summary(run_suite(empty)).first()
    assert summary["total_checks"] == len(REQUIRED_COLUMNS) + 1 and summary["failed"] == 1


def test_summary_of_nothing_is_success(spark):
    empty = spark.createDataFrame([], "check_name string, success boolean")
    s = suite_summary(empty).first()
    assert s["success_rate"] == 1.0 and s["overall_success"] is True


def test_null_range_and_cv_rules(spark):
    rows = []
    # temperature: 100 rows, 1 null -> rate 0.01 passes (<=), 5 out of range -> 0.95 passes (>=)
    for i in range(100):
        v = None if i == 0 else (600.0 if i <= 5 else 20.0 + (i % 3))
        rows.append(event(i, stype="temperature", value=v))
    # pressure: negative mean with wide spread -> cv uses |mean| and fails
    for i, v in enumerate([-1.0, -1.0, -100.0, 50.0]):
        rows.append(event(1000 + i, stype="pressure", value=v))
    # vibration: mean 0 -> cv 0 passes
    for i, v in enumerate([-1.0, 1.0]):
        rows.append(event(2000 + i, stype="vibration", value=v))
    c = checks_by_name(quality_checks(bronze_rows(spark, rows)))
    assert c["null_check_temperature"]["success"] and c["null_check_temperature"]["observed_value"] == 0.01
    assert c["range_check_temperature"]["success"]
    assert c["range_check_temperature"]["observed_value"] == 0.95
    assert not c["statistical_check_pressure"]["success"]
    assert c["statistical_check_vibration"]["success"] and c["statistical_check_vibration"]["observed_value"] == 0.0
    assert "null_check_throughput" not in c  # types with no rows are skipped


def test_profile_map_column_nulls_and_distinct(spark):
    rows = [
        event(1, value=1.0, metadata={"k": "1"}),
        event(2, value=1.0, metadata={"k": "1"}),
        event(3, value=None, metadata=None),
        event(4, value=0.0, metadata={"k": "2"}),
    ]
    prof = {r["column_name"]: r for r in profile(bronze_rows(spark, rows)).collect()}
    assert prof["metadata"]["distinct_count"] == 3  # two maps + null
    assert prof["value"]["null_count"] == 1 and prof["value"]["distinct_count"] == 3
    assert prof["value"]["min"] == 0.0 and prof["sensor_id"]["mean"] is None
    approx = {r["column_name"]: r for r in profile(bronze_rows(spark, rows), exact=False).collect()}
    assert approx["value"]["distinct_count"] == 3


def test_profile_zero_mean_is_reported(spark):
    df = spark.createDataFrame([(0.0,), (0.0,)], "x double")
    r = profile(df).first()
    assert r["mean"] == 0.0 and r["stddev"] == 0.0


def test_report_thresholds(spark):
    prof = spark.createDataFrame(
        [("a", 0, 1000, 0.15, 4), ("b", 1, 1000, 0.01, 1000), ("c", 2, 1000, 0.05, 5)],
        "column_name string, position int, row_count long, null_rate double, distinct_count long",
    )
    flags = {r["column_name"]: r for r in report_flags(prof).collect()}
    assert flags["a"]["high_null"] and flags["a"]["low_cardinality"]
    assert not flags["b"]["high_null"] and not flags["b"]["low_cardinality"]
    assert not flags["c"]["high_null"] and flags["c"]["low_cardinality"]
    rep = profile_report(prof).first()
    assert rep["high_null_columns"] == ["a"]
    assert rep["low_cardinality_columns"] == ["a", "c"]
    assert len(rep["recommendations"]) == 2 and rep["total_rows"] == 1000
    none = profile_report(prof.filter(F.col("column_name") == "b")).first()
    assert none["recommendations"] == []


def test_profile_quantiles_are_exact_and_span_partitions(spark):
    import random

    values = [float(random.Random(1).randrange(500)) for _ in range(3)] + [float(i % 37) for i in range(4000)]
    values += [-0.0, 0.0, 1e9]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)] + [(None, -1)], "x double, k long")
    got = {r["column_name"]: r for r in profile(df).collect()}
    ranked = sorted(values)
    for name, fraction in (("p25", 0.25), ("median", 0.5), ("p75", 0.75)):
        assert got["x"][name] == ranked[max(1, -(-len(ranked) * fraction // 1).__int__()) - 1]
    assert got["x"]["distinct_count"] == len(set(values)) + 1
    assert got["k"]["distinct_count"] == len(values) + 1
    assert profile(df.limit(0)).filter("distinct_count = 0 and median is null").count() == 2


def test_day_sketches_merge_and_one_day_is_read_again_alone(spark, tmp_root):
    import datetime as dt
    import os
    import random
    import statistics

    from sluice.operators.day_profile import (
        DISTINCT_ERROR, RANK_ERROR, merged_profile, read_sketches, update_days,
    )

    rng = random.Random(1)
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    rows = [(rng.choice(days), rng.gauss(1e6, 3.0), f"k{rng.randrange(800)}", None if i % 7 else i) for i in range(6000)]
    schema = "day0 date, x double, k string, n long"
    table = f"{tmp_root}/t"
    spark.createDataFrame(rows, schema).write.partitionBy("day0").parquet(table)
    path = f"{tmp_root}/sketches"
    update_days(spark.read.parquet(table), "day0", path)
    before = {d: sorted(os.listdir(f"{path}/day={d}")) for d in days}
    # A day changes.
    more = [(days[1], 5.0, "new", 1)] * 500
    spark.createDataFrame(more, schema).write.mode("append").partitionBy("day0").parquet(table)
    changed = spark.read.parquet(table).filter(F.col("day0").isin([days[1]]))
    assert "PartitionFilters: [isnotnull(day0" in changed._jdf.queryExecution().executedPlan().toString()
    update_days(spark.read.parquet(table), "day0", path, [days[1]])
    after = {d: sorted(os.listdir(f"{path}/day={d}")) for d in days}
    assert [d for d in days if before[d] != after[d]] == [days[1]]
    part = [r for r in rows + more if r[0] in days[1:]]
    got = {
        r["column_name"]: r
        for r in merged_profile(read_sketches(spark, path).filter(F.col("day") >= days[1])).collect()
    }
    xs = sorted(r[1] for r in part)
    assert got["x"]["row_count"] == len(part) and got["x"]["min"] == xs[0] and got["x"]["max"] == xs[-1]
    assert abs(got["x"]["mean"] - statistics.fmean(xs)) < 1e-6
    assert abs(got["x"]["stddev"] - statistics.stdev(xs)) < 1e-6 * statistics.stdev(xs)
    for name, fraction in (("p25", 0.25), ("median", 0.5), ("p75", 0.75)):
        rank = sum(x <= got["x"][name] for x in xs) / len(xs)
        assert abs(rank - fraction) <= RANK_ERROR + sum(x == got["x"][name] for x in xs) / len(xs)
    for c, i in (("k", 2), ("n", 3)):
        exact = len({r[i] for r in part})
        assert abs(got[c]["distinct_count"] - exact) <= DISTINCT_ERROR * exact + 1
    assert got["n"]["null_count"] == sum(r[3] is None for r in part)
    assert got["k"]["median"] is None and got["k"]["mean"] is None
