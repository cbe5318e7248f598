"""Plan-shape checks: the properties the design relies on at scale."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SMOKE
from sluice.operators.dedup import dedup_first
from sluice.operators.ingest import parse_records, validate_events
from sluice.operators.profile import profile
from sluice.operators.quality import quality_checks
from sluice.plans.queries import QUERIES
from sluice.sources.fixtures import fixture_events, load_table
from sluice.sources.kafka import to_kafka_records


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_before_the_shuffle(spark):
    p = plan(dedup_first(fixture_events(spark, SMOKE)))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_profile_has_no_row_expansion(spark):
    p = plan(profile(load_table(spark, SMOKE, "lineitem")))
    assert "Expand" not in p


def test_quality_checks_single_grouped_scan(spark):
    p = plan(quality_checks(fixture_events(spark, SMOKE)))
    assert "Expand" not in p and "BroadcastNestedLoopJoin" not in p


def test_parse_is_not_repeated_in_filters(spark):
    recs = to_kafka_records(fixture_events(spark, SMOKE))
    p = plan(validate_events(parse_records(recs)))
    filters = [line for line in p.splitlines() if "Filter" in line]
    assert filters and not any("from_json" in line for line in filters)


def test_no_cross_or_nested_loop_joins_in_registered_queries(spark):
    for name in ("severity_daily", "kpi_15min", "quality_suite", "profile_report", "gold_stats"):
        p = plan(QUERIES[name](spark, SMOKE))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = load_table(spark, SMOKE, "events").filter(F.col("value") > 100).select("event_id")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,100.0)]" in p
    assert "ReadSchema: struct<event_id:bigint,value:double>" in p
