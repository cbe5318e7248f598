"""Column expressions shared by batch and streaming operators.

Each returns a ``Column`` built only from Spark built-ins, so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.config import DEFAULT_CONFIG, LakeConfig


def z_score(value: str = "value", mean: str = "rolling_mean", stddev: str = "rolling_stddev") -> Column:
    """PRJ9: (value - mean) / stddev when stddev > 0, else 0.0 (null stddev -> 0.0)."""
    return F.when(F.col(stddev) > 0, (F.col(value) - F.col(mean)) / F.col(stddev)).otherwise(
        F.lit(0.0)
    )


def hour_of_day(ts: str = "timestamp") -> Column:
    """PRJ10: 0-23 in the session time zone (UTC)."""
    return F.hour(ts)


def day_of_week(ts: str = "timestamp") -> Column:
    """PRJ11: 1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(ts)


def is_business_hours(
    hour: str = "hour_of_day", dow: str = "day_of_week", config: LakeConfig = DEFAULT_CONFIG
) -> Column:
    """PRJ12: hour in [8, 17] and weekday in [2, 6], both inclusive."""
    h0, h1 = config.business_hours
    d0, d1 = config.business_days
    return F.col(hour).between(h0, h1) & F.col(dow).between(d0, d1)


def severity(
    avg_abs_z: str = "avg_abs_z_score",
    anomaly_rate: str = "anomaly_rate",
    avg_quality: str = "avg_quality",
    config: LakeConfig = DEFAULT_CONFIG,
) -> Column:
    """PRJ15: weighted blend of z magnitude, anomaly rate and quality loss."""
    wz, wa, wq = config.severity_weights
    return (
        F.col(avg_abs_z) * wz
        + F.col(anomaly_rate) * 100 * wa
        + (1 - F.col(avg_quality)) * 100 * wq
    )


def severity_level(score: str = "anomaly_severity", config: LakeConfig = DEFAULT_CONFIG) -> Column:
    """PRJ16: strict ``>`` cut-offs, highest first."""
    expr = None
    for cutoff, label in config.severity_levels:
        cond = F.col(score) > cutoff
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(config.severity_default_level)


def freshness_status(lag_minutes: Column, config: LakeConfig = DEFAULT_CONFIG) -> Column:
    """SLA1: null lag -> unknown."""
    limit = config.freshness_minutes
    return (
        F.when(lag_minutes.isNull(), "unknown")
        .when(lag_minutes <= limit, "compliant")
        .when(lag_minutes <= limit * config.freshness_warning_factor, "warning")
        .otherwise("violated")
    )


def completeness_status(percent: Column, config: LakeConfig = DEFAULT_CONFIG) -> Column:
    """SLA2."""
    limit = config.completeness_percent
    return (
        F.when(percent >= limit, "compliant")
        .when(percent >= limit * config.completeness_warning_factor, "warning")
        .otherwise("violated")
    )
