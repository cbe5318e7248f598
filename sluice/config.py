"""Pipeline configuration: one frozen dataclass passed as an argument.

Everything the operators need (thresholds, partition layouts, window sizes)
lives here so a job is reproducible from its arguments alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType
from typing import Mapping

# ---------------------------------------------------------------------------
# Fixed values. These must equal the behaviour being reproduced for results to
# match; they are stated plainly and together on purpose.
#
#   sensor types, in order:   temperature, vibration, pressure, throughput
#   units, same order:        celsius, mm/s, bar, units/hr
#   value ranges and null thresholds per type:
#       temperature  min -50.0  max   500.0  null threshold 0.01
#       vibration    min   0.0  max   100.0  null threshold 0.02
#       pressure     min   0.0  max  1000.0  null threshold 0.01
#       throughput   min   0.0  max 10000.0  null threshold 0.05
#   default null threshold for an unlisted type: 0.05
#   required event columns: event_id, sensor_id, sensor_type, facility_id,
#                           timestamp, value, unit
#   null defaults in silver: quality_score -> 1.0, is_anomaly -> false
#   rolling frame: the current row and the 99 rows before it (100 rows)
#   business hours: hour 8..17 inclusive, day_of_week 2..6 (1 = Sunday)
#   severity = 0.4 * avg_abs_z + 0.4 * 100 * anomaly_rate
#              + 0.2 * 100 * (1 - avg_quality)
#   severity levels (strictly greater than): 50 CRITICAL, 25 WARNING,
#                                            10 ELEVATED, else NORMAL
#   range check passes when in-range rate >= 0.95
#   statistical check passes when coefficient of variation < 100
#   profile report: high null rate > 0.05, low cardinality <= 5 distinct
#   freshness: <= 30 min compliant, <= 30 * 1.5 warning, else violated
#   completeness: >= 95 % compliant, >= 95 * 0.9 warning, else violated
#   bronze provenance literals: source 'kafka', pipeline_version '1.0.0'
#   KPI tumbling window: 15 minutes; stream dedup window 24 h; retention 90 days
# ---------------------------------------------------------------------------

SENSOR_TYPES: tuple[str, ...] = ("temperature", "vibration", "pressure", "throughput")
SENSOR_UNITS: Mapping[str, str] = MappingProxyType(
    {"temperature": "celsius", "vibration": "mm/s", "pressure": "bar", "throughput": "units/hr"}
)
REQUIRED_COLUMNS: tuple[str, ...] = (
    "event_id",
    "sensor_id",
    "sensor_type",
    "facility_id",
    "timestamp",
    "value",
    "unit",
)
DEFAULT_NULL_THRESHOLD = 0.05
NULL_DEFAULTS: tuple[tuple[str, float | bool], ...] = (("quality_score", 1.0), ("is_anomaly", False))
TRIMMED_COLUMNS: tuple[str, ...] = ("sensor_id", "facility_id")
SOURCE_LITERAL = "kafka"
PIPELINE_VERSION = "1.0.0"


@dataclass(frozen=True)
class SensorLimits:
    """Quality thresholds of one sensor type."""

    min_value: float | None = None
    max_value: float | None = None
    null_threshold: float = DEFAULT_NULL_THRESHOLD


DEFAULT_LIMITS: Mapping[str, SensorLimits] = MappingProxyType(
    {
        "temperature": SensorLimits(-50.0, 500.0, 0.01),
        "vibration": SensorLimits(0.0, 100.0, 0.02),
        "pressure": SensorLimits(0.0, 1000.0, 0.01),
        "throughput": SensorLimits(0.0, 10000.0, 0.05),
    }
)


@dataclass(frozen=True)
class LakeConfig:
    """All tunables of the pipeline. Immutable; copy with ``dataclasses.replace``."""

    sensor_limits: Mapping[str, SensorLimits] = field(default_factory=lambda: DEFAULT_LIMITS)
    bronze_partitions: tuple[str, ...] = ("event_date", "sensor_type")
    silver_partitions: tuple[str, ...] = ("event_date", "facility_id")
    kpi_partitions: tuple[str, ...] = ("kpi_date", "facility_id")
    severity_partitions: tuple[str, ...] = ("facility_id",)
    retention_days: int = 90
    # Watermark of the streaming dedup; batch dedup across loads is exact.
    dedup_window_hours: int = 24
    # Hash buckets of the index of seen event ids (fixed when a table is first loaded).
    # About 1 GB of ids a bucket: 16 for 4e8 events, 8192 for 2e11.
    key_buckets: int = 16
    # Incremental silver reads rolling history from the last N days of silver
    # partitions first; sensors with fewer rows there fall back to older ones.
    history_days: int = 2
    kpi_window_minutes: int = 15
    rolling_rows: int = 100
    # Rolling frames are computed on position chunks of at most this many rows
    # per sensor, so a hot sensor spreads over many tasks (see operators.enrich).
    rolling_chunk_rows: int = 1 << 18
    # How a sensor's rows are numbered: "range" (range-partitioned, skew-proof)
    # or "bucket" (row_number inside time buckets of ``rolling_bucket``).
    rolling_numbering: str = "range"
    rolling_bucket: str = "hour"
    freshness_minutes: float = 30.0
    freshness_warning_factor: float = 1.5
    completeness_percent: float = 95.0
    completeness_warning_factor: float = 0.9
    in_range_pass_rate: float = 0.95
    max_cv_percent: float = 100.0
    high_null_rate: float = 0.05
    low_cardinality: int = 5
    # Severity weights and level cut-offs (see the fixed-values block above).
    severity_weights: tuple[float, float, float] = (0.4, 0.4, 0.2)
    severity_levels: tuple[tuple[float, str], ...] = (
        (50.0, "CRITICAL"),
        (25.0, "WARNING"),
        (10.0, "ELEVATED"),
    )
    severity_default_level: str = "NORMAL"
    business_hours: tuple[int, int] = (8, 17)
    business_days: tuple[int, int] = (2, 6)

    @property
    def sensor_types(self) -> tuple[str, ...]:
        return tuple(self.sensor_limits.keys())


DEFAULT_CONFIG = LakeConfig()
