"""Layer tables: scans (SRC2-5), sinks (SNK2-5), predicates (FIL5-8) and stats (AGG3-6).

Every read declares its schema (no inference: a facility named "001" stays a
string, an empty table stays readable). Date/equality predicates on partition
columns become ``PartitionFilters`` so only matching directories are listed
and read. Row counts come from ``DataFrame.observe`` on the write itself, not
from a second job.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.schema import BRONZE_SCHEMA, KPI_SCHEMA, SEVERITY_SCHEMA, SILVER_SCHEMA
from sluice.sources.journal import Journal
from sluice.session import delete_path, list_dirs, path_exists, read_text


@dataclass(frozen=True)
class LakePaths:
    """Folder layout of one lakehouse below ``root`` (any Hadoop URI)."""

    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._p("bronze")

    @property
    def silver(self) -> str:
        return self._p("silver")

    @property
    def kpis(self) -> str:
        return self._p("gold", "kpis")

    @property
    def severity(self) -> str:
        return self._p("gold", "anomaly_scores")

    @property
    def lineage(self) -> str:
        return self._p("governance", "lineage")

    @property
    def sla_checks(self) -> str:
        return self._p("governance", "sla_checks")

    def checkpoint(self, name: str) -> str:
        return self._p("_checkpoints", name)


# ---------------------------------------------------------------------------
# Reads
# ---------------------------------------------------------------------------


def _as_date(value: str | dt.date | None) -> dt.date | None:
    if value is None or value == "":
        return None
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Schema-declared Parquet scan; a missing or empty table reads as zero rows."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def date_range(
    df: DataFrame, column: str, start: str | dt.date | None, end: str | dt.date | None
) -> DataFrame:
    """FIL5: inclusive ``start <= column <= end`` with typed date literals."""
    start_d, end_d = _as_date(start), _as_date(end)
    if start_d is not None:
        df = df.filter(F.col(column) >= F.lit(start_d))
    if end_d is not None:
        df = df.filter(F.col(column) <= F.lit(end_d))
    return df


def equals(df: DataFrame, column: str, value) -> DataFrame:
    """FIL6: equality predicate, skipped when ``value`` is empty."""
    if value is None or value == "":
        return df
    if column.endswith("_date"):
        value = _as_date(value)
    return df.filter(F.col(column) == F.lit(value))


def stream_part(path: str) -> str:
    """Folder of a bronze table's streamed rows, one sub-folder per micro-batch."""
    return f"{path.rstrip('/')}_stream"


def bronze_roots(path: str) -> tuple[str, str]:
    """Both parts of a bronze table: batch loads and streamed rows. Each write is a
    folder ``batch=<id>`` of its own below one of them."""
    return path.rstrip("/"), stream_part(path)


def bronze_batches(spark: SparkSession, path: str) -> dict[str, str]:
    """Folder of each finished write of a bronze table by its id (names only: the
    folders are listed, no file is read). A write is finished when it left ``_SUCCESS``."""
    out = {}
    for root in bronze_roots(path):
        for name in list_dirs(spark, root):
            if name.startswith("batch=") and path_exists(spark, f"{root}/{name}/_SUCCESS"):
                out[name.removeprefix("batch=")] = f"{root}/{name}"
    return out


def replaced_days(spark: SparkSession, path: str) -> set[tuple[str, str]]:
    """(batch, day) folders whose rows a committed fold holds already (see
    :mod:`sluice.streaming.folding`); empty but while a fold is being cleaned up."""
    out: set[tuple[str, str]] = set()
    root = path.rstrip("/")
    for name in list_dirs(spark, root):
        if name.startswith("batch=fold-") and path_exists(spark, f"{root}/{name}/_folded.json"):
            listed = json.loads(read_text(spark, f"{root}/{name}/_folded.json"))
            out |= {(b, d) for b, d in listed}
    return out


def read_bronze_folders(
    spark: SparkSession, path: str, folders: Sequence[str], hidden: set[tuple[str, str]] = frozenset()
) -> DataFrame:
    """Rows of some batch folders of a bronze table, without hidden (batch, day) folders;
    only these folders are listed."""
    parts = []
    for root in bronze_roots(path):
        mine = []
        for folder in folders:
            if not folder.startswith(f"{root}/batch="):
                continue
            batch = folder.rsplit("/batch=", 1)[1]
            away = {d for b, d in hidden if b == batch}
            if away:
                days = [n for n in list_dirs(spark, folder) if n.startswith("event_date=")]
                mine += [f"{folder}/{n}" for n in days if n.removeprefix("event_date=") not in away]
            else:
                mine.append(folder)
        if mine:
            read = spark.read.schema(BRONZE_SCHEMA).option("basePath", root).parquet(*mine)
            parts.append(read.select(BRONZE_SCHEMA.fieldNames()))
    if not parts:
        return spark.createDataFrame([], BRONZE_SCHEMA)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_bronze(
    spark: SparkSession,
    path: str,
    start_date: str | dt.date | None = None,
    end_date: str | dt.date | None = None,
    sensor_type: str | None = None,
) -> DataFrame:
    """SRC2 + FIL5/FIL6: batch loads and streamed rows of one table (partition pruned
    on event_date and sensor_type in both)."""
    hidden = replaced_days(spark, path)
    if hidden:
        df = read_bronze_folders(spark, path, list(bronze_batches(spark, path).values()), hidden)
    else:
        parts = []
        for root in bronze_roots(path):
            if path_exists(spark, root):
                read = spark.read.schema(BRONZE_SCHEMA).parquet(root)
                parts.append(read.select(BRONZE_SCHEMA.fieldNames()))
        if not parts:
            return spark.createDataFrame([], BRONZE_SCHEMA)
        df = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return equals(date_range(df, "event_date", start_date, end_date), "sensor_type", sensor_type)


def read_silver(
    spark: SparkSession,
    path: str,
    start_date: str | dt.date | None = None,
    end_date: str | dt.date | None = None,
    facility_id: str | None = None,
) -> DataFrame:
    """SRC3 + FIL5/FIL6 (partition pruned on event_date and facility_id)."""
    df = read_table(spark, path, SILVER_SCHEMA)
    return equals(date_range(df, "event_date", start_date, end_date), "facility_id", facility_id)


def read_kpis(
    spark: SparkSession, path: str, facility_id: str | None = None, kpi_date=None
) -> DataFrame:
    """SRC4 + FIL6."""
    df = read_table(spark, path, KPI_SCHEMA)
    return equals(equals(df, "facility_id", facility_id), "kpi_date", kpi_date)


def read_severity(spark: SparkSession, path: str, facility_id: str | None = None) -> DataFrame:
    """SRC5 + FIL6."""
    return equals(read_table(spark, path, SEVERITY_SCHEMA), "facility_id", facility_id)


# ---------------------------------------------------------------------------
# Writes
# ---------------------------------------------------------------------------


def write_partitioned(
    df: DataFrame,
    path: str,
    partitions: Sequence[str],
    mode: str = "append",
    dynamic_overwrite: bool = False,
    name: str = "rows_written",
) -> int:
    """SNK2-5: one write job; the row count is observed during that same job.

    Rows are clustered by the partition columns with a REBALANCE hint, so each
    task writes few files per directory (the small-files problem of per-batch
    appends), while AQE splits a hot directory (one day holding a third of the
    rows) across several tasks and merges tiny ones.
    """
    return write_observed(df, path, partitions, mode, dynamic_overwrite, name)["n"]


def write_observed(
    df: DataFrame,
    path: str,
    partitions: Sequence[str],
    mode: str = "append",
    dynamic_overwrite: bool = False,
    name: str = "rows_written",
    metrics: Mapping[str, Column] | None = None,
) -> dict:
    """:func:`write_partitioned` that also observes ``metrics`` (name -> aggregate).

    Returns ``{"n": rows, **metrics}``; metrics are None when nothing was written.
    """
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("n")] + [e.alias(k) for k, e in (metrics or {}).items()]
    observed = df.observe(obs, *exprs)
    if partitions:
        observed = observed.hint("rebalance", *partitions)
    writer = observed.write.mode(mode)
    if dynamic_overwrite:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)
    if observed_count(obs) == 0:
        return {"n": 0, **{k: None for k in (metrics or {})}}
    got = obs.get
    return {"n": int(got.get("n") or 0), **{k: got.get(k) for k in (metrics or {})}}


class InputCount:
    """Rows that a job reads, counted by the job itself (AGG13): wrap the input, run the
    job, then ask."""

    def __init__(self, name: str) -> None:
        self._seen: list[Observation] = []
        self.name = name

    def of(self, df: DataFrame) -> DataFrame:
        self._seen.append(Observation(f"{self.name}-{len(self._seen)}"))
        return df.observe(self._seen[-1], F.count(F.lit(1)).alias("n"))

    def total(self) -> int:
        return sum(observed_count(o) for o in self._seen)


def observed_count(obs: Observation, key: str = "n") -> int:
    """The observed row count; 0 when Spark pruned the observation away.

    When AQE proves a plan empty it replaces it (metrics node included) with an
    empty relation; the observation then holds an empty, schema-less row.
    """
    jrow = obs._jo.getRow()
    if jrow.length() == 0:
        return 0
    return int(obs.get.get(key, 0) or 0)


# ---------------------------------------------------------------------------
# Stats (each a single aggregate job)
# ---------------------------------------------------------------------------


def bronze_stats(df: DataFrame) -> DataFrame:
    """AGG3: rows and date range per sensor type, plus a total row (sensor_type null).

    One grouped pass; the total row is a global aggregate over the small
    per-type table, so it exists (with 0 rows) even for an empty table.
    """
    per_type = df.groupBy("sensor_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("event_date").alias("min_event_date"),
        F.max("event_date").alias("max_event_date"),
    )
    total = per_type.agg(
        F.lit(None).cast("string").alias("sensor_type"),
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("long").alias("row_count"),
        F.min("min_event_date").alias("min_event_date"),
        F.max("max_event_date").alias("max_event_date"),
        F.lit(True).alias("is_total"),
    )
    return per_type.withColumn("is_total", F.lit(False)).unionByName(total)


def silver_stats(df: DataFrame) -> DataFrame:
    """AGG4: one row: rows, mean quality, anomaly rate (null -> 0)."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.coalesce(F.avg("quality_score"), F.lit(0.0)).alias("avg_quality_score"),
        F.coalesce(F.avg(F.col("is_anomaly").cast("double")), F.lit(0.0)).alias("anomaly_rate"),
    )


def gold_stats(kpis: DataFrame, severity: DataFrame) -> DataFrame:
    """AGG5: KPI rows, severity rows and distinct facilities in one pass, no join.

    The facility list itself is :func:`gold_facilities` (rows, not an array
    gathered into one task).
    """
    both = kpis.select(F.lit(True).alias("_kpi"), "facility_id").unionByName(
        severity.select(F.lit(False).alias("_kpi"), F.lit(None).cast("string").alias("facility_id"))
    )
    return both.agg(
        F.count_if(F.col("_kpi")).alias("total_kpi_rows"),
        F.count_if(~F.col("_kpi")).alias("total_anomaly_rows"),
        F.count_distinct(F.when(F.col("_kpi"), F.col("facility_id"))).alias("facility_count"),
    )


def gold_facilities(kpis: DataFrame) -> DataFrame:
    """SET1: distinct facilities present in the KPI table."""
    return kpis.select("facility_id").distinct()


def read_high_water_mark(df: DataFrame, column: str = "ingestion_timestamp", at_least=None):
    """AGG6: the largest ``column`` value, one scalar to the driver.

    ``at_least`` is a known lower bound (e.g. the mark recorded by the last
    run): only rows above it are aggregated, and the pushed-down predicate lets
    Parquet skip every row group whose statistics lie below it, so the scan
    touches just what was written since. Without a bound the column is
    scanned in full.
    """
    if at_least is None:
        return df.agg(F.max(column).alias("mark")).first()["mark"]
    bound = F.lit(at_least).cast("timestamp")
    newer = df.filter(F.col(column) > bound).agg(F.max(column).alias("mark")).first()["mark"]
    return newer if newer is not None else at_least


def marks_path(table_path: str) -> str:
    """Sibling folder with the journal of the runs that wrote a table."""
    return f"{table_path.rstrip('/')}_marks"


def recorded_mark(spark: SparkSession, table_path: str) -> dt.datetime | None:
    """Largest ingestion time that the recorded runs wrote (a lower bound of the table's
    true mark), or None."""
    state = Journal(spark, marks_path(table_path)).state()
    mark = (state or {}).get("mark")
    return dt.datetime.fromisoformat(mark) if mark else None


# ---------------------------------------------------------------------------
# Retention (FIL8)
# ---------------------------------------------------------------------------


def expired_partitions(
    df: DataFrame, as_of: str | dt.date, retention_days: int, column: str = "event_date"
) -> DataFrame:
    """FIL8: partitions older than ``as_of - retention_days`` with their row counts.

    The date predicate is on the partition column, so only expired
    directories are read. Deleting them is a separate, explicit call.
    """
    cutoff = _as_date(as_of) - dt.timedelta(days=retention_days)
    return (
        df.filter(F.col(column) < F.lit(cutoff))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("cutoff", F.lit(cutoff))
    )


def purge_partitions(spark: SparkSession, path: str, dates: Sequence[dt.date], column: str = "event_date") -> int:
    """Delete the listed ``column=<date>`` folders, of batch loads and of every
    micro-batch; returns how many dates had any."""
    roots = [f"{root}/{b}" for root in bronze_roots(path) for b in list_dirs(spark, root)]
    removed = 0
    for d in dates:
        gone = [delete_path(spark, f"{root}/{column}={d.isoformat()}") for root in roots]
        removed += any(gone)
    return removed
