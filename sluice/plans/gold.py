"""Incremental gold (PIPE3, SNK4, SNK5): windows that changed, and no others.

Beside the KPI table lies the mergeable state of every window
(:mod:`sluice.operators.window_state`), partitioned by day. Each silver run leaves the
state of the rows it appended; a gold run merges it into the state of the days
it touches and writes these days of the state and the KPI table, and the severity
rows of these days, with dynamic partition overwrite. Days in which silver
rewrote rows are aggregated again from those silver partitions; a silver table
written anew has gold written anew.

The merged days are staged and announced in a journal before anything is overwritten, so
a run that dies is finished by the next one and no row counts twice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.config import DEFAULT_CONFIG, LakeConfig
from sluice.operators.aggregate import kpis_from_base, severity_from_base
from sluice.operators.window_state import base_from_state, merge_states, window_state
from sluice.session import delete_path, list_dirs, path_exists
from sluice.sources.journal import Journal
from sluice.sources.tables import marks_path, read_severity, read_silver, write_partitioned

_HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def state_path(kpi_path: str) -> str:
    """Sibling folder of the KPI table with the mergeable window states."""
    return f"{kpi_path.rstrip('/')}_state"


def on_days(column: str, days: Iterable[str | None]) -> Column:
    """Whether a date column holds one of some ISO days (None: null); prunes partitions."""
    days = list(days)
    real = [dt.date.fromisoformat(d) for d in days if d is not None]
    out = F.col(column).isin(real) if real else F.lit(False)
    return out | F.col(column).isNull() if None in days else out


def _days_of(df: DataFrame, column: str) -> set[str | None]:
    """The distinct days of a table (a short list: one entry per day)."""
    return {None if r[0] is None else r[0].isoformat() for r in df.select(column).distinct().collect()}


class _GoldRun:
    def __init__(
        self, spark: SparkSession, silver_path: str, kpi_path: str, severity_path: str, config: LakeConfig
    ) -> None:
        self.spark, self.config = spark, config
        self.silver_path, self.kpi_path, self.severity_path = silver_path, kpi_path, severity_path
        self.state_path = state_path(kpi_path)
        self.journal = Journal(spark, marks_path(kpi_path))
        self.silver = Journal(spark, marks_path(silver_path))

    def states(self) -> DataFrame:
        return self.spark.read.parquet(self.state_path)

    def full(self, upto: int) -> dict:
        """State, KPIs and severity of the whole silver table."""
        minutes = self.config.kpi_window_minutes
        state = window_state(read_silver(self.spark, self.silver_path), minutes)
        write_partitioned(state, self.state_path, ("state_date",), "overwrite", name="state")
        base = base_from_state(self._read_state())
        out = {
            "kpi_rows": write_partitioned(
                kpis_from_base(base, minutes), self.kpi_path, self.config.kpi_partitions, "overwrite", name="kpis"
            ),
            "severity_rows": write_partitioned(
                severity_from_base(base, self.config),
                self.severity_path,
                self.config.severity_partitions,
                "overwrite",
                name="severity",
            ),
            "days": None,
        }
        self._commit(self.journal.next_run(), upto)
        return out

    def _read_state(self) -> DataFrame:
        """The state table with declared types (a table without rows has no files)."""
        empty = window_state(read_silver(self.spark, f"{self.state_path}_none"), 1)
        return self.spark.read.schema(empty.schema).parquet(self.state_path)

    def plan(self, changes: list[dict], upto: int) -> dict | None:
        """Merge and stage the days that changed; None when there are none."""
        minutes = self.config.kpi_window_minutes
        again = {d for c in changes for d in c["days"]}
        folders = [self.silver.lasting(c["run"], "changes") for c in changes if c["mode"] == "append"]
        parts, days = [], set(again)
        if folders:
            added = self.spark.read.schema(self._read_state().schema).parquet(*folders)
            if again:
                added = added.filter(~F.coalesce(on_days("state_date", again), F.lit(False)))
            fresh = _days_of(added, "state_date")
            days |= fresh
            parts += [added, self._read_state().filter(on_days("state_date", fresh))]
        if again:
            rows = read_silver(self.spark, self.silver_path).filter(on_days("event_date", again))
            parts.append(window_state(rows, minutes))
        if not days:
            return None
        merged = parts[0]
        for part in parts[1:]:
            merged = merged.unionByName(part)
        run = self.journal.next_run()
        merged = self.journal.stage(run, "state", merge_states(merged))
        # Severity is partitioned by facility alone: its other days are carried over.
        other = read_severity(self.spark, self.severity_path).filter(
            ~F.coalesce(on_days("score_date", days), F.lit(False))
        )
        scored = severity_from_base(base_from_state(merged), self.config)
        self.journal.stage(run, "severity", other.unionByName(scored))
        intent = {"run": run, "days": sorted(days, key=str), "again": sorted(again, key=str), "upto": upto}
        self.journal.begin(intent)
        return intent

    def apply(self, intent: dict) -> dict:
        """Overwrite the announced days from what was staged (any number of times)."""
        minutes, run = self.config.kpi_window_minutes, intent["run"]
        state = self.journal.staged(run, "state", self._read_state().schema)
        severity = self.journal.staged(run, "severity", read_severity(self.spark, f"{self.severity_path}_none").schema)
        kpis = kpis_from_base(base_from_state(state), minutes)
        out = {
            "kpi_rows": write_partitioned(
                kpis, self.kpi_path, self.config.kpi_partitions, "overwrite", True, name="kpis"
            ),
            "severity_rows": write_partitioned(
                severity, self.severity_path, self.config.severity_partitions, "overwrite", name="severity"
            ),
            "days": intent["days"],
        }
        write_partitioned(state, self.state_path, ("state_date",), "overwrite", True, name="state")
        self._drop_vanished(intent["again"], kpis, state)
        self._commit(run, intent["upto"])
        return out

    def _drop_vanished(self, days: list, kpis: DataFrame, state: DataFrame) -> None:
        """Dynamic overwrite leaves a partition alone that has no rows any more; only days
        that were aggregated again can have such partitions."""
        if not days:
            return
        left = {
            (r[0].isoformat(), r[1]) for r in kpis.select("kpi_date", "facility_id").distinct().collect()
        }
        for day in filter(None, days):
            folder = f"{self.kpi_path.rstrip('/')}/kpi_date={day}"
            for name in list_dirs(self.spark, folder):
                value = name.removeprefix("facility_id=")
                if (day, None if value == _HIVE_NULL else value) not in left and "%" not in value:
                    delete_path(self.spark, f"{folder}/{name}")
        for day in set(days) - _days_of(state, "state_date"):
            delete_path(self.spark, f"{self.state_path}/state_date={day or _HIVE_NULL}")

    def _commit(self, run: int, upto: int) -> None:
        self.journal.finish(run, {"silver_run": upto})
        # Silver forgets what gold has taken.
        self.silver.leave("taken", upto)
        root = f"{self.silver.root}/changes"
        for name in list_dirs(self.spark, root):
            if int(name.removeprefix("run=")) <= upto:
                delete_path(self.spark, f"{root}/{name}")


def process_gold_incremental(
    spark: SparkSession,
    silver_path: str,
    kpi_path: str,
    severity_path: str,
    config: LakeConfig = DEFAULT_CONFIG,
) -> dict:
    """PIPE3 over the silver runs since the last call.

    Returns the KPI and severity rows written and the ``days`` that were rewritten
    (ISO dates; None when gold was written anew, an empty list when nothing changed).
    """

    def job() -> _GoldRun:
        return _GoldRun(spark, silver_path, kpi_path, severity_path, config)

    run = job()
    out = {"kpi_rows": 0, "severity_rows": 0, "days": []}
    pending = run.journal.pending()
    if pending:
        out, run = run.apply(pending), job()
    silver, gold = run.silver.state(), run.journal.state()
    upto = silver["run"] if silver else 0
    seen = gold["silver_run"] if gold else None
    changes = [c for c in (silver or {}).get("changes", []) if seen is None or c["run"] > seen]
    if seen is None or not path_exists(spark, run.state_path) or any(c["mode"] == "full" for c in changes):
        return run.full(upto)
    if not changes:
        return out
    intent = run.plan(changes, upto)
    if intent is None:
        run._commit(run.journal.next_run(), upto)
        return out
    return run.apply(intent)
