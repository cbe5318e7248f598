"""The composite jobs (PIPE1-3): bronze ingest, silver process, gold process.

Incremental silver (PIPE2) takes the bronze writes that its ledger does not list yet
(FIL4): every write is a folder ``batch=<id>`` of its own, so a run lists and reads only
the new folders, and neither the order nor the equality of ingestion stamps matters.
The result is that of a full reload, however batches, copies and readings arrive:

* D4: the first copy of an event counts, by the order of WIN1. The index of all ids
  taken so far (:mod:`sluice.sources.key_index`) tells which copies of a batch are new,
  which are later copies (dropped), and which precede the copy that silver was made
  from (it is replaced);
* D5: rolling windows continue across batches: the last 99 silver rows of every sensor
  before the batch's first reading are used as frame history. They are looked up in the
  last ``history_days`` of silver partitions, older partitions only for sensors short
  of 99 rows;
* readings that fall before others of their sensor that silver holds already (late
  ones, and replaced ones) change the frames behind them. The rows of that sensor from
  the first such place up to the 99th row after the last one are enriched again, and the
  partitions that hold them are rewritten; no frame beyond reaches a change. A
  registry of each sensor's last reading tells whether there are any; batches in
  event-time order, the usual case, only append.

Every run is staged, announced, applied and committed through a journal
(:mod:`sluice.sources.journal`); one that dies is finished by the next.

Gold follows the same way (:mod:`sluice.plans.gold`).
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass
from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.config import DEFAULT_CONFIG, LakeConfig
from sluice.operators.aggregate import kpis_from_base, severity_from_base, window_base
from sluice.operators.clean import clean
from sluice.operators.dedup import DEDUP_ORDER, dedup_first
from sluice.operators.enrich import SENSOR_KEYS, enrich
from sluice.operators.ingest import to_bronze
from sluice.operators.window_state import window_state
from sluice.schema import BRONZE_SCHEMA, SILVER_SCHEMA, conform
from sluice.session import delete_path, modified_at, path_exists, stage_table
from sluice.sources.journal import Journal
from sluice.sources.key_index import add_keys, compact_keys, order_of, with_known
from sluice.sources.tables import (
    InputCount,
    LakePaths,
    bronze_batches,
    bronze_stats,
    expired_partitions,
    gold_stats,
    marks_path,
    purge_partitions,
    read_bronze,
    read_bronze_folders,
    read_kpis,
    read_severity,
    read_silver,
    replaced_days,
    silver_stats,
    write_observed,
    write_partitioned,
)


def ingest_bronze(
    df: DataFrame,
    bronze_path: str,
    config: LakeConfig = DEFAULT_CONFIG,
    ingestion_ts: Column | None = None,
    counts: dict[str, int] | None = None,
) -> int:
    """PIPE1: stamp (PRJ3-5) and append to bronze; returns rows written (AGG13).

    The rows become one folder ``batch=<write id>`` of the table. ``counts`` is filled
    with the rows read and written.
    """
    folder = f"{bronze_path.rstrip('/')}/batch={uuid.uuid4().hex}"
    read = InputCount("ingest_input")
    rows = to_bronze(read.of(df) if counts is not None else df, ingestion_ts)
    written = write_partitioned(rows, folder, config.bronze_partitions, "append", name="bronze")
    if counts is not None:
        counts.update(input=read.total(), output=written)
    return written


def same(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    """Equality of columns of two tables where null equals null."""
    out = F.lit(True)
    for c in columns:
        out = out & a[c].eqNullSafe(b[c])
    return out


def position() -> Column:
    """Place of a reading in its sensor's history, in the order of the rolling frame."""
    return F.struct(F.col("timestamp"), F.col("event_id"))


def position_of(rows: DataFrame) -> Column:
    """:func:`position` of the rows of one side of a join."""
    return F.struct(rows["timestamp"], rows["event_id"])


def with_history(
    new_rows: DataFrame,
    silver: DataFrame,
    lookback: int,
    since: dt.date | None = None,
    registry: DataFrame | None = None,
    starts: DataFrame | None = None,
) -> DataFrame:
    """D5: prepend the last ``lookback`` silver rows of each sensor the batch touches.

    ``row_number() <= lookback`` becomes a partial WindowGroupLimit before the
    shuffle, so even a hot sensor forwards at most ``lookback`` rows per map
    task. History rows carry ``_hist = true``. With ``starts`` (sensor keys and ``low``,
    a position), only rows before that position are history.

    With ``since``, only silver partitions with ``event_date >= since`` are
    read first (partition pruning). Sensors with fewer than ``lookback`` rows
    there are the only ones whose older partitions are read, and only when
    such sensors exist (one small job decides), so the result is exact while
    a routine run reads just the recent days. With a sensor ``registry``
    (earliest event date per sensor, a superset of silver), sensors first
    seen on or after ``since`` (new sensors) are known to have no older rows
    and do not trigger that read.
    """
    keys = list(SENSOR_KEYS)
    cols = [*keys, "timestamp", "event_id", "value"]
    if starts is None:
        touched = new_rows.select(*keys).distinct()
    else:
        touched = starts.select(*keys, "low")
    w = Window.partitionBy(*keys).orderBy(F.col("timestamp").desc(), F.col("event_id").desc())

    def last_rows(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= lookback).drop("_r")

    def of_touched(rows: DataFrame, sensors: DataFrame) -> DataFrame:
        rows = rows.select(*cols)
        if starts is None:
            return rows.join(sensors, same(rows, sensors, keys), "left_semi")
        before = F.struct(rows["timestamp"], rows["event_id"]) < sensors["low"]
        return rows.join(sensors, same(rows, sensors, keys) & before, "left_semi")

    if since is None:
        hist = last_rows(of_touched(silver, touched))
    else:
        recent = last_rows(of_touched(silver.filter(F.col("event_date") >= F.lit(since)), touched))
        full = recent.groupBy(*keys).count().filter(F.col("count") >= lookback).select(*keys)
        short = touched.join(full, same(touched, full, keys), "left_anti")
        if registry is not None:
            older_known = registry.filter(F.col("first_event_date") < F.lit(since)).select(*keys)
            short = short.join(older_known, same(short, older_known, keys), "left_semi")
        if short.isEmpty():
            hist = recent
        else:
            # Rows without an event time are the oldest of all.
            older = silver.filter((F.col("event_date") < F.lit(since)) | F.col("event_date").isNull())
            hist = last_rows(recent.unionByName(of_touched(older, short)))
    hist = hist.withColumn("_hist", F.lit(True))
    return new_rows.withColumn("_hist", F.lit(False)).unionByName(hist, allowMissingColumns=True)


def _full_rows(bronze: DataFrame, config: LakeConfig, strategy: str) -> DataFrame:
    """Silver rows of a whole bronze table."""
    return conform(enrich(clean(dedup_first(bronze), config.sensor_types), config, strategy), SILVER_SCHEMA)


def _sensors_of(rows: DataFrame) -> DataFrame:
    """First event date and last position of every sensor of cleaned rows."""
    return rows.groupBy(*SENSOR_KEYS).agg(
        # Rows without an event time count as older than any day.
        F.min(F.coalesce("event_date", F.lit("1600-01-01").cast("date"))).alias("first_event_date"),
        F.max(position()).alias("last"),
    )


class _SilverRun:
    """One run over a set of bronze writes: what to write, and how to apply it."""

    def __init__(
        self, spark: SparkSession, bronze_path: str, silver_path: str, config: LakeConfig, strategy: str
    ) -> None:
        self.spark, self.config, self.strategy = spark, config, strategy
        self.bronze_path, self.silver_path = bronze_path, silver_path
        self.read = InputCount("bronze_read")
        self.journal = Journal(spark, marks_path(silver_path))
        self.state = self.journal.state()
        self.run = self.journal.next_run()
        if self.state:
            # A write that the journal does not know of (a job that ended between its
            # data and its record): its rows are looked up before others are added.
            written = modified_at(spark, f"{silver_path.rstrip('/')}/_SUCCESS")
            self.unrecorded = bool(written) and written > (self.journal.done_at() or 0)
        else:
            self.unrecorded = False

    # -- inputs ---------------------------------------------------------------

    def new_batches(self) -> dict[str, str]:
        """Finished bronze writes that the ledger does not list."""
        known = set(self.state["batches"]) if self.state else set()
        live = bronze_batches(self.spark, self.bronze_path)
        return {b: f for b, f in live.items() if b not in known}

    def is_full(self) -> bool:
        """Whether there is nothing to add to (D6: silver, or its ledger, does not exist)."""
        return self.state is None or not path_exists(self.spark, self.silver_path)

    def sensors(self) -> DataFrame:
        return self.spark.read.parquet(self.state["sensors"])

    # -- planning -------------------------------------------------------------

    def fresh(self, folders: Sequence[str]) -> DataFrame:
        """First copies of the new batches that are new or precede the copy taken before;
        ``_known`` is that copy's order."""
        hidden = replaced_days(self.spark, self.bronze_path)
        rows = read_bronze_folders(self.spark, self.bronze_path, folders, hidden)
        # WIN1 first: a hot re-sent id reaches the lookup as one row.
        looked_up = with_known(dedup_first(self.read.of(rows)), self.state["keys"], self.state["key_buckets"])
        return looked_up.filter(F.col("_known").isNull() | (order_of() < F.col("_known")))

    def plan(
        self, fresh: DataFrame, stage: Callable[[str, DataFrame], DataFrame]
    ) -> tuple[dict[str, DataFrame], str, list]:
        """(rows to write, in staged parts by name; ``append`` or ``rewrite``; partitions
        that become empty).

        ``fresh`` must be staged: it is read several times. ``stage`` writes a part and
        reads it back.
        """
        silver = read_silver(self.spark, self.silver_path)
        if self.unrecorded:
            held = silver.select("event_id")
            fresh = fresh.join(held, same(fresh, held, ["event_id"]), "left_anti")
        cleaned = clean(fresh.drop("_known"), self.config.sensor_types)
        keys = list(SENSOR_KEYS)
        replaced = fresh.filter("_known is not null").select(
            "event_id", F.to_date("_known.timestamp").alias("_day")
        )
        days = [r[0] for r in replaced.select("_day").distinct().collect()]
        changed = cleaned.select(*keys, position().alias("at"))
        if days:
            # Silver rows made from copies that come second now.
            there = silver.filter(_in_days("event_date", days))
            removed = there.join(replaced, same(there, replaced, ["event_id"]), "left_semi")
            removed = stage_table(removed.select(*keys, "event_date", "facility_id", "timestamp", "event_id"), "removed")
            changed = changed.unionByName(removed.select(*keys, position().alias("at")))
        starts = changed.groupBy(*keys).agg(F.min("at").alias("low"), F.max("at").alias("high"))
        sensors = self.sensors()
        starts = stage_table(
            starts.join(sensors, same(starts, sensors, keys), "left").select(
                *[starts[k] for k in keys],
                "low",
                "high",
                F.coalesce(F.col("low") <= F.col("last"), F.lit(False)).alias("late"),
            ),
            "silver-starts",
        )
        late = starts.filter("late")
        if late.isEmpty():
            return {"out": stage("out", self._enriched(cleaned, silver, starts))}, "append", []
        # Rows of late sensors whose frames may reach a change, made again.
        late = self._reach(late, silver)
        behind = _between(silver, late, "low", "end")
        at = position_of(behind)
        touches = same(behind, late, keys) & (at >= late["low"]) & (at <= late["end"])
        behind = behind.join(late, touches, "left_semi")
        if days:
            # All ids of the batch that silver holds.
            behind = behind.join(removed, same(behind, removed, ["event_id"]), "left_anti")
        again = cleaned.unionByName(conform(behind, BRONZE_SCHEMA).select(cleaned.columns))
        rows = stage("again", self._enriched(again, silver, starts))
        # All other rows of the partitions they are in stay as they are.
        touched = rows.select("event_date", "facility_id")
        if days:
            touched = touched.unionByName(removed.select("event_date", "facility_id"))
        touched = stage_table(touched.distinct(), "silver-touched")
        dates = [r[0] for r in touched.select("event_date").distinct().collect()]
        kept = silver.filter(_in_days("event_date", dates))
        kept = kept.join(touched, same(kept, touched, ["event_date", "facility_id"]), "left_semi")
        at = position_of(kept)
        touches = same(kept, late, keys) & (at >= late["low"]) & (at <= late["end"])
        kept = stage("kept", kept.join(late, touches, "left_anti").select(rows.columns))
        empty = []
        if days:
            full = rows.unionByName(kept).select("event_date", "facility_id").distinct()
            gone = touched.join(full, same(touched, full, ["event_date", "facility_id"]), "left_anti")
            empty = [[_text(r[0]), r[1]] for r in gone.collect()]
        return {"again": rows, "kept": kept}, "rewrite", empty

    def _reach(self, late: DataFrame, silver: DataFrame) -> DataFrame:
        """Sensors with changes between ``low`` and ``high``, and ``end``: the last row
        whose frame reaches one. ``row_number() <= n`` limits each map task, as in
        :func:`with_history`."""
        keys = list(SENSOR_KEYS)
        after = _between(silver, late, "high")
        beyond = after.join(late, same(after, late, keys) & (position_of(after) > late["high"]), "left_semi")
        w = Window.partitionBy(*keys).orderBy("timestamp", "event_id")
        beyond = beyond.select(*keys, "timestamp", "event_id").withColumn("_r", F.row_number().over(w))
        ends = beyond.filter(F.col("_r") < self.config.rolling_rows).groupBy(*keys).agg(F.max(position()).alias("end"))
        joined = late.join(ends, same(late, ends, keys), "left")
        return stage_table(
            joined.select(*[late[k] for k in keys], "low", F.coalesce("end", "high").alias("end")), "silver-late"
        )

    def _enriched(self, rows: DataFrame, silver: DataFrame, starts: DataFrame) -> DataFrame:
        last_day = self.state.get("max_event_date")
        since = None
        if last_day:
            since = dt.date.fromisoformat(last_day) - dt.timedelta(days=self.config.history_days)
        framed = with_history(rows, silver, self.config.rolling_rows - 1, since, self.sensors(), starts)
        enriched = enrich(framed, self.config, self.strategy).filter(~F.col("_hist"))
        return conform(enriched, SILVER_SCHEMA)

    # -- applying -------------------------------------------------------------

    def full(self, batches: dict[str, str]) -> int:
        """Write silver anew from all its bronze writes."""
        spark, journal = self.spark, self.journal
        hidden = replaced_days(spark, self.bronze_path)
        bronze = read_bronze_folders(spark, self.bronze_path, list(batches.values()), hidden)
        keys = journal.lasting(self.run, "keys")
        delete_path(spark, keys)
        buckets = self.config.key_buckets
        add_keys(dedup_first(bronze.select("event_id", *DEDUP_ORDER)), keys, buckets)
        out = self._write(_full_rows(self.read.of(bronze), self.config, self.strategy), "overwrite", False)
        sensors = journal.lasting(self.run, "sensors")
        _sensors_of(read_silver(spark, self.silver_path)).write.mode("overwrite").parquet(sensors)
        delete_path(spark, f"{journal.root}/changes")
        self._commit(sorted(batches), keys, buckets, sensors, out, "full", [])
        return out["n"]

    def add(self, batches: dict[str, str]) -> int:
        """Plan, announce and apply one incremental run."""
        def stage(name: str, df: DataFrame) -> DataFrame:
            return self.journal.stage(self.run, name, df)

        fresh = stage("fresh", self.fresh(list(batches.values())))
        parts, mode, empty = self.plan(fresh, stage)
        intent = {"run": self.run, "batches": sorted(batches), "mode": mode, "empty": empty, "parts": sorted(parts)}
        self.journal.begin(intent)
        return self.apply(intent, again=self.unrecorded)

    def apply(self, intent: dict, again: bool = True) -> int:
        """Apply an announced run; ``again`` when an earlier attempt may have begun to."""
        spark, journal, run = self.spark, self.journal, intent["run"]
        parts = [journal.staged(run, name, SILVER_SCHEMA) for name in intent.get("parts", ["out"])]
        out = reduce(DataFrame.unionByName, parts)
        fresh = spark.read.parquet(journal.folder(run, "fresh"))
        if intent["mode"] == "append":
            added = out
            if again:
                held = read_silver(spark, self.silver_path).select("event_id")
                added = out.join(held, same(out, held, ["event_id"]), "left_anti")
            written = self._write(added, "append", False)
        else:
            written = self._write(out, "overwrite", True)
            for day, facility in intent["empty"]:
                delete_path(spark, _partition(self.silver_path, day, facility))
        keys, buckets = self.state["keys"], self.state["key_buckets"]
        add_keys(fresh, keys, buckets)
        sensors = journal.lasting(run, "sensors")
        both = self.sensors().unionByName(_sensors_of(clean(fresh, self.config.sensor_types)))
        both.groupBy(*SENSOR_KEYS).agg(
            F.min("first_event_date").alias("first_event_date"), F.max("last").alias("last")
        ).write.mode("overwrite").parquet(sensors)
        days: list = []
        if intent["mode"] == "append" and not self.unrecorded:
            state = window_state(out, self.config.kpi_window_minutes)
            state.write.mode("overwrite").parquet(journal.lasting(run, "changes"))
        else:
            rows = out if intent["mode"] == "rewrite" else fresh
            days = [_text(r[0]) for r in rows.select("event_date").distinct().collect()]
            days = sorted({*days, *[d for d, _ in intent["empty"]]}, key=str)
        made = written["n"]
        if intent["mode"] == "rewrite" and not again:
            # Every cleaned row of the batch is one row of the table.
            made = clean(fresh, self.config.sensor_types).count()
        elif intent["mode"] == "rewrite":
            ids = fresh.select("event_id")
            made = out.join(ids, same(out, ids, ["event_id"]), "left_semi").count()
        elif again:
            made = out.count()
        self._commit(intent["batches"], keys, buckets, sensors, written, "days" if days else "append", days)
        delete_path(spark, self.state["sensors"])
        return made

    def _write(self, rows: DataFrame, mode: str, dynamic: bool) -> dict:
        return write_observed(
            rows,
            self.silver_path,
            self.config.silver_partitions,
            mode,
            dynamic,
            name="silver",
            metrics={"mark": F.max("ingestion_timestamp"), "max_event_date": F.max("event_date")},
        )

    def _commit(self, batches, keys, buckets, sensors, written, mode, days) -> None:
        state = self.state or {}
        full = mode == "full"
        live = set(bronze_batches(self.spark, self.bronze_path))
        # Writes that were folded or purged need no entry any more.
        ledger = set(batches) | {b for b in ([] if full else state["batches"]) if b in live}
        mark = max(filter(None, [_text(written["mark"]), None if full else state.get("mark")]), default=None)
        last = max(
            filter(None, [_text(written["max_event_date"]), None if full else state.get("max_event_date")]),
            default=None,
        )
        # What gold has not taken yet; a full load makes earlier changes void.
        taken = self.journal.note("taken") or 0
        changes = [] if full else [c for c in state["changes"] if c["run"] > taken]
        changes = [*changes, {"run": self.run, "mode": mode, "days": days}]
        self.journal.finish(
            self.run,
            {
                "batches": sorted(ledger),
                "keys": keys,
                "key_buckets": buckets,
                "sensors": sensors,
                "mark": mark,
                "max_event_date": last,
                "changes": changes,
            },
        )


def _text(value) -> str | None:
    return None if value is None else value.isoformat()


def _in_days(column: str, days: Sequence[dt.date | None]) -> Column:
    """Whether a date is one of some days (null among them); prunes partitions."""
    real = [d for d in days if d is not None]
    out = F.col(column).isin(real) if real else F.lit(False)
    return out | F.col(column).isNull() if len(real) < len(days) else out


def _between(rows: DataFrame, sensors: DataFrame, first: str, last: str | None = None) -> DataFrame:
    """``rows`` without days that lie before all positions ``first``, or behind all
    positions ``last``, of the sensors (prunes partitions; no day is none of these)."""
    bounds = sensors.agg(
        F.min(F.to_date(f"{first}.timestamp")).alias("since"),
        F.count_if(F.col(f"{first}.timestamp").isNull()).alias("untimed"),
        *([F.max(F.to_date(f"{last}.timestamp")).alias("until")] if last else []),
    ).first()
    day = F.col("event_date")
    if not bounds["untimed"]:
        rows = rows.filter(day >= F.lit(bounds["since"]))
    if last and bounds["until"] is not None:
        rows = rows.filter((day <= F.lit(bounds["until"])) | day.isNull())
    return rows


def _partition(path: str, day: str | None, facility: str | None) -> str:
    hive = "__HIVE_DEFAULT_PARTITION__"
    return f"{path.rstrip('/')}/event_date={day or hive}/facility_id={facility or hive}"


def silver_batch(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    config: LakeConfig = DEFAULT_CONFIG,
    incremental: bool = True,
    strategy: str = "chunked",
) -> DataFrame:
    """PIPE2 as a DataFrame (not written): the silver rows this run would write."""
    job = _SilverRun(spark, bronze_path, silver_path, config, strategy)
    if not incremental or job.is_full():
        return _full_rows(read_bronze(spark, bronze_path), config, strategy)

    def stage(name: str, df: DataFrame) -> DataFrame:
        return stage_table(df, f"silver-{name}")

    fresh = stage("fresh", job.fresh(list(job.new_batches().values())))
    return reduce(DataFrame.unionByName, job.plan(fresh, stage)[0].values())


def process_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    config: LakeConfig = DEFAULT_CONFIG,
    incremental: bool = True,
    strategy: str = "chunked",
    counts: dict[str, int] | None = None,
) -> int:
    """PIPE2: FIL4 -> WIN1 -> D4 -> clean -> D5 -> enrich -> silver (SNK3).

    Returns the silver rows made from the batches that were taken. With
    ``incremental=False``, or when there is no silver yet, the table is written anew.
    ``counts`` is filled with the bronze rows read and the silver rows made.
    """

    def job() -> _SilverRun:
        return _SilverRun(spark, bronze_path, silver_path, config, strategy)

    done, run = 0, job()
    if not incremental or run.is_full():
        done = run.full(bronze_batches(spark, bronze_path))
    else:
        intent = run.journal.pending()
        if intent:
            done, run = run.apply(intent), job()
        batches = run.new_batches()
        done += run.add(batches) if batches else 0
    if counts is not None:
        counts.update(input=run.read.total(), output=done)
    return done


def compact_silver_index(spark: SparkSession, silver_path: str) -> None:
    """Upkeep of the index of event ids: one row per id, one file per bucket. The old
    files go when the new ones are the index."""
    journal = Journal(spark, marks_path(silver_path))
    state = journal.state()
    if state is None or journal.pending():
        return
    run = journal.next_run()
    target = journal.lasting(run, "keys")
    delete_path(spark, target)
    compact_keys(spark, state["keys"], target, state["key_buckets"])
    journal.finish(run, {**state, "keys": target})
    delete_path(spark, state["keys"])


def process_gold(
    spark: SparkSession,
    silver_path: str,
    kpi_path: str,
    severity_path: str,
    config: LakeConfig = DEFAULT_CONFIG,
    dynamic_overwrite: bool = False,
) -> dict[str, int]:
    """PIPE3: silver is scanned once into the window base, from which both tables are
    overwritten (SNK4, SNK5); counts (``input_rows`` too) are observed by the jobs."""
    minutes = config.kpi_window_minutes
    read = InputCount("silver_read")
    base = stage_table(window_base(read.of(read_silver(spark, silver_path)), minutes), "gold-base")
    kpi_rows = write_partitioned(
        kpis_from_base(base, minutes),
        kpi_path,
        config.kpi_partitions,
        "overwrite",
        dynamic_overwrite,
        name="kpis",
    )
    severity_rows = write_partitioned(
        severity_from_base(base, config),
        severity_path,
        config.severity_partitions,
        "overwrite",
        dynamic_overwrite,
        name="severity",
    )
    return {"kpi_rows": kpi_rows, "severity_rows": severity_rows, "input_rows": read.total()}


@dataclass
class Lakehouse:
    """Convenience facade over one folder layout (the reference's layer classes)."""

    spark: SparkSession
    root: str
    config: LakeConfig = DEFAULT_CONFIG

    @property
    def paths(self) -> LakePaths:
        return LakePaths(self.root)

    def ingest(self, df: DataFrame, ingestion_ts: Column | None = None) -> int:
        return ingest_bronze(df, self.paths.bronze, self.config, ingestion_ts)

    def process_silver(self, incremental: bool = True, strategy: str = "chunked") -> int:
        return process_silver(
            self.spark, self.paths.bronze, self.paths.silver, self.config, incremental, strategy
        )

    def process_gold(self, dynamic_overwrite: bool = False) -> dict[str, int]:
        return process_gold(
            self.spark,
            self.paths.silver,
            self.paths.kpis,
            self.paths.severity,
            self.config,
            dynamic_overwrite,
        )

    def bronze(self, start_date=None, end_date=None, sensor_type=None) -> DataFrame:
        return read_bronze(self.spark, self.paths.bronze, start_date, end_date, sensor_type)

    def silver(self, start_date=None, end_date=None, facility_id=None) -> DataFrame:
        return read_silver(self.spark, self.paths.silver, start_date, end_date, facility_id)

    def kpis(self, facility_id=None, kpi_date=None) -> DataFrame:
        return read_kpis(self.spark, self.paths.kpis, facility_id, kpi_date)

    def severity(self, facility_id=None) -> DataFrame:
        return read_severity(self.spark, self.paths.severity, facility_id)

    def expired(self, as_of, purge: bool = False) -> DataFrame:
        """FIL8: bronze partitions older than ``as_of - retention_days`` (with row counts).

        With ``purge=True`` the list is computed first (one row per expired day) and
        returned as such, then the listed folders are deleted.
        """
        listed = expired_partitions(self.bronze(), as_of, self.config.retention_days)
        if purge:
            rows = listed.collect()
            listed = self.spark.createDataFrame(rows, listed.schema)
            purge_partitions(self.spark, self.paths.bronze, [r["event_date"] for r in rows])
        return listed

    def bronze_stats(self) -> DataFrame:
        return bronze_stats(self.bronze())

    def silver_stats(self) -> DataFrame:
        return silver_stats(self.silver())

    def gold_stats(self) -> DataFrame:
        return gold_stats(self.kpis(), self.severity())
