"""Incremental silver and gold against full reloads: any order of arrival, any crash."""

from __future__ import annotations

import dataclasses
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import bronze_rows, event
from sluice.config import DEFAULT_CONFIG
from sluice.plans import gold as gold_plan
from sluice.plans import medallion
from sluice.plans.gold import process_gold_incremental
from sluice.plans.medallion import ingest_bronze, process_gold
from sluice.sources.journal import Journal
from sluice.sources.tables import (
    LakePaths,
    bronze_batches,
    marks_path,
    read_kpis,
    read_severity,
    read_silver,
)

COLS = (
    "event_id", "sensor_id", "facility_id", "timestamp", "value", "ingestion_timestamp",
    "rolling_mean", "rolling_stddev", "z_score", "event_date",
)


#: Few index buckets: the tables here hold some hundred rows.
CFG = dataclasses.replace(DEFAULT_CONFIG, key_buckets=2)


def process_silver(spark, bronze, silver, config=CFG, **kw):
    return medallion.process_silver(spark, bronze, silver, config, **kw)


def rows_of(spark, p):
    return sorted((tuple(r) for r in read_silver(spark, p.silver).select(*COLS).collect()), key=repr)


def shuffled_events(seed, n=160):
    """Events of few sensors over few days: re-sends with earlier and later stamps and other
    values, equal stamps, missing times, values and ids."""
    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        t = None if rng.random() < 0.04 else base + dt.timedelta(minutes=rng.randrange(4 * 24 * 60))
        one = dict(
            sensor=rng.choice("AB"), fac=rng.choice((" P1", "P2")), t=t,
            value=None if rng.random() < 0.05 else round(rng.uniform(-5, 5), 2),
        )
        for _ in range(rng.choice((1, 1, 1, 2, 3))):
            stamp = base + dt.timedelta(hours=rng.randrange(5))
            copy = {**one, "value": one["value"] if rng.random() < 0.5 else rng.choice((None, 7.5, -2.0))}
            rows.append(event(i if rng.random() > 0.02 else None, ingest=stamp, **copy))
    rng.shuffle(rows)
    for r in rows:
        r["event_id"] = None if r["event_id"] == "None" else r["event_id"]
    return rows


def full_reload(spark, rows, root):
    p = LakePaths(root)
    ingest_bronze(bronze_rows(spark, rows), p.bronze)
    process_silver(spark, p.bronze, p.silver, incremental=False)
    return rows_of(spark, p)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival_equals_a_full_reload(spark, tmp_root, seed):
    rows = shuffled_events(seed)
    p = LakePaths(f"{tmp_root}/steps")
    for part in (rows[:90], rows[90:150], rows[150:]):
        ingest_bronze(bronze_rows(spark, part), p.bronze)
        process_silver(spark, p.bronze, p.silver)
    want = full_reload(spark, rows, f"{tmp_root}/full")
    assert rows_of(spark, p) == want
    assert process_silver(spark, p.bronze, p.silver) == 0
    assert rows_of(spark, p) == want


def test_earlier_and_equal_stamps_are_not_lost(spark, tmp_root):
    p = LakePaths(tmp_root)
    for n, stamp in enumerate(("2024-01-01 10:05:00", "2024-01-01 10:00:00", "2024-01-01 10:00:00")):
        part = [event(100 * n + i, t=f"2024-01-0{n + 1} 00:{i:02d}:00", ingest=stamp) for i in range(20)]
        ingest_bronze(bronze_rows(spark, part), p.bronze)
        assert process_silver(spark, p.bronze, p.silver) == 20
    assert read_silver(spark, p.silver).count() == 60
    state = Journal(spark, marks_path(p.silver)).state()
    assert sorted(state["batches"]) == sorted(bronze_batches(spark, p.bronze)) and len(state["batches"]) == 3


def test_a_late_reading_leaves_days_alone_that_its_frames_do_not_reach(spark, tmp_root):
    """Hourly readings of 20 days; one comes late on day 3, one copy of day 5 is replaced:
    frames reach 99 hours further, into day 9."""
    first = dt.datetime(2024, 1, 1)
    rows = [
        event(i, sensor=s, t=first + dt.timedelta(hours=h), value=float(i % 7), ingest="2024-02-01 01:00:00")
        for i, (s, h) in enumerate((s, h) for s in "AB" for h in range(480))
    ]
    late = [
        event(900001, sensor="A", t="2024-01-03 00:30:00", value=50.0, ingest="2024-02-01 02:00:00"),
        event(100, sensor="A", t=rows[100]["timestamp"], value=80.0, ingest="2024-02-01 00:00:00"),
    ]
    p = LakePaths(f"{tmp_root}/steps")

    def files():
        found = {d.name: sorted(f.name for f in os.scandir(f"{d.path}/facility_id=PLANT-A")) for d in
                 os.scandir(p.silver) if d.name.startswith("event_date=")}
        return {d.removeprefix("event_date=2024-01-"): names for d, names in found.items()}

    ingest_bronze(bronze_rows(spark, rows), p.bronze)
    process_silver(spark, p.bronze, p.silver)
    before = files()
    ingest_bronze(bronze_rows(spark, late), p.bronze)
    assert process_silver(spark, p.bronze, p.silver) == 2
    after = files()
    assert [d for d in sorted(before) if before[d] != after[d]] == [f"{d:02d}" for d in range(3, 10)]
    assert rows_of(spark, p) == full_reload(spark, rows + late, f"{tmp_root}/full")


def test_a_copy_that_precedes_the_one_taken_replaces_it(spark, tmp_root):
    p = LakePaths(tmp_root)
    ingest_bronze(bronze_rows(spark, [event(1, value=1.0, ingest="2024-01-01 05:00:00"), event(2)]), p.bronze)
    assert process_silver(spark, p.bronze, p.silver) == 2
    # An earlier copy without a value: by WIN1 it is the event's row, which clean then drops.
    earlier = event(1, value=None, t="2024-01-03 00:00:00", ingest="2024-01-01 01:00:00")
    ingest_bronze(bronze_rows(spark, [earlier]), p.bronze)
    assert process_silver(spark, p.bronze, p.silver) == 0
    assert [r[0] for r in read_silver(spark, p.silver).select("event_id").collect()] == ["2"]


def test_the_index_is_read_without_an_exchange(spark, tmp_root):
    p = LakePaths(tmp_root)
    ingest_bronze(bronze_rows(spark, [event(i) for i in range(50)]), p.bronze)
    process_silver(spark, p.bronze, p.silver)
    ingest_bronze(bronze_rows(spark, [event(i, ingest="2025-01-01 00:00:00") for i in range(40, 60)]), p.bronze)
    run = medallion._SilverRun(spark, p.bronze, p.silver, CFG, "chunked")
    fresh = run.fresh(list(run.new_batches().values()))
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "sluice_keys" in plan and "Bucketed: true" in plan
    # All exchanges of the plan are those of the batch.
    rows = medallion.read_bronze_folders(spark, p.bronze, list(run.new_batches().values()))
    batch = medallion.dedup_first(rows).repartition(2, "event_id")._jdf.queryExecution().executedPlan()
    assert plan.count("Exchange") == batch.toString().count("Exchange") == 2
    assert sorted(int(r.event_id) for r in fresh.collect()) == list(range(50, 60))


class Crash(Exception):
    pass


STEPS = ("begin", "_write", "add_keys", "window_state", "_commit", "_clean")


@pytest.mark.parametrize("where", STEPS)
def test_a_run_that_dies_anywhere_is_finished_by_the_next(spark, tmp_root, monkeypatch, where):
    rows = shuffled_events(5, 60)
    p = LakePaths(f"{tmp_root}/steps")
    parts = (rows[:40], rows[40:70], rows[70:])
    ingest_bronze(bronze_rows(spark, parts[0]), p.bronze)
    process_silver(spark, p.bronze, p.silver)
    ingest_bronze(bronze_rows(spark, parts[1]), p.bronze)

    def dies_after(owner, name):
        real = getattr(owner, name)

        def step(*args, **kw):
            real(*args, **kw)
            raise Crash(name)

        monkeypatch.setattr(owner, name, step)

    owner = {"begin": Journal, "_clean": Journal, "_write": medallion._SilverRun,
             "_commit": medallion._SilverRun}.get(where, medallion)
    dies_after(owner, where)
    try:
        process_silver(spark, p.bronze, p.silver)
    except Crash:
        pass
    monkeypatch.undo()
    # More arrives before the job runs again.
    ingest_bronze(bronze_rows(spark, parts[2]), p.bronze)
    process_silver(spark, p.bronze, p.silver)
    assert rows_of(spark, p) == full_reload(spark, rows, f"{tmp_root}/full")
    assert not os.path.exists(f"{marks_path(p.silver)}/pending.json")


def test_the_compacted_index_answers_alike(spark, tmp_root):
    rows = shuffled_events(8, 60)
    p = LakePaths(f"{tmp_root}/steps")
    for part in (rows[:40], rows[40:]):
        ingest_bronze(bronze_rows(spark, part), p.bronze)
        process_silver(spark, p.bronze, p.silver)
        medallion.compact_silver_index(spark, p.silver)
    state = Journal(spark, marks_path(p.silver)).state()
    files = [f for f in os.listdir(state["keys"]) if f.endswith(".parquet")]
    assert len(files) == len({f.split("_")[1] for f in files})  # one file per bucket
    assert rows_of(spark, p) == full_reload(spark, rows, f"{tmp_root}/full")


def gold_rows(spark, p):
    def rounded(r):
        return tuple(round(x, 9) if isinstance(x, float) else x for x in r)

    kpis = read_kpis(spark, p.kpis).drop("computed_at").collect()
    scores = read_severity(spark, p.severity).drop("computed_at").collect()
    return sorted(map(rounded, kpis), key=repr), sorted(map(rounded, scores), key=repr)


def full_gold(spark, silver, root):
    p = LakePaths(root)
    process_gold(spark, silver, p.kpis, p.severity)
    return gold_rows(spark, p)


def test_gold_follows_silver_by_merging_and_rewrites_only_what_changed(spark, tmp_root):
    p = LakePaths(tmp_root)
    base = dt.datetime(2024, 1, 1)
    rows = [event(i, sensor="AB"[i % 2], fac=f"P{i % 3}", t=base + dt.timedelta(minutes=37 * i),
                  value=1e6 + i % 7, ingest=base) for i in range(150)]

    def step(part):
        ingest_bronze(bronze_rows(spark, part), p.bronze)
        process_silver(spark, p.bronze, p.silver)
        return process_gold_incremental(spark, p.silver, p.kpis, p.severity)

    assert step(rows[:100])["days"] is None
    before = {f: os.listdir(f"{p.kpis}/{f}/facility_id=P0") for f in os.listdir(p.kpis) if "2024" in f}
    got = step(rows[100:])
    days = {r["timestamp"].date().isoformat() for r in rows[100:]}
    assert set(got["days"]) == days
    after = {f: os.listdir(f"{p.kpis}/{f}/facility_id=P0") for f in os.listdir(p.kpis) if "2024" in f}
    same = [f for f in before if before[f] == after[f]]
    assert same == [f for f in before if f.removeprefix("kpi_date=") not in days] and same
    assert gold_rows(spark, p) == full_gold(spark, p.silver, f"{tmp_root}/full")
    assert process_gold_incremental(spark, p.silver, p.kpis, p.severity)["days"] == []


def test_gold_after_late_and_replaced_rows_equals_gold_anew(spark, tmp_root):
    rows = shuffled_events(11, 120)
    p = LakePaths(f"{tmp_root}/steps")
    for part in (rows[:80], rows[80:140], rows[140:]):
        ingest_bronze(bronze_rows(spark, part), p.bronze)
        process_silver(spark, p.bronze, p.silver)
        process_gold_incremental(spark, p.silver, p.kpis, p.severity)
    # The only reading of a facility's day is replaced by one without a value.
    only = event("solo", fac="P9", t="2024-03-01 00:00:00", ingest="2024-03-01 02:00:00")
    for one in (only, {**only, "value": None, "ingestion_timestamp": dt.datetime(2024, 3, 1)}):
        ingest_bronze(bronze_rows(spark, [one]), p.bronze)
        process_silver(spark, p.bronze, p.silver)
        process_gold_incremental(spark, p.silver, p.kpis, p.severity)
    assert gold_rows(spark, p) == full_gold(spark, p.silver, f"{tmp_root}/full")
    assert not any("P9" in str(r) for r in gold_rows(spark, p)[0])


@pytest.mark.parametrize("where", ["begin", "write_partitioned", "_drop_vanished", "_commit"])
def test_gold_that_dies_is_finished_and_counts_nothing_twice(spark, tmp_root, monkeypatch, where):
    rows = [event(i, t=f"2024-01-01 {i % 24:02d}:{i % 60:02d}:00", value=float(i)) for i in range(90)]
    p = LakePaths(tmp_root)
    for n, part in enumerate((rows[:50], rows[50:])):
        ingest_bronze(bronze_rows(spark, part), p.bronze)
        process_silver(spark, p.bronze, p.silver)
        if n == 0:
            process_gold_incremental(spark, p.silver, p.kpis, p.severity)
    owner = {"begin": Journal, "write_partitioned": gold_plan}.get(where, gold_plan._GoldRun)
    real = getattr(owner, where)

    def step(*args, **kw):
        real(*args, **kw)
        raise Crash(where)

    monkeypatch.setattr(owner, where, step)
    with pytest.raises(Crash):
        process_gold_incremental(spark, p.silver, p.kpis, p.severity)
    monkeypatch.undo()
    process_gold_incremental(spark, p.silver, p.kpis, p.severity)
    assert gold_rows(spark, p) == full_gold(spark, p.silver, f"{tmp_root}/full")


def test_moments_merge_without_losing_precision(spark):
    from sluice.operators.window_state import base_from_state, merge_states, window_state

    rows = [event(i, value=1e9 + (i % 5) * 0.01) for i in range(300)]
    df = bronze_rows(spark, rows).withColumn("z_score", F.lit(0.0)).coalesce(1)
    parts = [window_state(df.filter(F.col("event_id").cast("long") % 3 == k), 15) for k in range(3)]
    merged = merge_states(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    got = base_from_state(merged).first()
    want = base_from_state(window_state(df, 15)).first()
    assert got["event_count"] == want["event_count"] == 300
    assert got["stddev_value"] == pytest.approx(want["stddev_value"], rel=1e-6)
