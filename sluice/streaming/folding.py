"""Folding closed days of streamed bronze into few folders (SNK1, STR2).

A stream writes one folder tree per micro-batch: some 2,880 a day at a trigger of 30
seconds. :func:`fold_closed_days` moves the rows of days before a date out of these
folders into one batch folder of the table. Readers see every row exactly once at
every moment, and the job can die at any step and be called again:

1. leftovers of an earlier call are finished (see below) or deleted;
2. the days' rows are written to ``_fold-<id>`` (a name readers skip), with a list of
   the (batch, day) folders they come from, ``_folded.json``;
3. the fold is entered in the ledger of silver, whose rows have them already;
4. the folder is renamed to ``batch=fold-<id>``: this one step is the commit. Readers hide
   the folders that a list in a fold names (:func:`sluice.sources.tables.replaced_days`);
5. those folders are deleted, then the list. A later call finishes this.

The rename is atomic on HDFS and local disks; on an object store without atomic
renames run the job while nothing reads the table.

Only writes that silver has taken are folded, and not the newest micro-batch of a
stream: a restart may run that one again, which replaces its folder.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import SparkSession

from sluice.config import DEFAULT_CONFIG, LakeConfig
from sluice.session import delete_path, list_dirs, list_files, rename_path, write_text
from sluice.sources.journal import Journal
from sluice.sources.tables import (
    bronze_batches,
    bronze_roots,
    marks_path,
    read_bronze_folders,
    replaced_days,
    stream_part,
    write_partitioned,
)

LIST = "_folded.json"


def _newest_of_streams(batches: list[str]) -> set[str]:
    """The batch with the highest number of each stream (``<stream>-<number>``)."""
    newest: dict[str, int] = {}
    for batch in batches:
        stream, _, number = batch.rpartition("-")
        newest[stream] = max(newest.get(stream, -1), int(number))
    return {f"{stream}-{number}" for stream, number in newest.items()}


def _is_streamed(bronze_path: str, folder: str) -> bool:
    return folder.startswith(f"{stream_part(bronze_path)}/")


def clean_up(spark: SparkSession, bronze_path: str) -> None:
    """Finish committed folds, and drop what never was committed (steps 1 and 5)."""
    root = bronze_path.rstrip("/")
    for name in list_dirs(spark, root):
        if name.startswith("_fold-"):
            delete_path(spark, f"{root}/{name}")
    for batch, day in sorted(replaced_days(spark, bronze_path)):
        for part in bronze_roots(bronze_path):
            delete_path(spark, f"{part}/batch={batch}/event_date={day}")
    for part in bronze_roots(bronze_path):
        for name in list_dirs(spark, part):
            folder = f"{part}/{name}"
            if name.startswith("batch=fold-") and LIST in list_files(spark, folder):
                delete_path(spark, f"{folder}/{LIST}")
    streamed = {b: f for b, f in bronze_batches(spark, bronze_path).items() if _is_streamed(bronze_path, f)}
    for batch in sorted(set(streamed) - _newest_of_streams(list(streamed))):
        if not list_dirs(spark, streamed[batch]):
            delete_path(spark, streamed[batch])


def _enter(spark: SparkSession, silver_path: str, fold: str) -> None:
    """Enter a fold in silver's ledger: its rows are not new."""
    journal = Journal(spark, marks_path(silver_path))
    state = journal.state()
    journal.finish(journal.next_run(), {**state, "batches": sorted({*state["batches"], fold})})


def fold_closed_days(
    spark: SparkSession,
    bronze_path: str,
    before: dt.date,
    silver_path: str | None = None,
    config: LakeConfig = DEFAULT_CONFIG,
) -> int:
    """Fold the streamed days before ``before``; returns the rows that were moved.

    With ``silver_path`` only writes in silver's ledger are folded; nothing is while a run
    of silver is unfinished. Rows without an event time have no day and stay.
    """
    clean_up(spark, bronze_path)
    batches = {b: f for b, f in bronze_batches(spark, bronze_path).items() if _is_streamed(bronze_path, f)}
    newest = _newest_of_streams(list(batches))
    ledger = None
    if silver_path is not None:
        journal = Journal(spark, marks_path(silver_path))
        state = journal.state()
        if state is None or journal.pending():
            return 0
        ledger = set(state["batches"])
    moved, hidden = [], set()
    for batch, folder in sorted(batches.items()):
        if batch in newest or (ledger is not None and batch not in ledger):
            continue
        for name in list_dirs(spark, folder):
            day = name.removeprefix("event_date=")
            if name.startswith("event_date=") and day[:1].isdigit() and dt.date.fromisoformat(day) < before:
                moved.append((batch, day))
            else:
                hidden.add((batch, day))
    if not moved:
        return 0
    root, fold = bronze_path.rstrip("/"), f"fold-{uuid.uuid4().hex}"
    draft = f"{root}/_{fold}"
    folders = [batches[b] for b in sorted({b for b, _ in moved})]
    rows = read_bronze_folders(spark, bronze_path, folders, hidden)
    n = write_partitioned(rows, draft, config.bronze_partitions, "overwrite", name="fold")
    write_text(spark, f"{draft}/{LIST}", json.dumps(moved))
    if silver_path is not None:
        _enter(spark, silver_path, fold)
    rename_path(spark, draft, f"{root}/batch={fold}")
    clean_up(spark, bronze_path)
    return n
