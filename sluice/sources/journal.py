"""What an incremental job has done, so that it can go on, or be finished, after a crash.

A job keeps a small folder beside its table (``<table>_marks``) with one JSON file
per finished run (``done-<number>.json``) and, while a run is under way, the run's
intent (``pending.json``). A run

1. plans, and stages all rows it will write below the folder (``run-<number>/``);
2. writes its intent: from here on the run will be finished, whoever does it;
3. applies the staged rows to its tables;
4. writes ``done-<number>.json`` with the new state: this one file is the commit;
5. removes the intent and what it staged, and all but the newest two states.

A run that dies before step 2 has changed nothing. One that dies later is finished by
the next call from the staged rows; every step of applying them can be repeated. Files
are created whole or not at all. The state is small: names of input batches, dates
and counts, never rows.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession

from sluice.session import (
    delete_path,
    list_files,
    modified_at,
    path_exists,
    read_text,
    write_text,
)

_DONE = re.compile(r"done-(\d+)\.json$")


class Journal:
    """The runs of one incremental job."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _versions(self) -> list[int]:
        found = (_DONE.match(name) for name in list_files(self.spark, self.root))
        return sorted(int(m.group(1)) for m in found if m)

    def _done(self, number: int) -> str:
        return f"{self.root}/done-{number:012d}.json"

    def state(self) -> dict | None:
        """State after the last finished run, with its number as ``run``; None before."""
        versions = self._versions()
        if not versions:
            return None
        return json.loads(read_text(self.spark, self._done(versions[-1])))

    def done_at(self) -> int | None:
        """When the last run was finished (milliseconds, by the file system's clock)."""
        versions = self._versions()
        return modified_at(self.spark, self._done(versions[-1])) if versions else None

    def next_run(self) -> int:
        versions = self._versions()
        return versions[-1] + 1 if versions else 1

    def folder(self, run: int, name: str) -> str:
        """A folder of one run, deleted when it is done."""
        return f"{self.root}/run-{run:012d}/{name}"

    def lasting(self, run: int, name: str) -> str:
        """A folder that outlives its run."""
        return f"{self.root}/{name}/run={run:012d}"

    def stage(self, run: int, name: str, df: DataFrame) -> DataFrame:
        """Write rows of a run (again, if an earlier attempt left some) and read them back."""
        path = self.folder(run, name)
        df.write.mode("overwrite").parquet(path)
        return self.staged(run, name, df.schema)

    def staged(self, run: int, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.folder(run, name))

    def pending(self) -> dict | None:
        """The intent of a run that is not finished."""
        path = f"{self.root}/pending.json"
        if not path_exists(self.spark, path):
            return None
        intent = json.loads(read_text(self.spark, path))
        if intent["run"] < self.next_run():
            # It was finished; only its clean-up is missing.
            self._clean(intent["run"])
            return None
        return intent

    def note(self, name: str):
        """A value that another job left here, or None."""
        path = f"{self.root}/{name}.json"
        return json.loads(read_text(self.spark, path)) if path_exists(self.spark, path) else None

    def leave(self, name: str, value) -> None:
        """Leave a value for the job that owns this journal."""
        write_text(self.spark, f"{self.root}/{name}.json", json.dumps(value))

    def begin(self, intent: dict) -> None:
        write_text(self.spark, f"{self.root}/pending.json", json.dumps(intent))

    def finish(self, run: int, state: dict) -> None:
        write_text(self.spark, self._done(run), json.dumps({**state, "run": run}))
        self._clean(run)

    def _clean(self, run: int) -> None:
        delete_path(self.spark, f"{self.root}/pending.json")
        delete_path(self.spark, f"{self.root}/run-{run:012d}")
        for old in self._versions()[:-2]:
            delete_path(self.spark, self._done(old))
