"""Lineage of streams (LIN1, AGG13): row counts from the engine's own progress reports.

A :class:`StreamLineage` listens to the progress of the streaming queries that observe a
metric (``df.observe(name, count)``, as ``run_bronze_ingest(metric=...)`` does). Each
micro-batch reports the rows it read and the rows that passed the metric; nobody
counts a second time or passes numbers in. The reports, one small entry per
micro-batch, are recorded in a lineage log when the caller says so.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from sluice.operators.governance import LineageLog


class StreamLineage(StreamingQueryListener):
    """Collects (input rows, output rows) of every micro-batch that reports ``metric``."""

    def __init__(self, spark: SparkSession, metric: str) -> None:
        self.spark, self.metric = spark, metric
        self._lock = threading.Lock()
        #: Micro-batch by (query run, batch id): a batch that reports twice counts once.
        self._batches: dict[tuple[str, int], tuple[int, int]] = {}
        self._running: set[str] = set()

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = (progress.observedMetrics or {}).get(self.metric)
        if row is None:
            return
        with self._lock:
            self._batches[str(progress.runId), progress.batchId] = (progress.numInputRows, row["n"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._running.discard(str(event.runId))

    def __enter__(self) -> StreamLineage:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *failure) -> None:
        # Reports arrive in order on another thread; the last one says that a query ended.
        until = time.monotonic() + 30
        while self._running and time.monotonic() < until:
            time.sleep(0.05)
        self.spark.streams.removeListener(self)

    def batches(self) -> list[tuple[int, int]]:
        """(input rows, output rows) of the micro-batches so far."""
        with self._lock:
            return list(self._batches.values())

    def record(self, log: LineageLog, source_layer: str, target_layer: str, operation: str) -> str:
        """One lineage step named like the metric, over all micro-batches reported."""
        seen = self.batches()
        return log.record_step(
            self.metric,
            source_layer,
            target_layer,
            operation,
            sum(i for i, _ in seen),
            sum(o for _, o in seen),
            {"micro_batches": len(seen)},
        )
