"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully executed with the ``noop`` sink (every row computed, none
collected), after one untimed warm-up run of every query on sf0.001. Queries
that write tables (pipelines, streams) include their writes.
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sluice.plans.queries import QUERIES  # noqa: E402
from sluice.session import build_session  # noqa: E402

HEADLINE = (
    "severity_daily",
    "kpi_15min",
    "rolling_zscore",
    "dedup_first",
    "contract_violations",
    "quality_suite",
    "profile_columns",
    "bronze_range_read",
    "silver_incremental",
    "stream_ingest",
    "stream_kpi_closed",
    "freshness",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in sys.argv[1:] if q in QUERIES] or list(HEADLINE)
    scratch = tempfile.mkdtemp(prefix="sluice-bench-")
    spark = build_session(
        f"local[{cpus}]",
        app_name="sluice-bench",
        shuffle_partitions=int(cpus),
        extra={"spark.checkpoint.dir": f"{scratch}/checkpoints"},
    )
    spark.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    # Warm-up (JIT, class loading, generated-code compilation) on the smallest
    # scale; not timed.
    for name in only:
        QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop").mode(
            "overwrite"
        ).save()

    times: dict[str, float] = {}
    for name in only:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else None,
            }
        )
    )


if __name__ == "__main__":
    main()
