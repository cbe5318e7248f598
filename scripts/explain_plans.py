"""Print the formatted physical plan of registered queries.

usage: python scripts/explain_plans.py [sf_dir] [query ...]

Plans are printed before execution (AQE may still re-plan joins and coalesce
partitions at run time). Queries that stage data (checkpointed rolling
numbering, pipelines, streams) run those stages while the DataFrame is built.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sluice.plans.queries import QUERIES  # noqa: E402
from sluice.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = [n for n in sys.argv[2:] if n in QUERIES] or ["severity_daily", "kpi_15min", "quality_suite"]
    spark = build_session("local[8]")
    for name in names:
        print(f"===== {name} =====")
        QUERIES[name](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
