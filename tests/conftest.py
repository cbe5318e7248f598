from __future__ import annotations

import datetime as dt
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sluice.schema import BRONZE_SCHEMA  # noqa: E402
from sluice.session import build_session  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="sluice-test-ckpt-")
    s = build_session(
        "local[4]",
        app_name="sluice-tests",
        shuffle_partitions=4,
        extra={"spark.checkpoint.dir": ckpt},
    )
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(tmp_path):
    return str(tmp_path)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def bronze_rows(spark, rows: list[dict]):
    """Bronze-shaped DataFrame from partial dicts (absent fields are null)."""
    names = [f.name for f in BRONZE_SCHEMA.fields]
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, BRONZE_SCHEMA)


def event(eid, sensor="S-1", stype="temperature", fac="PLANT-A", t="2024-01-01 00:00:00",
          value=1.0, ingest=None, **kw):
    d = {
        "event_id": str(eid),
        "sensor_id": sensor,
        "sensor_type": stype,
        "facility_id": fac,
        "timestamp": ts(t) if isinstance(t, str) else t,
        "value": value,
        "unit": "celsius",
        "ingestion_timestamp": ts(ingest) if isinstance(ingest, str) else (ingest or (ts(t) if isinstance(t, str) else t)),
    }
    d.update(kw)
    if d.get("timestamp") is not None:
        d.setdefault("event_date", d["timestamp"].date())
    return d
