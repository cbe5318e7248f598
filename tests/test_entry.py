from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from conftest import SMOKE  # noqa: E402

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "scripts"))
from oracle_check import TABLES, rows_of  # noqa: E402


def test_contract_keys():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "anomaly_severity" in df.columns


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle_on_smoke_data(spark, duck, name):
    """Same column names and Arrow types, same rows (order-insensitive)."""
    got = entry.queries()[name](spark, SMOKE).toArrow()
    want = duck.sql(entry.oracle_sql()[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    srows = [tuple(r.values()) for r in got.to_pylist()]
    drows = [tuple(r.values()) for r in want.to_pylist()]
    assert rows_of(got.column_names, srows) == rows_of(want.column_names, drows)
