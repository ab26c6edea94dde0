"""Every key with an oracle equals DuckDB on the same fixture views (sf0.001)."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry_mod  # noqa: E402
from oracle_check import _rows, duck  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

ORACLES = entry_mod.oracle_sql()
SLOW = {"stream_ingest", "csv_roundtrip", "jsonl_instances"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_key_matches_duckdb(spark, con, name):
    sdf = entry_mod.queries()[name](spark, SF_SMALL)
    scols, srows = sdf.columns, [tuple(r) for r in sdf.collect()]
    cur = con.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert _rows(scols, srows) == _rows(dcols, drows)


def test_every_key_has_a_callable_and_oracles_are_keys():
    qs = entry_mod.queries()
    assert set(ORACLES) <= set(qs)
    assert len(qs) >= 102


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["band", "n", "mean_z"]
