"""Every query with SQL against DuckDB on the same tables; every other query runs and keeps its columns."""

from __future__ import annotations

import decimal
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__

FOLDER = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
QUERIES, SQL = __spark_entry__.queries(), __spark_entry__.oracle_sql()


EMPTY: set[str] = set()  # queries without a row on the small tables
KEYS = {"doc_id", "row_id", "ext_id", "item_id", "region_id", "trait_id", "page_no", "ok", "score", "outcome", "field", "answer", "repeats"}
SETS = {"grounding_gate", "gate_cascade", "localize_quote", "reconcile_pages", "similarity_pairs", "p5_found", "p7_labels", "p7_found", "p9_mix", "nest_paths"}  # no row comes twice


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in FOLDER.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6g}"
    if isinstance(v, int) and not isinstance(v, bool):
        return f"{float(v):.6g}" if abs(v) < 1e6 else str(v)
    return repr(v)


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, str(FOLDER))
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    found = duck.execute(SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall())
    assert got == want


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    df = QUERIES[name](spark, str(FOLDER))
    assert len(df.columns) == len(set(df.columns))
    rows = df.collect()
    assert bool(rows) != (name in EMPTY)
    for c in set(df.columns) & KEYS:
        assert all(r[c] is not None for r in rows)
    twice = df.columns if name in SETS else []
    assert not twice or len({str(r) for r in rows}) == len(rows)


def test_entry(spark):
    if FOLDER.exists():
        assert __spark_entry__.entry(spark).count() > 0


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)
