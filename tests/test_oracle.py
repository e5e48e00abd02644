"""Every registered query against its DuckDB oracle on the smoke tables."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from staffmart.plans.registry import ORACLE_SQL, QUERIES  # noqa: E402
from tools.compare_oracle import TABLES, digest  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_DIR, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(contract.oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(rows) == len(o_rows)
    assert digest(df.columns, rows) == digest(o_cols, o_rows)


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.columns == ["region", "total_employees"]
    assert df.count() > 0
