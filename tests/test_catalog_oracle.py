"""Every catalog query against its DuckDB oracle at sf0.001 (the driver's
correctness gate, run at the smallest scale)."""

import importlib
import os
import sys

import duckdb
import pytest

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
check = importlib.import_module("check_oracle")
E = importlib.import_module("__spark_entry__")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert check.digest(sdf.columns, srows)[0] == check.digest(dcols, drows)[0]
