"""Every registered query against its DuckDB oracle on the driver tables (sf0.001)."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest
from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "scripts"))
import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

from eventsieve.plans.queries import QUERIES as OWN  # noqa: E402

QUERIES = {k: v for k, v in E.queries().items() if k in OWN}
SQL = {k: v for k, v in E.oracle_sql().items() if k in OWN}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF001, f"{t}.parquet")
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 890
    assert df.columns == E.entry(spark).columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    cols = sorted(df.columns)
    got = rows_of([r.asDict() for r in df.collect()], cols)
    rel = con.sql(SQL[name])
    assert sorted(rel.columns) == cols
    want = rows_of([dict(zip(rel.columns, r)) for r in rel.fetchall()], cols)
    assert got == want
