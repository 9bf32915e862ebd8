"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from ledgerlens.bindings import TABLES
from ledgerlens.plans.catalog import QUERIES

from .conftest import SF_SMALL

import importlib.util
import os

_spec = importlib.util.spec_from_file_location(
    "check_oracle", os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts", "check_oracle.py"))
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(QUERIES)))
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert check.digest(s_cols, s_rows)[0] == check.digest(d_cols, d_rows)[0]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())
