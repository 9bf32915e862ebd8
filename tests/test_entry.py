"""Driver contract: entry() on sf0.001 returns rows with a stable schema."""

import __spark_entry__ as E
from ledgerlens.plans.catalog import QUERIES


def test_entry_rows_and_stable_schema(spark):
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema
    assert a.columns == ["year", "type", "expenditure_mchf"]
    rows = a.collect()
    assert len(rows) > 0 and {r.type for r in rows} == {"Accounts", "Budget", "Supplementary Credits"}


def test_every_query_callable_and_named(spark):
    qs = E.queries()
    assert len(QUERIES) == 70 and set(QUERIES) <= set(qs) and all(callable(f) for f in qs.values())
    assert all(isinstance(v, str) and v.strip() for v in E.oracle_sql().values())
