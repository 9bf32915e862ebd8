"""Plan checks over every registered query: no Python in the plan, pruned
scans, pushed filters, one exchange for the flagship."""

import pytest

import __spark_entry__ as E
from ledgerlens.plans.catalog import QUERIES

from .conftest import SF_SMALL

SKIP_EXECUTING = {"sink_roundtrip_parquet", "sink_roundtrip_csv", "sink_roundtrip_json",
                  "sink_roundtrip_partitioned", "incremental_clean"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP_EXECUTING))
def test_no_python_udf(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_flagship_has_one_exchange_and_pruned_scan(spark):
    df = E.entry(spark)
    p = plan(df)
    assert p.count("Exchange ") == 1
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in p
    assert df.count() > 0


def test_daily_window_pushes_filters(spark):
    p = plan(E.queries()["daily_window"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in p


def test_satisfaction_reads_three_columns(spark):
    p = plan(E.queries()["rq4_satisfaction_by_year"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint>" in p


def test_department_views_aggregate_before_join(spark):
    p = E.queries()["rq3_impact_by_department"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    join_at = p.index("Join LeftOuter")
    assert "Aggregate" in p[join_at:]  # the fact side is aggregated below the join


def test_coverage_gaps_shuffle_bitmap_words_without_join(spark):
    # the words of (entity, bucket), then those of an entity: never the grid
    p = plan(E.queries()["coverage_gaps_window"](spark, SF_SMALL))
    assert p.count("Exchange ") == 2 and "Join" not in p


def test_x1_scans_the_survey_once(spark):
    p = plan(E.queries()["x1_satisfaction_link"](spark, SF_SMALL)).split("== Initial Plan ==")[-1]
    assert p.count("events.parquet") == 1


@pytest.mark.parametrize("name", ["rq2_decisions_per_year", "rq2_spending_vs_decisions"])
def test_decisions_extract_the_number_alone(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert "(?U)Geschäfts#" in p
    assert not any("regexp_extract" in line and label in line for line in p.splitlines()
                   for label in ("(?U)Stimm-Datum", "(?U)NEIN", "Stichentscheid:\\s", "(?s)Geschäftstitel"))
