"""Analytical views on hand-made rows, plus algebraic properties on the driver tables."""

import pytest
from pyspark.sql import functions as F

from ledgerlens import bindings as B
from ledgerlens.plans import views as V

from .conftest import SF_SMALL

SPENDING = "betrag double, betragstyp string, institution string, jahr int, sachkonto string"


def test_trends_fill_missing_types_with_zero(spark):
    df = spark.createDataFrame([(10.0, "RECHNUNG", "1", 2019, "30"), (5.5, "RECHNUNG", "1", 2019, "31")], SPENDING)
    got = {(r.year, r.type): r.expenditure_mchf for r in V.expenditure_trends(df).collect()}
    assert got == {(2019, "Accounts"): 15.5, (2019, "Budget"): 0.0, (2019, "Supplementary Credits"): 0.0}


def test_yoy_uses_previous_present_year(spark):
    df = spark.createDataFrame([(100.0, "RECHNUNG", "1", 2019, "30"), (130.0, "RECHNUNG", "1", 2021, "30")],
                               SPENDING)
    got = {r.year: r.expenditure_change for r in V.spending_change(df).collect()}
    assert got == {2019: None, 2021: 30.0}


def test_decisions_null_year_group_and_left_join(spark):
    votes = spark.createDataFrame([(2019,), (2019,), (None,)], "year int")
    d = {r.year: r.number_of_decisions for r in V.decisions_per_year(votes).collect()}
    assert d == {2019: 2, None: 1}
    change = spark.createDataFrame([(2019, 1.0), (2020, 2.0)], "year int, expenditure_change double")
    got = {r.year: r.number_of_decisions for r in V.spending_vs_decisions(change, V.decisions_per_year(votes)).collect()}
    assert got == {2019: 2, 2020: None}


def test_share_null_when_department_sums_to_zero(spark):
    df = spark.createDataFrame([(5.0, "RECHNUNG", "1", 2019, "30"), (-5.0, "RECHNUNG", "1", 2019, "32"),
                                (4.0, "RECHNUNG", "2", 2019, "30"), (4.0, "RECHNUNG", "2", 2019, "38"),
                                (1.0, "RECHNUNG", "9", 2019, "30")], SPENDING)
    inst = spark.createDataFrame([("1", "Bau"), ("2", "Schule")], "key string, `departement.bezeichnung` string")
    got = {r.department: r.citizen_impact_share for r in V.citizen_impact_share(V.enrich_spending(df), inst).collect()}
    assert got == {"Bau": None, "Schule": 0.5, None: 1.0}


def test_satisfaction_link_same_and_next_year(spark):
    change = spark.createDataFrame([(2019, 1.0), (2020, -1.0)], "year int, expenditure_change double")
    sat = spark.createDataFrame([(2019, 4.0, 5.0), (2020, 3.0, 2.0)],
                                "year int, avg_quality_of_life double, avg_beliebtheit_zh double")
    got = {r.year: (r.quality_same_year, r.quality_next_year) for r in V.satisfaction_link(change, sat).collect()}
    assert got == {2019: (4.0, 3.0), 2020: (3.0, None)}


def test_unpivot_equals_union_of_branches(spark):
    s = B.spending(B.Tables(spark, SF_SMALL))
    one = V.expenditure_trends(s)
    e = V.enrich_spending(s)
    parts = [e.groupBy(F.col("jahr").alias("year")).agg(
        F.coalesce(F.sum(F.col(c).cast("decimal(18,2)")), F.lit(0).cast("decimal(18,2)")).cast("double")
        .alias("expenditure_mchf")).select("year", F.lit(label).alias("type"), "expenditure_mchf")
        for label, c in [("Accounts", "accounts_amount"), ("Budget", "budget_amount"),
                         ("Supplementary Credits", "supplementary_credits_amount")]]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert sorted(one.collect()) == sorted(union.collect())


def test_department_sum_equals_yearly_sum(spark):
    t = B.Tables(spark, SF_SMALL)
    s = B.spending(t)
    by_dept = V.impact_by_department(V.enrich_spending(s), B.institutions(t)).agg(F.sum("spend_chf")).first()[0]
    by_year = V.yearly_totals(s).agg(F.sum("total_expenditure")).first()[0]
    assert by_dept == pytest.approx(by_year, rel=1e-12)


def test_register_views(spark):
    t = B.Tables(spark, SF_SMALL)
    names = V.register_views(spark, spending=B.spending(t), votes=B.votes(t),
                             institutions=B.institutions(t))
    assert "v_rq1_expenditure_trends" in names
    assert spark.sql("SELECT count(*) FROM v_rq2_spending_vs_decisions").first()[0] > 0


def test_hot_institution_against_brute_force(spark):
    """One institution holds a third of all rows; results equal a plain-Python sum."""
    import random
    from decimal import Decimal
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        inst = "0" if i % 3 == 0 else str(rnd.randint(1, 40))
        rows.append((round(rnd.uniform(-50, 500), 2), rnd.choice(["RECHNUNG", "STADTRAT_ANTRAG"]), inst,
                     rnd.choice([2019, 2020, 2021]), str(rnd.randint(30, 39))))
    df = spark.createDataFrame(rows, SPENDING).repartition(6)
    inst = spark.createDataFrame([(str(k), f"D{k % 4}") for k in range(0, 41)],
                                 "key string, `departement.bezeichnung` string")
    got = {(r.department, r.impact_category): r.spend_chf
           for r in V.impact_by_department(V.enrich_spending(df), inst).collect()}
    want = {}
    for b, _, i, _, acct in rows:
        cat = "Citizen Impact" if acct in ("30", "31", "33", "34", "35", "36", "39") else "Overhead"
        k = (f"D{int(i) % 4}", cat)
        want[k] = want.get(k, Decimal(0)) + Decimal(str(b))
    assert got == {k: float(v) for k, v in want.items()}


def test_reader_order_puts_nulls_last(spark):
    df = spark.createDataFrame([(None, "b"), (2021, "a"), (2020, "z")], "year int, start string")
    assert [r.year for r in V.for_reader(df).collect()] == [2020, 2021, None]
    assert [r.start for r in V.for_reader(df, "start").collect()] == ["a", "b", "z"]
