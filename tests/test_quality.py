"""One-pass data-quality evaluation."""

import pytest

from ledgerlens.operators import quality as Q
from ledgerlens.operators.cleaning import clean_and_check


def test_nulls_pass_value_range_but_fail_completeness(spark):
    df = spark.createDataFrame([(None,), (None,), (2020,)], "year int")
    rep = {r.rule: (r.metric, r.outcome) for r in
           Q.evaluate(df, [Q.Completeness("year", 0.95), *Q.ValueRange("year", 1900, 2100)]).collect()}
    assert rep['Completeness "year" >= 0.95'] == (pytest.approx(1 / 3), "Failed")
    assert rep['ColumnValues "year" >= 1900'] == (2020.0, "Passed")
    assert rep['ColumnValues "year" <= 2100'] == (2020.0, "Passed")


def test_counts_and_dotted_names(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None)], "key string, `departement.key` string")
    rules = [Q.ColumnCount(0), Q.RowCount(0), Q.DistinctCount("key", 0), Q.Completeness("departement.key", 0.9)]
    rep = [(r.rule_no, r.metric, r.outcome) for r in Q.evaluate(df, rules).orderBy("rule_no").collect()]
    assert rep == [(1, 2.0, "Passed"), (2, 2.0, "Passed"), (3, 1.0, "Passed"), (4, 0.5, "Failed")]


def test_empty_input_fails_row_count_and_completeness(spark):
    df = spark.createDataFrame([], "key string")
    rep = {r.rule: r.outcome for r in Q.evaluate(df, [Q.RowCount(0), Q.Completeness("key", 0.5)]).collect()}
    assert set(rep.values()) == {"Failed"}


def test_on_fail_error_raises_but_report_does_not(spark):
    df = spark.createDataFrame([(None,)], "grnr string")
    Q.evaluate(df, [Q.Completeness("grnr", 0.98)])  # report only
    with pytest.raises(Q.DataQualityError):
        Q.evaluate(df, [Q.Completeness("grnr", 0.98)], on_fail="error")


def test_single_aggregate_pass(spark):
    df = spark.createDataFrame([(1, "a")], "id int, kontoNr string")
    plan = Q.evaluate(df, Q.ACCOUNT_RULES)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") <= 2  # the distinct count adds one level, no second scan
    assert plan.count("LogicalRDD") == 1  # one scan of the data


def test_missing_column_fails_the_rule(spark):
    df = spark.createDataFrame([(1,)], "id int")
    rep = Q.evaluate(df, [Q.Completeness("nope", 0.5), Q.RowCount(0)]).orderBy("rule_no").collect()
    assert [(r.metric, r.outcome) for r in rep] == [(None, "Failed"), (1.0, "Passed")]


def test_clean_and_check_passes_rows_through(spark):
    raw = spark.createDataFrame([("1.5", "RECHNUNG", "1", 2020, "30")],
                                "betrag string, betragstyp string, institution string, jahr int, sachkonto string")
    clean, rep = clean_and_check("spending", raw)
    assert clean.count() == 1 and rep.filter("outcome = 'Failed'").count() == 0


def test_clean_job_observes_metrics_during_write(spark, tmp_path):
    from ledgerlens.operators.cleaning import run_clean_job
    raw = spark.createDataFrame([("1.5", "RECHNUNG", "1", 2020, "30"), ("", "RECHNUNG", None, 2021, "31")],
                                "betrag string, betragstyp string, institution string, jahr int, sachkonto string")
    rep = run_clean_job("spending", raw, str(tmp_path / "clean"), results_path=str(tmp_path / "dq"), run_id="t1")
    got = {r.rule: (r.metric, r.outcome) for r in rep.collect()}
    assert got['Completeness "betrag" >= 0.95'] == (0.5, "Failed")
    assert got['DistinctValuesCount "sachkonto" > 0'] == (2.0, "Passed")
    assert got["RowCount > 0"] == (2.0, "Passed") and got["ColumnCount > 0"] == (5.0, "Passed")
    assert sorted(r.rule_no for r in rep.collect()) == list(range(1, 11))
    assert spark.read.parquet(str(tmp_path / "clean")).count() == 2
    assert spark.read.parquet(str(tmp_path / "dq")).filter("run_id = 't1'").count() == 10
    same = {r.rule: (r.metric, r.outcome) for r in Q.evaluate(
        spark.read.parquet(str(tmp_path / "clean")), Q.SPENDING_RULES).collect()}
    assert same == got


def test_error_mode_writes_nothing(spark, tmp_path):
    from ledgerlens.operators.cleaning import run_clean_job
    raw = spark.createDataFrame([("", "RECHNUNG", None, 2021, None)],
                                "betrag string, betragstyp string, institution string, jahr int, sachkonto string")
    with pytest.raises(Q.DataQualityError):
        run_clean_job("spending", raw, str(tmp_path / "clean"), on_fail="error")
    import os
    assert not os.path.exists(str(tmp_path / "clean"))
