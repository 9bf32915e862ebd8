"""The fixture's survey answers: looked up in a constant list, with the rows of the rule as it is told."""

from pyspark.sql import functions as F

from ledgerlens import bindings as B
from ledgerlens.operators.cleaning import clean_survey
from ledgerlens.schemas import survey_answer_columns


def _events(spark, ids):
    return spark.createDataFrame([(i, 3, "click", 1.5) for i in ids],
                                 "event_id long, user_id long, event_type string, value double")


def _label(n):
    if n is None or n == 0:
        return None
    return {1: B._LABEL_1, 6: B._LABEL_6, 7: "weiss nicht"}.get(n, f"Note {n}")


def test_answers_by_hand(spark):
    ids = [0, 1, 2, 7, 8, 13, 10**12 + 3, -1, -5, -8, -401, -(10**12), None]
    names = survey_answer_columns()
    rows = clean_survey(B.raw_survey_from_events(_events(spark, ids))).collect()
    assert len(rows) == len(ids)
    for i, row in zip(ids, rows):
        for j, c in enumerate(names):
            # Spark's remainder has the sign of the dividend
            n = None if i is None else (abs(i + j) % 8) * (1 if i + j >= 0 else -1)
            assert row[c] == _label(n), (i, j)


def test_no_text_is_built_for_each_answer(spark):
    df = clean_survey(B.raw_survey_from_events(_events(spark, [1])))
    last = df.select(F.col(survey_answer_columns()[-1]).alias("x"))
    plan = last._jdf.queryExecution().optimizedPlan().toString()
    assert "concat" not in plan and "CASE" not in plan
