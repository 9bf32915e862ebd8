"""Protocol and questionnaire extraction, edge rows."""

from ledgerlens.operators.extract import extract_protocol, extract_questions, split_pages


def protocol(spark, text):
    df = spark.createDataFrame([("d.pdf", 1, text)], "doc string, page_no int, text string")
    return extract_protocol(df).collect()[0]


def test_title_over_two_lines(spark):
    r = protocol(spark, "Geschäftstitel:  Kredit für\nneue Schule \nGeschäfts#: 2020/123\n")
    assert r["Geschäftstitel"] == "Kredit für neue Schule"
    assert r["Geschäftsnummer"] == "2020/123"


def test_counters(spark):
    assert protocol(spark, "JA: 5\nNEIN: 7")["JA"] == 5
    r = protocol(spark, "JA: x\nNEIN: 7")
    assert r["JA"] is None and r["NEIN"] == 7
    r = protocol(spark, "nothing here")
    assert r["JA"] is None and r["Total_Stimmen"] is None and r["Geschäftstitel"] is None


def test_date_and_time_kept_as_text(spark):
    r = protocol(spark, "Stimm-Datum: 01.03.2020\nStimm-Zeit: 10:15:00")
    assert (r["Stimm_Datum"], r["Stimm_Zeit"]) == ("01.03.2020", "10:15:00")


def test_tie_breaker_three_states(spark):
    assert protocol(spark, "Stichentscheid: Präsidentin Muster")["Stichentscheid"] == "Präsidentin Muster"
    assert protocol(spark, "Stichentscheid:\nStadt Zürich")["Stichentscheid"] == ""
    assert protocol(spark, "JA: 3")["Stichentscheid"] is None


def test_only_first_page_is_read(spark):
    df = spark.createDataFrame([("d", 1, "JA: 1"), ("d", 2, "JA: 2")], "doc string, page_no int, text string")
    assert [r["JA"] for r in extract_protocol(df).collect()] == [1]


def test_context_fills_missing_number(spark):
    df = spark.createDataFrame([("d", 1, "JA: 1", "2021/7"), ("e", 1, "Geschäfts#: 2020/1", "2021/8")],
                               "doc string, page_no int, text string, ctx string")
    got = sorted(r["Geschäftsnummer"] for r in extract_protocol(df, context="ctx").collect())
    assert got == ["2020/1", "2021/7"]


def questions(spark, pages):
    df = spark.createDataFrame([("2023", i + 1, t) for i, t in enumerate(pages)],
                               "year string, page int, text string")
    return [(r.page, r.id, r.text) for r in extract_questions(df).collect()]


def test_question_continuation_rules(spark):
    got = questions(spark, ["F1. A\nb\nc\nF2a. X\n☐ y\nS3.Z\n  S4. last  "])
    assert got == [(1, "F1", "A b"), (1, "F2a", "X"), (1, "S4", "last")]


def test_question_followed_by_question(spark):
    assert questions(spark, ["F1. A\nF2. B"]) == [(1, "F1", "A"), (1, "F2", "B")]


def test_question_pages_count_empty_pages(spark):
    df = spark.createDataFrame([("2019", "cover\f\fF7. Wie zufrieden\nsind Sie?")], "year string, text string")
    got = [(r.page, r.id, r.text) for r in extract_questions(split_pages(df)).collect()]
    assert got == [(3, "F7", "Wie zufrieden sind Sie?")]


def test_extraction_has_no_exchange(spark):
    df = spark.createDataFrame([("2019", 1, "F1. A")], "year string, page int, text string")
    plan = extract_questions(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    pdf = spark.createDataFrame([("d", 1, "JA: 1")], "doc string, page_no int, text string")
    plan = extract_protocol(pdf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
