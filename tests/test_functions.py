"""Edge rows of the field functions (expected values written by hand)."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.functions.scoring import float_score, impact_category, score
from ledgerlens.functions.text import field, leading_year, list_to_text, non_empty, ustrip
from ledgerlens.operators.mapping import apply_mapping
from ledgerlens.schemas import SPENDING_MAPPING


def col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_leading_year(spark):
    df = col(spark, ["2019/12", "GR12/3", "", None])
    assert [r[0] for r in df.select(leading_year("x")).collect()] == [2019, None, None, None]


def test_non_empty_rule(spark):
    df = col(spark, ["a", "", "\nab", "\rab", None])
    kept = [r[0] for r in df.filter(non_empty("x")).collect()]
    assert kept == ["a", "\rab"]


def test_amount_cast(spark):
    raw = spark.createDataFrame([("12.5",), ("",), (None,)], "betrag string")
    out = apply_mapping(raw, SPENDING_MAPPING)
    assert out.columns == ["betrag", "betragstyp", "institution", "jahr", "sachkonto"]
    assert [r.betrag for r in out.collect()] == [12.5, None, None]
    assert dict(out.dtypes)["betrag"] == "double" and dict(out.dtypes)["jahr"] == "int"


def test_account_class(spark):
    df = col(spark, ["30", "32", "37", None, " 30"])
    got = [r[0] for r in df.select(impact_category("x")).collect()]
    assert got == ["Citizen Impact", "Overhead", "Overhead", "Overhead", "Overhead"]


def test_score_labels(spark):
    df = col(spark, ["Note 1 (überhaupt nicht gut)", "Note 6 (sehr gut)", "Note 6", "weiss nicht", None])
    assert [r[0] for r in df.select(score("x")).collect()] == [1, 6, None, None, None]
    assert [r[0] for r in df.select(float_score("x")).collect()] == [1.0, 6.0, None, None, None]


def test_list_to_text(spark):
    df = spark.createDataFrame([(["A", "B, C"],), (["A [x]"],), (None,)], "x array<string>")
    assert [r[0] for r in df.select(list_to_text("x")).collect()] == ["A, B, C", "A x", None]


def test_field_is_null_without_match(spark):
    df = col(spark, ["JA: 5", "JA: x", "nothing"])
    got = [r[0] for r in df.select(field("x", r"JA:\s*(\d+)")).collect()]
    assert got == ["5", None, None]


WS = st.sampled_from([" ", "\t", "\n", "\r", " ", " ", "\x0b", "\x0c", "a", "b", "é", "."])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(WS, max_size=8), min_size=1, max_size=8))
def test_ustrip_and_non_empty_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    rows = df.select("x", ustrip("x").alias("s"), non_empty("x").alias("ne")).collect()
    for r in rows:
        # Python's str.strip also strips \x1c-\x1f; none occur in the alphabet above.
        assert r.s == r.x.strip()
        assert r.ne == bool(re.match(".+", r.x))
