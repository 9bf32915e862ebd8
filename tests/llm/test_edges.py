"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import decontam, jaccard, langid, linecrf, linededup, mixing, pii, puquality, toxicity, warc
from ledgerlens.llm._spark import ship

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, doc string, key string, "
          "n_links int, copy string, held_out string, label string, row string")
LONG = " ".join(f"word{i % 977} ({i}) a@b{i}.org" for i in range(30000))


def rows():
    t = "one two three four five six\nseven eight nine ten\neleven twelve thirteen"
    texts = [None, "", " \n\t ", "a", "###", "1", t, t, LONG, "日本語 の テキスト", "x" * 200_000, "\n".join(["same line"] * 500)]
    out = [(i, x, None if i % 4 == 0 else "en", None if i % 5 == 0 else "s") for i, x in enumerate(texts)]
    out += [out[6], (None, t, "de", "s"), (None, None, None, None), (6, "another text of one id", "de", "s")]
    return [(*r, 1, 0.5, "d", "k", 3, "c", "h", "l", "r") for r in out]


@pytest.fixture(scope="module")
def full(spark):
    ship(spark)
    return spark.createDataFrame(rows(), SCHEMA)


LABELS = [(6, 1, 0), (7, 1, 0), (3, 0, 1), (3, 1, 1), (None, 1, 1), (4, None, None)]


def run_all(spark, d, labels):
    bench = spark.createDataFrame([(1, "three four five six seven eight nine ten eleven twelve"), (None, "a"), (2, None)],
                                  "item_id long, text string")
    pages = d.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"), "key", "doc")
    return {
        "jaccard": jaccard.jaccard_join(d), "mixing": mixing.mix(d), "pii": pii.find(d, pii.fit(d)),
        "warc": warc.archive_round_trip(pages), "pu": puquality.predict(d, puquality.fit(d, labels)),
        "rules": linecrf.predict(d, linecrf.fit(d)), "decontam": decontam.decontaminate(d, bench),
        "toxicity": toxicity.predict(d, toxicity.fit(d, labels)), "langid": langid.predict(d, langid.fit(d)),
        "lines": linededup.dedup_lines(d)}


def test_every_operator_on_awkward_rows(spark, full):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    n = len(rows())
    got = {k: v.collect() for k, v in run_all(spark, full, labels).items()}
    for name, found in got.items():
        if name != "mixing":
            assert len(found) == n, name
    by = {r.doc_id: r for r in got["jaccard"] if r.doc_id is not None}
    assert by[0].n_links == by[1].n_links == by[2].n_links == 0 and by[0].class_id == 0
    assert by[7].class_id == 6 and by[7].n_links == 3  # 6 twice, and the null id
    lang = {r.doc_id: r for r in got["langid"]}
    assert all(lang[i].lang_pred == "und" and lang[i].score == 0 for i in (0, 1, 2, 4, 5))
    assert lang[9].lang_pred != "und"  # it has letters
    hit = {r.doc_id: r for r in got["decontam"]}
    assert hit[0].n_words == 0 and hit[7].n_hit == 10 and hit[7].item_ids == ["1"]
    assert hit[3].n_hit == 1 and hit[3].item_ids == []  # the item has no id
    rules = {r.doc_id: r for r in got["rules"]}
    assert rules[0].base_failed and not rules[0].kept and rules[11].n_dup_lines == 499
    lines = {r.doc_id: r for r in got["lines"]}
    assert lines[0].text is None and lines[0].n_lines == 0 and lines[1].text == ""
    assert lines[11].text == "same line" and lines[11].n_removed == 499
    assert all(0 <= r.score <= 1 for k in ("pu", "toxicity") for r in got[k])


def test_every_operator_on_empty_tables(spark, full):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for name, found in run_all(spark, full.limit(0), labels).items():
        assert found.count() == 0, name


def test_long_numeric_text_is_linear():
    text = "12 " * 40000 + "1." * 20000 + "a" * 50000 + "@" + "9" * 50000
    found = pii.base_spans(text)
    assert len(found) == 5000 and {k for _, _, k in found} == {"ip"}  # 1.1.1.1, again and again
