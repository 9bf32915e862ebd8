"""Rows, files and parts of a cent that must not get lost without a word."""

import json

from pyspark.sql import functions as F

from ledgerlens.functions.text import ustrip
from ledgerlens.operators.worklist import missing_combinations, rejected_hits
from ledgerlens.plans import views as V
from ledgerlens.session import apply_defaults
from ledgerlens.sources import readers
from ledgerlens.streaming.incremental import read_sink, run_incremental


def test_entities_without_a_fact_in_the_grid_keep_their_gaps(spark):
    facts = spark.createDataFrame([("a", 2020), ("b", 1999), ("c", None)], "e string, y int")
    got = sorted((r.e, r.y) for r in missing_combinations(facts, "e", {"y": [2020, 2021]}).collect())
    assert got == [("a", 2021), ("b", 2020), ("b", 2021), ("c", 2020), ("c", 2021)]


def test_small_and_large_amounts(spark):
    df = spark.createDataFrame([(0.004,)] * 1000 + [(1e17,)], "x double")
    assert df.filter("x < 1").agg(V.money_sum("x").alias("s")).first().s == 4.0
    assert df.filter("x > 1").agg(V.money_sum("x").alias("s")).first().s == 1e17


def test_a_repeated_institution_does_not_double_the_money(spark):
    facts = spark.createDataFrame([("i", "c", 10.0)], "institution string, impact_category string, betrag double")
    dim = spark.createDataFrame([("i", "D")] * 2, "key string, `departement.bezeichnung` string")
    assert [r.spend_chf for r in V.impact_by_department(facts, dim).collect()] == [10.0]
    assert [tuple(r) for r in V.repeated_institutions(dim).collect()] == [("i", 2)]


def test_cut_off_files_and_hits_are_reported(spark, tmp_path):
    from pyspark.sql.types import StringType, StructField, StructType

    (tmp_path / "ok.json").write_text(json.dumps({"value": [{"a": "1"}]}))
    (tmp_path / "cut.json").write_text('{"value": [{"a": "2"')
    record = StructType([StructField("a", StringType())])
    assert readers.read_envelope(spark, str(tmp_path), record).count() == 1
    assert [r.path.rsplit("/", 1)[-1] for r in readers.envelope_rejects(spark, str(tmp_path), record).collect()] == ["cut.json"]
    hits = spark.createDataFrame([(1, "<Hit><Geschaeft><GRNr>1</GRNr></Geschaeft></Hit>"), (2, "<Hit><Geschaeft><GRNr>1</GR")],
                                 "id int, xml string")
    assert [r.id for r in rejected_hits(hits).collect()] == [2]


def test_the_count_covers_every_batch_and_a_new_checkpoint_replaces_nothing(spark, tmp_path):
    src, sink = str(tmp_path / "in"), str(tmp_path / "out")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        schema = spark.range(8).select(F.col("id")).schema
        spark.range(8, numPartitions=8).write.parquet(src)
        assert run_incremental(spark, src, schema, lambda d: d, sink, str(tmp_path / "c1"), max_files_per_trigger=1) == 8
        other = str(tmp_path / "in2")
        spark.range(100, 101).write.parquet(other)
        assert run_incremental(spark, other, schema, lambda d: d, sink, str(tmp_path / "c2")) == 1
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert sorted(r.id for r in read_sink(spark, sink).collect()) == [*range(8), 100]


def test_strip_is_pythons_and_linear(spark):
    texts = ["\x1c a \u3000", "a" + " " * 200_000 + "b", "\t\n", "", "\xa0x\x85"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.s for r in df.select(ustrip("t").alias("s")).collect()] == [t.strip() for t in texts]


def test_settings_of_the_session_stay(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Europe/Zurich")
    apply_defaults(other)
    assert other.conf.get("spark.sql.session.timeZone") == "Europe/Zurich"
