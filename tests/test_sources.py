"""Readers and writers on small raw-zone fixtures written to a temp folder."""

import json
import os

from pyspark.sql import functions as F

from ledgerlens.operators.cleaning import clean_accounts, clean_institutions, clean_spending, clean_votes
from ledgerlens.schemas import (
    ACCOUNT_RECORD,
    INSTITUTION_RECORD,
    SPENDING_RECORD,
    VOTE_RECORD,
)
from ledgerlens.sources import readers, writers


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_envelope_and_partition_keys_stay_strings(spark, tmp_path):
    root = tmp_path / "sachkonto2stellig"
    for inst, jahr, typ in [("0010", 2019, "RECHNUNG"), ("0020", 2020, "STADTRAT_ANTRAG")]:
        body = {"value": [{"betrag": "12.5", "betragstyp": typ, "jahr": jahr, "sachkonto": "30"},
                          {"betrag": "", "betragstyp": typ, "jahr": jahr, "sachkonto": "31"}]}
        write(str(root / f"institution={inst}" / f"jahr={jahr}" / f"betragstyp={typ}" / "data.json"),
              json.dumps(body, indent=2))
    df = readers.read_partitioned_json(spark, str(root), SPENDING_RECORD)
    assert dict(df.dtypes)["jahr"] in ("int", "string")
    rows = df.select(F.coalesce("institution", F.lit("?")).alias("i")).distinct().collect()
    # institution is not in the records: the path key fills it, leading zeros kept
    assert sorted(r.i for r in rows) == ["0010", "0020"]
    clean = clean_spending(df)
    assert sorted((r.institution, r.betrag or 0.0) for r in clean.collect()) == [
        ("0010", 0.0), ("0010", 12.5), ("0020", 0.0), ("0020", 12.5)]
    assert clean.filter("betrag IS NULL").count() == 2


def test_nested_envelopes_flatten_and_reroot(spark, tmp_path):
    dept = {"key": "D1", "bezeichnung": "Bau", "kurzname": "BD"}
    inst = {"key": "0010", "bezeichnung": "Tiefbau", "kurzname": "TA", "departement": dept}
    write(str(tmp_path / "inst" / "i.json"), json.dumps({"value": [inst, {"key": "0020"}]}, indent=2))
    write(str(tmp_path / "konten" / "k.json"),
          json.dumps({"value": [{"id": 7, "kontoNr": "3000", "bezeichnung": "Lohn", "institution": inst}]}))
    i = clean_institutions(readers.read_envelope(spark, str(tmp_path / "inst"), INSTITUTION_RECORD))
    assert i.columns == ["bezeichnung", "departement.bezeichnung", "departement.key",
                         "departement.kurzname", "key", "kurzname"]
    rows = {r.key: tuple(r) for r in i.collect()}
    assert rows["0010"] == ("Tiefbau", "Bau", "D1", "BD", "0010", "TA")
    assert rows["0020"] == (None, None, None, None, "0020", None)
    a = clean_accounts(readers.read_envelope(spark, str(tmp_path / "konten"), ACCOUNT_RECORD))
    r = a.first()
    assert (r["departement.key"], r["institution.key"], r["id"]) == ("D1", "0010", 7)


def test_vote_records_multiline_array_case_insensitive(spark, tmp_path):
    recs = [{"Dateiname": "a.pdf", "Geschäftsnummer": "2020/5", "JA": 3},
            {"Dateiname": "b.pdf", "Geschäftsnummer": "", "JA": 1}]
    write(str(tmp_path / "votes" / "abstimmungen_alle.json"), json.dumps(recs, indent=2))
    v = clean_votes(readers.read_records(spark, str(tmp_path / "votes"), VOTE_RECORD))
    assert [(r.geschaeftsnummer, r.ja, r.year) for r in v.collect()] == [("2020/5", 3, 2020)]


def test_survey_csv_quoted_newlines_and_glob(spark, tmp_path):
    write(str(tmp_path / "s" / "survey.csv"), 'Jahr,methode,A2001aa01\n2019,"online\nweb","Note 2"\n2021,,x\n')
    write(str(tmp_path / "s" / "codes.txt"), "not,a,survey\n")
    write(str(tmp_path / "s" / "bevoelkerung_survey_code.csv"), "Jahr,methode,A2001aa01\n1,2,3\n")
    df = readers.read_survey_csv(spark, str(tmp_path / "s"), glob="survey.csv")
    rows = sorted((tuple(r) for r in df.collect()), key=str)
    assert rows == [("2019", "online\nweb", "Note 2"), ("2021", None, "x")]


def test_business_xml_file(spark, tmp_path):
    xml = ('<resp xmlns="http://example.org/r"><Hit><Geschaeft xmlns="http://example.org/g"><GRNr>2024/1</GRNr>'
           "<Ablaufschritte><Aufgabe><Dokumente><Dokument><Titel>Schlussabstimmung</Titel>"
           '<File ID="f1"/></Dokument></Dokumente></Aufgabe></Ablaufschritte></Geschaeft></Hit>'
           "<Hit><Geschaeft><GRNr>2024/2</GRNr></Geschaeft></Hit></resp>")
    write(str(tmp_path / "x" / "page_1.xml"), xml)
    from ledgerlens.operators.worklist import final_vote_items
    hits = readers.read_business_xml(spark, str(tmp_path / "x"))
    assert hits.count() == 2
    items = final_vote_items(hits, year_source=2024).collect()
    assert [(r.grnr, r.pdf_files[0].file_id) for r in items] == [("2024/1", "f1")]


def test_document_listing_suffix_any_case(spark, tmp_path):
    for name in ["a.pdf", "b.PDF", "c.txt", "sub/d.Pdf", "e#1.pdf"]:
        write(str(tmp_path / "pdf" / name), "x")
    got = sorted(r.dateiname for r in readers.list_documents(spark, str(tmp_path / "pdf")).collect())
    assert got == ["a.pdf", "b.PDF", "d.Pdf", "e#1.pdf"]


def test_writers_roundtrip_and_dynamic_overwrite(spark, tmp_path):
    df = spark.createDataFrame([("1", 2019, 1.0), ("2", 2020, 2.0)], "institution string, jahr int, betrag double")
    p = str(tmp_path / "part")
    writers.write_partitioned(df, p, ["jahr"], fmt="parquet")
    writers.write_partitioned(spark.createDataFrame([("3", 2020, 3.0)], df.schema), p, ["jahr"], fmt="parquet")
    back = readers.read_partitioned_parquet(spark, p)
    assert sorted((r.institution, r.jahr) for r in back.collect()) == [("1", "2019"), ("3", "2020")]
    c = str(tmp_path / "csv")
    writers.write_csv(spark.createDataFrame([("a\nb", 'say "hi"')], "x string, y string"), c)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(c)
    assert tuple(back.first()) == ("a\nb", 'say "hi"')
    j = str(tmp_path / "json")
    writers.write_json(df, j)
    assert spark.read.json(j).count() == 2


def test_clean_table_with_catalog(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "x int")
    writers.write_clean(df, str(tmp_path / "t"), table="ledgerlens_test_clean")
    assert spark.table("ledgerlens_test_clean").count() == 1
    spark.sql("DROP TABLE ledgerlens_test_clean")


def test_corrupt_records_are_kept_aside(spark, tmp_path):
    write(str(tmp_path / "items" / "a.json"), '{"institution": "0010", "jahr": 2020, "betragstyp": "RECHNUNG"}\n'
          '{"institution": "0020", "jahr": \n')
    from ledgerlens.schemas import WORK_ITEM
    df = readers.read_records(spark, str(tmp_path / "items"), WORK_ITEM, multiline=False,
                              corrupt_column="_corrupt_record")
    rows = sorted(df.collect(), key=lambda r: str(r.institution))
    good = [r for r in rows if r._corrupt_record is None]
    bad = [r for r in rows if r._corrupt_record is not None]
    assert [(r.institution, r.jahr) for r in good] == [("0010", 2020)]
    assert len(bad) == 1 and bad[0].institution is None
    assert bad[0]._corrupt_record.startswith('{"institution": "0020"')


def test_business_xml_a_hit_a_line_without_a_root(spark, tmp_path):
    from ledgerlens.operators.worklist import document_items

    hit = ("<Hit><Geschaeft><GRNr>{}</GRNr><Ablaufschritte><Aufgabe><Dokumente><Dokument><Titel>t</Titel>"
           "</Dokument></Dokumente></Aufgabe></Ablaufschritte></Geschaeft></Hit>\n")
    (tmp_path / "a.xml").write_text(hit.format(1) + hit.format(2) + hit.format(3))
    items = document_items(readers.read_business_xml(spark, str(tmp_path), multiline=False)).collect()
    assert sorted((r.grnr, [tuple(f) for f in r.pdf_files]) for r in items) == [(str(i), [("t", None)]) for i in (1, 2, 3)]


def test_envelope_lines_and_blanks_in_csv(spark, tmp_path):
    from pyspark.sql.types import StringType, StructField, StructType

    record = StructType([StructField("a", StringType())])
    (tmp_path / "e.json").write_text('{"value": [{"a": "1"}, {"a": "2"}]}\n{"value": [{"a": "3"\n{"value": []}\n')
    got = readers.read_envelope(spark, str(tmp_path), record, multiline=False).collect()
    assert sorted(r.a for r in got) == ["1", "2"]
    assert [r.raw for r in readers.envelope_rejects(spark, str(tmp_path), record, multiline=False).collect()] == ['{"value": [{"a": "3"']
    rows = [(" a ",), ("\tb\n",), ('q"',)]
    writers.write_csv(spark.createDataFrame(rows, "t string"), str(tmp_path / "csv"))
    back = readers.read_survey_csv(spark, str(tmp_path / "csv"), glob="*.csv", columns=["t"])
    assert sorted(r.t for r in back.collect()) == sorted(t for t, in rows)


def test_append_pending_adds_each_key_once(spark, tmp_path):
    p = str(tmp_path / "sink")
    work = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    writers.append_pending(work, work.limit(0), ["k"], p)
    for _ in range(2):
        writers.append_pending(work.unionByName(spark.createDataFrame([(3, "c")], "k int, v string")),
                               spark.read.parquet(p), ["k"], p)
    assert sorted(tuple(r) for r in spark.read.parquet(p).collect()) == [(1, "a"), (2, "b"), (3, "c")]
