"""Work lists: XML search hits, final-vote documents, ordinals, grid, gaps, windows."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.functions.dates import daily_window, in_window, load_windows, ts_literal
from ledgerlens.operators.worklist import (
    coverage_gaps,
    final_vote_documents,
    final_vote_items,
    number_documents,
    parse_hits,
    pending,
    work_grid,
)

HIT = ('<Hit xmlns="http://example.org/r"><Geschaeft xmlns="http://example.org/g"><GRNr>2024/17</GRNr>'
       "<Ablaufschritte>"
       "<Aufgabe><Dokumente><Dokument><Titel>SCHLUSSabstimmung</Titel></Dokument>"
       "<Dokument><Titel>Schlussabstimmung B</Titel><File/></Dokument></Dokumente></Aufgabe>"
       "<Aufgabe><Dokumente><Dokument><File ID=\"x9\"/></Dokument>"
       "<Dokument><Titel>Antrag</Titel><File ID=\"a1\"/></Dokument>"
       "<Dokument><Titel>Die schlussabstimmung</Titel><File ID=\"f2\"/></Dokument></Dokumente></Aufgabe>"
       "<Aufgabe><Dokumente><Dokument><Titel>SCHLUSSABSTIMMUNG 2</Titel><File ID=\"f3\"/></Dokument>"
       "</Dokumente></Aufgabe>"
       "</Ablaufschritte></Geschaeft></Hit>")
NO_NUMBER = ('<Hit><Geschaeft><Titel>T</Titel><Ablaufschritte><Aufgabe><Dokumente><Dokument>'
             '<Titel>Schlussabstimmung</Titel><File ID="z"/></Dokument></Dokumente></Aufgabe>'
             "</Ablaufschritte></Geschaeft></Hit>")
NO_FINAL = ('<Hit><Geschaeft><GRNr>2024/18</GRNr><Ablaufschritte><Aufgabe><Dokumente><Dokument>'
            '<Titel>Antrag</Titel><File ID="q"/></Dokument></Dokumente></Aufgabe></Ablaufschritte></Geschaeft></Hit>')


def test_final_vote_documents_filters(spark):
    hits = parse_hits(spark.createDataFrame([(HIT,), (NO_NUMBER,), (NO_FINAL,)], "xml string"))
    items = final_vote_items(hits, year_source=2024)
    rows = items.collect()
    assert len(rows) == 1 and rows[0].grnr == "2024/17" and rows[0].titel == "No Title"
    docs = [(r.doc_titel, r.file_id) for r in final_vote_documents(items).collect()]
    assert docs == [("Die schlussabstimmung", "f2"), ("SCHLUSSABSTIMMUNG 2", "f3")]


def test_single_child_reads_as_array(spark):
    hits = parse_hits(spark.createDataFrame([(NO_FINAL,)], "xml string"))
    assert hits.select(F.size("hit.Geschaeft.Ablaufschritte.Aufgabe")).first()[0] == 1


def test_ordinals_counted_before_skipping(spark):
    items = spark.createDataFrame(
        [("2024/1", [("a", "x"), ("b", None), ("c", "y")])],
        "grnr string, pdf_files array<struct<titel:string,file_id:string>>")
    got = [(r.ordinal, r.file_id, r.pdf_filename) for r in number_documents(items).collect()]
    assert got == [(1, "x", "2024-1_abstimmung_1.pdf"), (3, "y", "2024-1_abstimmung_3.pdf")]


def test_work_grid_is_narrow(spark):
    inst = spark.createDataFrame([("0010",), ("0020",)], "institution string")
    grid = work_grid(inst, [2019, 2020])
    assert grid.count() == 2 * 2 * 3
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_coverage_gaps_and_pending(spark):
    grid = spark.createDataFrame([("1", 2019, "RECHNUNG"), ("1", 2020, "RECHNUNG")],
                                 "institution string, jahr int, betragstyp string")
    facts = spark.createDataFrame([("1", 2019, "RECHNUNG")] * 3, "institution string, jahr int, betragstyp string")
    keys = ["institution", "jahr", "betragstyp"]
    assert [tuple(r) for r in coverage_gaps(grid, facts, keys).collect()] == [("1", 2020, "RECHNUNG")]
    assert pending(grid, grid, keys).count() == 0


def test_daily_window_strict_bounds(spark):
    w = daily_window(dt.datetime(2024, 1, 11, 8, 30))
    assert (w.start, w.end, w.year_source) == (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 10, 23, 59, 59), 2024)
    df = spark.createDataFrame([("2024-01-10 00:00:00",), ("2024-01-10 12:00:00",), ("2024-01-10 23:59:59",)],
                               "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
    kept = df.filter(in_window("ts", ts_literal(w.start), ts_literal(w.end))).count()
    assert kept == 1
    both = df.filter(in_window("ts", ts_literal(w.start), ts_literal(w.end), closed="both")).count()
    assert both == 3


def test_load_windows():
    now = dt.datetime(2025, 3, 2, 10, 0)
    assert [w.year_source for w in load_windows("range", now, 2019, 2021)] == [2019, 2020, 2021]
    assert load_windows("initial", now)[0].start == dt.datetime(2019, 1, 1)
    assert load_windows("daily", now)[0].label == "Day 2025-03-01"


def test_missing_combinations_equals_grid_anti_join(spark):
    facts = spark.createDataFrame([("1", 2019, "RECHNUNG"), ("1", 2019, "RECHNUNG"), ("1", 2020, "BUDGET"),
                                   ("2", 2019, "RECHNUNG"), ("2", 1990, "RECHNUNG")],
                                  "institution string, jahr int, betragstyp string")
    inst = spark.createDataFrame([("1",), ("2",), ("3",)], "institution string")
    from ledgerlens.operators.worklist import missing_combinations
    got = missing_combinations(facts, "institution", {"jahr": [2019, 2020], "betragstyp": ["RECHNUNG", "X"]},
                               entities=inst)
    grid = work_grid(inst, [2019, 2020], ["RECHNUNG", "X"])
    want = coverage_gaps(grid, facts, ["institution", "jahr", "betragstyp"])
    cols = ["institution", "jahr", "betragstyp"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    assert got.count() == 3 + 3 + 4


def test_business_pages_of_every_shape(spark):
    from ledgerlens.operators.cleaning import clean_businesses
    from ledgerlens.operators.worklist import business_items, rejected_pages

    doc = '{"Titel": "Schlussabstimmung 1", "File": {"@ID": "f1"}}'
    pages = [
        # one hit and one document as objects, departments of both kinds, one type as a text
        ('a', '{"R": {"Hit": {"Geschaeft": {"GRNr": "2020/1", "Titel": "T", "Geschaeftsart": "Motion",'
              '"FederfuehrendesDepartement": {"Departement": "FD"},'
              '"MitbeteiligteDepartemente": {"Departement": ["SD", "TED"]},'
              '"Ablaufschritte": {"Aufgabe": {"Dokumente": {"Dokument": ' + doc + '}}}}}}}'),
        # lists, branches missing or null, a document without file, an item without number
        ('b', '{"R": {"Hit": [{"Geschaeft": {"GRNr": "2020/2", "Geschaeftsart": ["A", "B"], "Ablaufschritte": null}},'
              '{"Geschaeft": {"Titel": "no number", "Ablaufschritte": {"Aufgabe": [{"Dokumente": {"Dokument": ['
              '{"Titel": "Schlussabstimmung 2"}, ' + doc + ']}}, {}]}}}]}}'),
        ('none', '{"R": {"@numHits": "0"}}'), ('null', None), ('empty', ''), ('cut', '{"R": {"Hit": [{"Gesch'),
    ]
    df = spark.createDataFrame(pages, "dateiname string, page string")
    got = {(r.dateiname, r.grnr): r for r in business_items(df).collect()}
    assert set(got) == {("a", "2020/1"), ("b", "2020/2"), ("b", None)}
    a, b, c = got["a", "2020/1"], got["b", "2020/2"], got["b", None]
    assert (a.geschaeftsart, a.federfuehrend, a.mitbeteiligt) == (["Motion"], ["FD"], ["SD", "TED"])
    assert [(f.titel, f.file_id) for f in a.pdf_files] == [("Schlussabstimmung 1", "f1")]
    assert (b.titel, b.geschaeftsart, b.pdf_files, b.federfuehrend, b.mitbeteiligt) == ("No Title", ["A", "B"], [], [], [])
    assert (c.geschaeftsart, [f.file_id for f in c.pdf_files]) == (None, ["f1"])
    assert sorted(r.dateiname for r in rejected_pages(df).collect()) == ["cut", "empty", "null"]
    assert sorted((r.grnr, r.geschaeftsart, r.year) for r in clean_businesses(business_items(df)).collect()) == [
        ("2020/1", "Motion", 2020), ("2020/2", "A, B", 2020)]
