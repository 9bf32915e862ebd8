"""Jobs that run again: partitions, metrics, results, sketches, landings, views, trees."""

import datetime as dt
import json
import threading

import pytest
from pyspark.sql import functions as F

from ledgerlens import bindings as B
from ledgerlens.operators import landing, quality as Q, sketches
from ledgerlens.operators.cleaning import CLEAN_JOBS, run_clean_job
from ledgerlens.operators.worklist import (
    Days,
    Values,
    business_items,
    department_bridge,
    hit_businesses,
    missing_combinations,
    parse_hits,
)
from ledgerlens.plans import catalog, catalog_views
from ledgerlens.schemas import SPENDING_RECORD
from ledgerlens.sources import readers
from ledgerlens.streaming.incremental import read_sink, run_incremental

SPENDING = "betrag string, betragstyp string, institution string, jahr int, sachkonto string"
SF = "/root/testdata/sf0.001"


@pytest.fixture
def static_mode(spark):
    """Spark's own default, which a cluster may also have set."""
    was = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    yield
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", was)


def landing_of(spark, year, accounts):
    return spark.createDataFrame([("1.5", "RECHNUNG", "1", year, a) for a in accounts], SPENDING)


def metric(report, rule):
    return {r.rule: r.metric for r in report.collect()}[rule]


@pytest.mark.parametrize("on_fail", ["report", "error"])
def test_two_years_one_after_the_other(spark, tmp_path, static_mode, on_fail):
    p, results = str(tmp_path / "clean"), str(tmp_path / "dq")
    a = run_clean_job("spending", landing_of(spark, 2020, ["30", "31", "32"]), p, partition_by=["jahr"], on_fail=on_fail,
                      results_path=results, run_id="a", sketches_path=str(tmp_path / "sk"))
    b = run_clean_job("spending", landing_of(spark, 2021, ["40"]), p, partition_by=["jahr"], on_fail=on_fail,
                      results_path=results, run_id="b", sketches_path=str(tmp_path / "sk"))
    for report, n in ((a, 3.0), (b, 1.0)):
        assert metric(report, "RowCount > 0") == metric(report, 'DistinctValuesCount "sachkonto" > 0') == n
    c = run_clean_job("spending", landing_of(spark, 2020, ["30", "31"]), p, partition_by=["jahr"], on_fail=on_fail,
                      results_path=results, run_id="a", sketches_path=str(tmp_path / "sk"))
    assert metric(c, 'DistinctValuesCount "sachkonto" > 0') == 2.0
    assert sorted((int(r.jahr), r.sachkonto) for r in spark.read.parquet(p).collect()) == [(2020, "30"), (2020, "31"), (2021, "40")]
    # the results table has each run once, the later report of run a
    rows = Q.read_results(spark, results).filter("rule = 'RowCount > 0'").collect()
    assert sorted((r.context, r.run_id, r.metric) for r in rows) == [("spending", "a", 2.0), ("spending", "b", 1.0)]
    stored = sketches.read_sketches(spark, str(tmp_path / "sk"), ["jahr"])
    assert [tuple(r) for r in sketches.distinct_counts(stored).collect()] == [("sachkonto", 3, 3)]
    assert sorted(tuple(r) for r in sketches.distinct_counts(stored, ["jahr"]).collect()) == [
        ("2020", "sachkonto", 2, 2), ("2021", "sachkonto", 1, 1)]


def test_error_mode_keeps_what_was_there(spark, tmp_path, static_mode):
    p = str(tmp_path / "clean")
    run_clean_job("spending", landing_of(spark, 2020, ["30"]), p, partition_by=["jahr"], on_fail="error")
    bad = spark.createDataFrame([("", "RECHNUNG", None, 2020, None)], SPENDING)
    with pytest.raises(Q.DataQualityError):
        run_clean_job("spending", bad, p, partition_by=["jahr"], on_fail="error", results_path=str(tmp_path / "dq"))
    assert [r.sachkonto for r in spark.read.parquet(p).collect()] == ["30"]
    assert Q.read_results(spark, str(tmp_path / "dq")).filter("outcome = 'Failed'").count() > 0  # reported all the same


def test_a_run_without_rows(spark, tmp_path, static_mode):
    p = str(tmp_path / "clean")
    run_clean_job("spending", landing_of(spark, 2020, ["30"]), p, partition_by=["jahr"])
    none = run_clean_job("spending", landing_of(spark, 2020, ["30"]).limit(0), p, partition_by=["jahr"])
    assert metric(none, "RowCount > 0") == metric(none, 'DistinctValuesCount "sachkonto" > 0') == 0.0
    assert spark.read.parquet(p).count() == 1


def test_null_and_empty_partitions(spark, tmp_path, static_mode):
    p = str(tmp_path / "clean")
    raw = spark.createDataFrame([("1", None, "1", 2020, "30"), ("1", "", "1", 2020, "31"), ("1", "a\nb", "1", 2020, "32")], SPENDING)
    report = run_clean_job("spending", raw, p, partition_by=["betragstyp"])
    assert metric(report, 'DistinctValuesCount "sachkonto" > 0') == 3.0
    assert spark.read.parquet(p).count() == 3


def test_distinct_rules_only(spark, tmp_path, monkeypatch):
    fn, _ = CLEAN_JOBS["spending"]
    monkeypatch.setitem(CLEAN_JOBS, "spending", (fn, [Q.DistinctCount("sachkonto", 0)]))
    report = run_clean_job("spending", landing_of(spark, 2020, ["30", "31"]), str(tmp_path / "clean"))
    assert [(r.rule_no, r.metric, r.outcome) for r in report.collect()] == [(1, 2.0, "Passed")]


def test_a_catalogue_table_keeps_its_partitions(spark, tmp_path, static_mode):
    p, table = str(tmp_path / "clean"), catalog._fresh("reruns")
    for year, accounts in ((2020, ["30", "31"]), (2021, ["40"]), (2020, ["50"])):
        run_clean_job("spending", landing_of(spark, year, accounts), p, partition_by=["jahr"], table=table)
    assert sorted((r.jahr, r.sachkonto) for r in spark.newSession().table(table).collect()) == [(2020, "50"), (2021, "40")]


def test_publishing_again_replaces_and_failure_does_not_block(spark, tmp_path):
    report = Q.evaluate(landing_of(spark, 2020, ["30"]), Q.SPENDING_RULES)
    for _ in range(2):
        assert Q.publish_report(report, str(tmp_path / "dq"), context="c", run_id="0010")
    got = Q.read_results(spark, str(tmp_path / "dq"))
    assert got.count() == 10 and {r.run_id for r in got.collect()} == {"0010"}
    assert not Q.publish_report(report, "nowhere://x/y", context="c", run_id="r")


def test_sketches_stay_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("part"), (F.col("id") % 45_000).alias("x"),
                                    F.when(F.col("id") % 2 == 0, F.col("id")).alias("y"))
    got = {r.column: (r.n_rows, r.distinct_values) for r in sketches.distinct_counts(sketches.sketches(df, ["x", "y"], ["part"])).collect()}
    for c, exact in (("x", 45_000), ("y", 30_000)):
        assert got[c][0] == 60_000 and abs(got[c][1] - exact) <= sketches.error() * exact
    assert sketches.distinct_counts(sketches.sketches(df.limit(0), ["x"], ["part"])).count() == 0


def test_rejects_and_records_from_one_pass(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [json.dumps({"value": [{"nr": 1, "titel": "a"}, {"nr": 2, "titel": None}]}), '{"value": [{"nr": 3', "", '{"value": null}', "[1"]
    (tmp_path / "in" / "x.json").write_text("\n".join(lines))
    out = str(tmp_path / "landed")
    n, schema = landing.land_envelopes(spark, str(tmp_path / "in"), catalog.ENVELOPE_RECORD, out, multiline=False)
    bad = landing.rejects(spark, out, schema)
    assert (n.read, n.good, n.rejected) == (5, 5 - bad.count(), bad.count()) and n.good + n.rejected == n.read
    assert {'{"value": [{"nr": 3', "[1"} <= {r.raw for r in bad.collect()}
    assert sorted((r.nr, r.titel) for r in landing.envelope_records(spark, out, schema).collect()) == [(1, "a"), (2, None)]


def test_hits_are_parsed_once(spark, tmp_path):
    hits = spark.createDataFrame([(1, "<Hit><Geschaeft><GRNr>1</GRNr></Geschaeft></Hit>"), (2, "<Hit><Geschaeft><GRNr>1</GR"), (3, None)],
                                 "id int, xml string")
    src = str(tmp_path / "hits")
    hits.write.parquet(src)
    from ledgerlens.schemas import HIT_XML
    routed = landing.route(spark.read.parquet(src), "xml", landing.xml_parser(HIT_XML), HIT_XML, keep=("id",))
    plan = routed.filter("status = 'good'").select("id", "parsed")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("from_xml") + plan.count("xmltostructs") <= 1
    n, schema = landing.land_hits(spark.read.parquet(src), str(tmp_path / "out"), keep=("id",))
    assert (n.read, n.good, n.rejected) == (3, 1, 2)
    assert [r.id for r in landing.good(spark, str(tmp_path / "out"), schema).collect()] == [1]


def test_ten_years_of_days_plan_at_once(spark):
    day = dt.date(2014, 1, 1)
    facts = spark.createDataFrame([("a", day + dt.timedelta(days=i), f"t{i % 20}") for i in range(3650)] + [("b", None, "t1"), ("c", day, "x")],
                                  "u string, day date, kind string")
    import time
    t = time.time()
    types = Values([f"t{i}" for i in range(20)])
    got = missing_combinations(facts, "u", {"day": Days(day, day + dt.timedelta(days=3649)), "kind": types})
    got._jdf.queryExecution().executedPlan()
    assert time.time() - t < 3
    n = {r.u: r["count"] for r in got.groupBy("u").count().collect()}
    assert n == {"a": 3650 * 19, "b": 3650 * 20, "c": 3650 * 20}
    assert missing_combinations(facts, "u", {"day": Days(day, day - dt.timedelta(days=1)), "kind": types}).count() == 0
    three = missing_combinations(facts.filter("u = 'a'"), "u", {"day": Days(day, day + dt.timedelta(days=1)), "kind": ["t0", "t1", "t2"]})
    assert sorted(((r.day - day).days, r.kind) for r in three.collect()) == [(0, "t1"), (0, "t2"), (1, "t0"), (1, "t2")]


def test_views_of_the_catalogue(spark, tmp_path):
    t = B.Tables(spark, SF)
    names = {}
    for kind, make in {"spending": B.spending, "institutions": B.institutions,
                       "votes": lambda t: B.votes(t, ("Geschäftsnummer",))}.items():
        names[kind] = catalog._fresh(kind)
        make(t).write.option("path", str(tmp_path / kind)).saveAsTable(names[kind])
    views = catalog_views.publish_views(spark, **names, prefix=catalog._fresh("v") + "_")
    catalog_views.publish_views(spark, **names, prefix=views["rq1_expenditure_trends"][:-len("rq1_expenditure_trends")])  # again
    other = spark.newSession()
    from ledgerlens.plans import views as V
    want = {"sachkonto2stellig_enriched": V.enrich_spending(B.spending(t)),
            "rq2_spending_change_yoy": V.spending_change(B.spending(t)),
            "rq2_spending_vs_decisions": V.spending_vs_decisions(V.spending_change(B.spending(t)), V.decisions_per_year(
                B.votes(t, ("Geschäftsnummer",)))),
            "rq3_impact_by_department": V.impact_by_department(V.enrich_spending(B.spending(t)), B.institutions(t))}
    for name, df in want.items():
        got = readers.read_table(other, views[name])
        assert got.columns == df.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, df.collect())), name


def test_repeats_within_the_delay_are_dropped_over_runs(spark, tmp_path):
    src, sink, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    at = dt.datetime(2024, 1, 1)

    def land(rows):
        df = spark.createDataFrame([(k, at + dt.timedelta(hours=h)) for k, h in rows], "id int, ts timestamp")
        df.coalesce(1).write.mode("append").parquet(src)
        return run_incremental(spark, src, df.schema, lambda d: d, sink, ckpt, dedup_keys=["id"], dedup_within=("ts", "2 hours"))

    def there():
        return sorted(r.id for r in read_sink(spark, sink).collect())

    land([(1, 0), (1, 0), (2, 10)])
    assert there() == [1, 2]
    land([(2, 10), (3, 11)])  # a repeat in a second run, from the state of the checkpoint
    assert there() == [1, 2, 3]
    land([(4, 5)])  # late by more than the delay: dropped, as documented
    assert there() == [1, 2, 3]
    land([(5, 100)])
    land([(3, 101), (6, 101)])  # the state of key 3 has expired: it counts anew
    assert there() == [1, 2, 3, 3, 5, 6]
    import glob
    newest = max(glob.glob(f"{ckpt}/commits/*"), key=lambda f: int(f.rsplit("/", 1)[-1]))
    assert newest  # one checkpoint through all restarts


def test_tree_keys_stay_text_without_a_setting(spark, tmp_path):
    def put(path, records):
        d = tmp_path / "tree" / path
        d.mkdir(parents=True)
        (d / "x.json").write_text(json.dumps({"value": records}))

    put("institution=0010/jahr=2020/betragstyp=RECHNUNG", [{"betrag": "1", "sachkonto": "30"}])
    put("institution=0020/jahr=2020/betragstyp=RECHNUNG", [{"betrag": "2", "sachkonto": "31", "institution": "own", "jahr": 1999}])
    before = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    try:
        out = []

        def read():
            df = readers.read_partitioned_json(spark, str(tmp_path / "tree"), SPENDING_RECORD)
            out.append(sorted((r.institution, r.jahr, r.betragstyp, r.betrag) for r in df.collect()))

        threads = [threading.Thread(target=read) for _ in range(2)]
        for x in threads:
            x.start()
        for x in threads:
            x.join()
        assert out == [[("0010", 2020, "RECHNUNG", "1"), ("own", 1999, "RECHNUNG", "2")]] * 2
        spark.createDataFrame([("0010", 1)], "k string, v int").write.partitionBy("k").parquet(str(tmp_path / "pq"))
        assert [tuple(r) for r in readers.read_partitioned_parquet(spark, str(tmp_path / "pq")).select("k", "v").collect()] == [("0010", 1)]
        assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", before)


def test_departments_one_many_or_none(spark):
    xml = ["<Hit><Geschaeft><GRNr>1</GRNr><FederfuehrendesDepartement><Departement>A</Departement></FederfuehrendesDepartement>"
           "<MitbeteiligteDepartemente><Departement>B</Departement><Departement>C</Departement><Departement>B</Departement>"
           "</MitbeteiligteDepartemente></Geschaeft></Hit>",
           "<Hit><Geschaeft><GRNr>2</GRNr></Geschaeft></Hit>",
           "<Hit><Geschaeft><FederfuehrendesDepartement><Departement>D</Departement></FederfuehrendesDepartement></Geschaeft></Hit>",
           "<Hit><Geschaeft><GRNr>4</GRNr><MitbeteiligteDepartemente><Departement> </Departement></MitbeteiligteDepartemente></Geschaeft></Hit>"]
    items = hit_businesses(parse_hits(spark.createDataFrame([(x,) for x in xml], "xml string")))
    assert [(r.grnr, r.federfuehrend, r.mitbeteiligt) for r in items.collect()][1] == ("2", [], [])
    want = [("1", "involved", "B"), ("1", "involved", "C"), ("1", "leading", "A")]
    assert sorted(map(tuple, department_bridge(items).collect())) == want
    page = ('{"R": {"Hit": [{"Geschaeft": {"GRNr": "1", "FederfuehrendesDepartement": {"Departement": "A"},'
            '"MitbeteiligteDepartemente": {"Departement": ["B", "C"]}}}, {"Geschaeft": {"GRNr": "2"}}]}}')
    pages = spark.createDataFrame([("f", page)], "dateiname string, page string")
    assert sorted(map(tuple, department_bridge(business_items(pages)).collect())) == want


def test_counters_in_digits_of_any_script(spark):
    from ledgerlens.functions.text import int_field
    texts = ["JA: 12", "JA: ١٢", "JA: १२३", "JA: 𝟜𝟚", "JA: x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.n for r in df.select(int_field("t", r"(?U)JA:\s*(\d+)").alias("n")).collect()] == [12, 12, 123, 42, None, None]


def test_scratch_is_removed_on_request(spark):
    from ledgerlens.session import clear_scratch, scratch_path
    p = scratch_path(spark, "x")
    spark.range(3).write.parquet(p)
    assert clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(p)
