"""Query catalogue: one function per operator group, ``(spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables (through :mod:`ledgerlens.bindings`)
and runs the library's operators over all rows.  The matching DuckDB SQL is
in :mod:`ledgerlens.plans.oracle`.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from .. import bindings as B
from ..functions.dates import daily_window, in_window, ts_literal
from ..operators import cleaning, landing, quality, sketches
from ..operators.extract import extract_protocol, extract_questions, questions_per_year, run_counters
from ..operators.paging import result_pages
from ..operators.worklist import (
    Days,
    Values,
    business_items,
    department_bridge,
    document_items,
    final_vote_documents,
    final_vote_items,
    hit_businesses,
    items_to_json,
    missing_combinations,
    number_documents,
    pending,
    rejected_hits,
    work_grid,
)
from ..schemas import SPENDING_RECORD, VOTE_ITEM
from ..session import apply_defaults, scratch_path
from ..sources import readers, writers
from ..streaming.incremental import read_sink, run_incremental
from . import catalog_views
from . import views as V

Query = Callable[[SparkSession, str], DataFrame]

# Binding parameters (fixed values of the test fixtures).
# The narrower grid of coverage_gaps_window: the feature is the window itself.
WINDOW_DAYS = ("2024-01-10", "2024-01-12")
WINDOW_TYPES = ("purchase", "signup")
DAILY_NOW = _dt.datetime(2024, 1, 11, 6, 0, 0)
SURVEY_YEAR_OFFSET = -23
LANDING_YEAR = 1998  # clean_job_reruns: the years before it land first
DEDUP_DELAY = "1 day"  # incremental_dedup: what is delivered again
STREAM_TASKS = 32  # the test events are one row group
MANIFEST_SUFFIX = ".html"
# What the decisions view and the run counters need of a protocol.
DECISION_FIELDS = ("Geschäftsnummer",)
STATUS_FIELDS = ("Geschäftsnummer", "Stimm_Datum", "Stimm_Zeit", "JA")


def _t(spark: SparkSession, sf_dir: str) -> B.Tables:
    apply_defaults(spark)
    return B.Tables(spark, sf_dir)


# ------------------------------------------------------------------ views

def q_rq1(spark, sf):
    return V.expenditure_trends(B.spending(_t(spark, sf)))


def q_rq2_change(spark, sf):
    return V.spending_change(B.spending(_t(spark, sf)))


def q_rq2_decisions(spark, sf):
    return V.decisions_per_year(B.votes(_t(spark, sf), DECISION_FIELDS))


def q_rq2_vs(spark, sf):
    t = _t(spark, sf)
    return V.spending_vs_decisions(V.spending_change(B.spending(t)), V.decisions_per_year(B.votes(t, DECISION_FIELDS)))


def q_rq3_impact(spark, sf):
    t = _t(spark, sf)
    return V.impact_by_department(V.enrich_spending(B.spending(t)), B.institutions(t))


def q_rq3_share(spark, sf):
    t = _t(spark, sf)
    return V.citizen_impact_share(V.enrich_spending(B.spending(t)), B.institutions(t))


def _survey(t):
    return cleaning.clean_survey(B.raw_survey(t))


def q_survey_scored(spark, sf):
    return V.score_survey(_survey(_t(spark, sf)))


def q_rq4(spark, sf):
    return V.satisfaction_by_year(V.score_survey(_survey(_t(spark, sf))))


def q_x1(spark, sf):
    t = _t(spark, sf)
    return V.satisfaction_link(V.spending_change(B.spending(t)),
                               V.satisfaction_by_year(V.score_survey(_survey(t))),
                               year_offset=SURVEY_YEAR_OFFSET)


def q_enriched(spark, sf):
    return V.enrich_spending(B.spending(_t(spark, sf)))


# ------------------------------------------------------------------ clean jobs

def q_clean_votes(spark, sf):
    return B.votes(_t(spark, sf))


def q_businesses_from_pages(spark, sf):
    return cleaning.clean_businesses(business_items(B.business_pages(_t(spark, sf))))


def q_clean_checked(spark, sf):
    """Clean rows passed through their check, with the number of failed rules beside them."""
    clean, report = cleaning.clean_and_check("accounts", B.raw_accounts(_t(spark, sf)))
    failed = report.filter("outcome = 'Failed'").agg(F.count("*")).scalar()
    return clean.withColumn("n_failed", failed)


def q_document_files(spark, sf):
    """The documents landed in nested folders, and the folders that a listing by suffix finds files in."""
    p = scratch_path(spark, "document_files")
    writers.write_partitioned(_t(spark, sf).documents.select("doc_id", "lang", "source"), p, ["lang", "source"])
    found = readers.list_documents(spark, p, suffix=".JSON").filter("length > 0")
    part = lambda k: F.nullif(F.regexp_extract("path", f"/{k}=([^/]*)/", 1), F.lit("__HIVE_DEFAULT_PARTITION__"))
    return found.select(part("lang").alias("lang"), part("source").alias("source")).distinct()


def q_clean_businesses(spark, sf):
    return cleaning.clean_businesses(B.raw_businesses(_t(spark, sf)))


def q_clean_institutions(spark, sf):
    return cleaning.clean_institutions(B.raw_institutions(_t(spark, sf)))


def q_clean_accounts(spark, sf):
    return cleaning.clean_accounts(B.raw_accounts(_t(spark, sf)))


def q_clean_spending(spark, sf):
    return cleaning.clean_spending(B.raw_spending(_t(spark, sf)))


def q_clean_survey(spark, sf):
    return _survey(_t(spark, sf))


# ------------------------------------------------------------------ quality

def _dq(name: str, clean: Callable[[B.Tables], DataFrame]) -> Query:
    rules = cleaning.CLEAN_JOBS[name][1]

    def q(spark, sf):
        return quality.evaluate(clean(_t(spark, sf)), rules)
    return q


_CLEAN_OF = {
    "votes": B.votes,
    "businesses": lambda t: cleaning.clean_businesses(B.raw_businesses(t)),
    "institutions": lambda t: cleaning.clean_institutions(B.raw_institutions(t)),
    "accounts": lambda t: cleaning.clean_accounts(B.raw_accounts(t)),
    "spending": lambda t: cleaning.clean_spending(B.raw_spending(t)),
    "survey": _survey,
}


# ------------------------------------------------------------------ extraction

def q_extract_protocols(spark, sf):
    return extract_protocol(B.protocol_text(_t(spark, sf)))


def _questions(t):
    return extract_questions(B.questionnaire_pages(t), pattern=B.QUESTION_BINDING_PATTERN,
                             carry=("doc_id",))


def q_extract_questions(spark, sf):
    return _questions(_t(spark, sf))


def q_extract_questions_sf(spark, sf):
    return extract_questions(B.numbered_questionnaire_pages(_t(spark, sf)), carry=("doc_id",))


def q_questions_per_year(spark, sf):
    return questions_per_year(_questions(_t(spark, sf)))


def q_run_counters(spark, sf):
    return run_counters(extract_protocol(B.protocol_text(_t(spark, sf)), names=STATUS_FIELDS))


# ------------------------------------------------------------------ work lists

def _items(t):
    return final_vote_items(B.hits(t), year_source=F.col("year_source"))


def q_final_vote_documents(spark, sf):
    return final_vote_documents(_items(_t(spark, sf)))


def q_document_ordinals(spark, sf):
    return number_documents(_items(_t(spark, sf)))


def q_document_ordinals_all(spark, sf):
    """All documents are numbered, those without a file ID too, and then skipped."""
    return number_documents(document_items(B.hits(_t(spark, sf))))


def q_business_xml_files(spark, sf):
    """The hits written out as search-result files and read back by row tag."""
    p = scratch_path(spark, "hits_xml")
    B.hits_xml(_t(spark, sf)).select("xml").write.text(p)
    return final_vote_documents(final_vote_items(readers.read_business_xml(spark, p, multiline=False)))


def q_worklist_json(spark, sf):
    msgs = items_to_json(_items(_t(spark, sf)))
    m = F.from_json("body", VOTE_ITEM)
    return msgs.select(m.alias("m")).select(
        F.col("m.grnr").alias("grnr"), F.col("m.titel").alias("titel"),
        F.col("m.year_source").alias("year_source"),
        F.size("m.pdf_files").alias("n_files"),
        F.col("m.pdf_files")[0]["file_id"].alias("first_file_id"))


def q_props_from_json(spark, sf):
    e = _t(spark, sf).events
    return e.select("event_id", F.from_json("props", StructType([StructField("k", IntegerType())]))["k"]
                    .alias("k"))


def q_doc_manifest(spark, sf):
    p = _t(spark, sf).pages.select("page_id", "url")
    return readers.manifest(p, "url", MANIFEST_SUFFIX)


def q_work_grid(spark, sf):
    """Years: those of the orders, first to last."""
    t = _t(spark, sf)
    s = t.supplier.select(F.col("s_suppkey").cast("string").alias("institution"))
    year = F.year("o_orderdate")
    return work_grid(s, F.sequence(t.orders.agg(F.min(year)).scalar(), t.orders.agg(F.max(year)).scalar()))


def _gaps(facts, days, types):
    return missing_combinations(facts, "user_id", {"day": days, "event_type": types}).select("user_id", "event_type", "day")


def _event_facts(spark, sf):
    return _t(spark, sf).events.select("user_id", "event_type", F.to_date("ts").alias("day"))


def q_coverage_gaps(spark, sf):
    """The grid: all days from the first event to the last, and all event types
    (scalar subqueries of the plan, one small aggregate)."""
    facts = _event_facts(spark, sf)
    types = F.array_sort(F.collect_set("event_type"))
    return _gaps(facts, Days(facts.agg(F.min("day")).scalar(), facts.agg(F.max("day")).scalar()),
                 Values(facts.agg(types).scalar()))


def q_coverage_gaps_window(spark, sf):
    """A grid narrower than the data: users without an event in it have all its combinations open."""
    lo, hi = (_dt.date.fromisoformat(d) for d in WINDOW_DAYS)
    return _gaps(_event_facts(spark, sf), Days(lo, hi), Values(WINDOW_TYPES))


def q_department_bridge(spark, sf):
    """The departments of the hits' XML trees: one, many or a missing branch."""
    return department_bridge(hit_businesses(B.hits(_t(spark, sf))))


def q_department_bridge_pages(spark, sf):
    """The same from landed JSON pages, where one name is a text and many are a list."""
    return department_bridge(business_items(B.business_pages(_t(spark, sf))))


def _cut_hits(t):
    """Every 50th hit is cut off before its end."""
    whole = F.col("xml")
    cut = F.when(F.col("o_orderkey") % 50 == 0, whole.substr(F.lit(1), F.length(whole) - 20)).otherwise(whole)
    return B.hits_xml(t).withColumn("xml", cut)


def q_hits_landing(spark, sf):
    """Hits parsed once and landed by outcome: the documents of the good ones, the keys of the rejected."""
    p = scratch_path(spark, "hits_landing")
    _, schema = landing.land_hits(_cut_hits(_t(spark, sf)), p, keep=("o_orderkey",))
    hits = landing.good(spark, p, schema).withColumnRenamed("parsed", "hit")
    files = final_vote_documents(final_vote_items(hits)).select(F.lit("good").alias("status"), "grnr", "file_id")
    bad = landing.rejects(spark, p, schema).filter(F.length("raw") > 0)
    return files.unionByName(bad.select(F.lit("rejected").alias("status"), F.col("o_orderkey").cast("string").alias("grnr"),
                                        F.lit(None).cast("string").alias("file_id")))


def q_hits_rejects(spark, sf):
    """Every 50th hit is cut off before its end; all of those are reported, with their raw text's length."""
    cut = _cut_hits(_t(spark, sf))
    return rejected_hits(cut).select("o_orderkey", (F.length("_corrupt_record") > 0).alias("has_raw"))


def q_pending_work(spark, sf):
    t = _t(spark, sf)
    work = t.orders.select(F.col("o_orderkey"), "o_custkey", "o_orderdate")
    done = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return pending(work, done, ["o_orderkey"])


def q_daily_window(spark, sf):
    w = daily_window(DAILY_NOW)
    e = _t(spark, sf).events
    return e.filter(in_window("ts", ts_literal(w.start), ts_literal(w.end))) \
            .select("event_id", "ts", "user_id", "event_type")


def q_search_pages(spark, sf):
    """Each year's search as the finder reads it: the hits strictly inside the
    interval by start time (ties by key), in pages of 100."""
    hits = _t(spark, sf).orders.select("o_orderkey", F.col("o_orderdate").alias("beginn_start"))
    year = F.year("beginn_start")
    inside = in_window("beginn_start", F.make_timestamp(year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)),
                       F.make_timestamp(year, F.lit(12), F.lit(31), F.lit(23), F.lit(59), F.lit(59)))
    return result_pages(hits.withColumn("year_source", year).filter(inside),
                        ["beginn_start", "o_orderkey"], group=["year_source"])


def q_survey_code_list(spark, sf):
    """The code list lands below the respondents' folder; each is read by its own
    file pattern, and the answers are counted under the list's labels."""
    e = _t(spark, sf).events
    p = scratch_path(spark, "survey_landing")
    e.select("event_id", F.col("event_type").alias("antwort")).write.option("header", True).csv(
        f"{p}/respondents", compression="gzip")
    writers.write_csv(e.select(F.col("event_type").alias("code"), F.concat(F.lit('Antwort "'), "event_type", F.lit('", alle'))
                               .alias("bezeichnung")).distinct(), f"{p}/respondents/codes")
    answers = readers.read_survey_csv(spark, p, glob="*.csv.gz", columns=["event_id", "antwort"])
    codes = readers.read_survey_csv(spark, p, glob="*.csv", columns=["code", "bezeichnung"])
    counted = answers.groupBy(F.col("antwort").alias("code")).agg(F.count("*").alias("n_answers"))
    return counted.join(codes, "code", "left").select("code", "bezeichnung", "n_answers")


# ------------------------------------------------------------------ sinks

def q_roundtrip_parquet(spark, sf):
    df = cleaning.clean_spending(B.raw_spending(_t(spark, sf)))
    p = scratch_path(spark, "clean_spending")
    writers.write_clean(df, p)
    return spark.read.parquet(p)


def q_roundtrip_csv(spark, sf):
    df = _t(spark, sf).documents.select("doc_id", "lang", "text")
    p = scratch_path(spark, "documents_csv")
    writers.write_csv(df, p)
    back = readers.read_survey_csv(spark, p, glob="*.csv", columns=["doc_id", "lang", "text"])
    return back.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def q_roundtrip_json(spark, sf):
    df = _t(spark, sf).documents.select("doc_id", "lang", "text")
    p = scratch_path(spark, "documents_json")
    writers.write_json(df, p)
    record = StructType([StructField("doc_id", LongType()), StructField("lang", StringType()),
                         StructField("text", StringType())])
    return readers.read_records(spark, p, record, multiline=False)


def q_roundtrip_partitioned(spark, sf):
    """Per-key spending totals written under ``jahr=/betragstyp=`` directories
    (dynamic overwrite) and read back with the path keys as strings.  The
    institution stays a column: one directory per institution would mean one
    tiny file per key at scale."""
    t = _t(spark, sf)
    per_key = B.spending(t).groupBy("institution", "jahr", "betragstyp").agg(
        V.money_sum("betrag").alias("betrag"), F.count(F.lit(1)).alias("n_rows"))
    p = scratch_path(spark, "spending_partitioned")
    writers.write_partitioned(per_key, p, ["jahr", "betragstyp"], fmt="parquet")
    back = readers.read_partitioned_parquet(spark, p)
    return back.select("institution", F.col("jahr").cast("int").alias("jahr"), "betragstyp",
                       "betrag", "n_rows")


ENVELOPE_RECORD = StructType([StructField("nr", LongType()), StructField("titel", StringType())])


def _envelopes(spark, sf):
    """One envelope a line and an order, of 1 + key%3 records; every 50th line is cut off."""
    k = F.col("o_orderkey")
    records = F.transform(F.sequence(F.lit(0).cast("bigint"), k % 3),
                          lambda i: F.struct((k * 10 + i).alias("nr"), F.col("o_orderpriority").alias("titel")))
    line = F.to_json(F.struct(records.alias("value")))
    line = F.when(k % 50 == 0, line.substr(F.lit(1), F.length(line) - 5)).otherwise(line)
    p = scratch_path(spark, "envelopes")
    _t(spark, sf).orders.select(line.alias("value")).write.text(p)
    return p


def q_envelope_records(spark, sf):
    return readers.read_envelope(spark, _envelopes(spark, sf), ENVELOPE_RECORD, multiline=False)


def q_envelope_rejects(spark, sf):
    bad = readers.envelope_rejects(spark, _envelopes(spark, sf), ENVELOPE_RECORD, multiline=False)
    return bad.select(F.regexp_extract("raw", r'"nr":(\d+)', 1).cast("bigint").alias("first_nr"))


def _land_envelopes(spark, sf):
    p = scratch_path(spark, "envelope_landing")
    return (p, *landing.land_envelopes(spark, _envelopes(spark, sf), ENVELOPE_RECORD, p, multiline=False))


def q_envelope_landing(spark, sf):
    """Envelopes parsed once and landed by outcome: the records of the good, the first number of the rejected."""
    p, _, schema = _land_envelopes(spark, sf)
    bad = landing.rejects(spark, p, schema).select(
        F.lit("rejected").alias("status"), F.regexp_extract("raw", r'"nr":(\d+)', 1).cast("bigint").alias("nr"),
        F.lit(None).cast("string").alias("titel"))
    return landing.envelope_records(spark, p, schema).select(F.lit("good").alias("status"), "nr", "titel").unionByName(bad)


def q_landing_counters(spark, sf):
    """The counters that the landing's own write observed."""
    _, n, _ = _land_envelopes(spark, sf)
    return spark.createDataFrame([(n.read, n.good, n.rejected)], "n_read long, n_good long, n_rejected long")


def _fresh(name: str) -> str:
    return f"ledgerlens_{name}_{uuid.uuid4().hex[:8]}"


def q_clean_table_catalog(spark, sf):
    """The clean institutions as a catalog table, read by its name."""
    name = _fresh("clean_institutions")
    writers.write_clean(cleaning.clean_institutions(B.raw_institutions(_t(spark, sf))),
                        scratch_path(spark, "clean_institutions"), table=name)
    return readers.read_table(spark, name)


def _catalog_view(view: str, **tables) -> Query:
    """Clean tables are saved to the catalogue, the views published over them,
    and one is read in a second session."""
    def q(spark, sf):
        t = _t(spark, sf)
        names = {}
        for kind, make in tables.items():
            names[kind] = _fresh(kind)
            writers.write_clean(make(t), scratch_path(spark, kind), table=names[kind])
        published = catalog_views.publish_views(spark, **names, prefix=_fresh("v") + "_")
        return readers.read_table(spark.newSession(), published[view])
    return q


def q_clean_job_reruns(spark, sf):
    """The spending job on one path, three times: the early years, the late ones,
    the early ones again. Each report is about its own rows, all years are there once."""
    t = _t(spark, sf)
    raw, p = B.raw_spending(t), scratch_path(spark, "spending_reruns")
    early = F.coalesce(F.col("jahr") < LANDING_YEAR, F.lit(True))
    out = None
    for run, part in enumerate((early, ~early, early), 1):
        report = cleaning.run_clean_job("spending", raw.filter(part), p, partition_by=["jahr"], results_path=p + "_results",
                                        run_id="late" if run == 2 else "early")
        rows = report.select(F.lit(f"run {run}").alias("what"), "rule", "metric", "outcome")
        out = rows if out is None else out.unionByName(rows)
    table = cleaning.clean_spending(raw).schema
    years = spark.read.schema(table).parquet(p).groupBy("jahr").agg(F.count("*").cast("double").alias("metric"))
    results = quality.read_results(spark, p + "_results").groupBy("run_id").agg(F.count("*").cast("double").alias("metric"))
    none = F.lit(None).cast("string").alias("outcome")
    return (out.unionByName(years.select(F.lit("rows of a year").alias("what"), F.col("jahr").cast("string").alias("rule"), "metric", none))
            .unionByName(results.select(F.lit("results of a run").alias("what"), F.col("run_id").alias("rule"), "metric", none)))


def q_distinct_sketches(spark, sf):
    """Sketches stored for each event type, united: within the documented error of the exact counts."""
    e = _t(spark, sf).events
    p = scratch_path(spark, "event_sketches")
    columns = ["event_id", "user_id"]
    sketches.write_sketches(e, p, columns, ["event_type"])
    found = sketches.distinct_counts(sketches.read_sketches(spark, p, ["event_type"]))
    exact = e.agg(*[F.count_distinct(c).alias(c) for c in columns]).unpivot([], columns, "column", "n_exact")
    off = F.abs(F.col("distinct_values") - F.col("n_exact")) / F.greatest("n_exact", F.lit(1))
    return found.join(exact, "column").select("column", "n_rows", "n_exact", (off <= sketches.error()).alias("within"))


def q_spending_tree_json(spark, sf):
    """The spending tree as landed: an envelope a file below institution=/jahr=/betragstyp=, of
    records that lack what the path says; keys stay text (0010)."""
    t = _t(spark, sf)
    per_key = B.spending(t).groupBy(F.lpad("institution", 6, "0").alias("institution"), "jahr", "betragstyp", "sachkonto").agg(
        V.money_sum("betrag").alias("betrag"))
    records = per_key.groupBy("institution", "jahr", "betragstyp").agg(
        F.collect_list(F.struct(F.col("betrag").cast("string").alias("betrag"), "sachkonto")).alias("value"))
    p = scratch_path(spark, "spending_tree")
    # one directory a key would be one a row here: institutions share them by their last digit
    tree = records.select(F.right("institution", F.lit(1)).alias("gruppe"), "jahr", "betragstyp",
                          F.transform("value", lambda r: F.struct(r["betrag"].alias("betrag"), r["sachkonto"].alias("sachkonto"),
                                                                  F.col("institution").alias("institution"))).alias("value"))
    writers.write_partitioned(tree.withColumn("gruppe", F.concat(F.lit("0"), "gruppe")), p, ["gruppe", "jahr", "betragstyp"])
    back = readers.read_partitioned_json(spark, p, SPENDING_RECORD, multiline=False)
    return back.select("gruppe", "institution", F.col("jahr").cast("int").alias("jahr"), "betragstyp", "sachkonto",
                       F.col("betrag").cast("double").alias("betrag"))


def q_append_pending_rerun(spark, sf):
    """Part of the work lands first, then all of it, then all of it again: each item is there once."""
    work = _t(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    p = scratch_path(spark, "pending_sink")
    done = work.filter(F.lit(False))
    for landed in (work.filter("o_orderstatus = 'F'"), work, work):
        writers.append_pending(landed, done, ["o_orderkey"], p)
        done = spark.read.schema(work.schema).parquet(p)
    return done


def q_questions_master_csv(spark, sf):
    """The questions of all years in one CSV result, read back."""
    p = scratch_path(spark, "questions_master")
    writers.write_csv(_questions(_t(spark, sf)), p)
    back = readers.read_survey_csv(spark, p, glob="*.csv", columns=["doc_id", "year", "page", "id", "text"])
    return back.withColumns({"doc_id": F.col("doc_id").cast("bigint"), "page": F.col("page").cast("int")})


def q_trends_for_reader(spark, sf):
    """The trends in reading order, with the row number they come in (a few rows a year)."""
    df = V.for_reader(V.expenditure_trends(B.spending(_t(spark, sf))), "year", "type")
    at = df.withColumn("_at", F.monotonically_increasing_id())
    return at.withColumn("row_no", F.row_number().over(Window.orderBy("_at"))).drop("_at")


def q_incremental_landings(spark, sf):
    """Two landings, a run after each: the second run cleans the new files only."""
    events = _t(spark, sf).events
    landed = scratch_path(spark, "events_landing")
    sink = scratch_path(spark, "survey_landings")

    def clean(e):
        return cleaning.clean_survey(B.raw_survey_from_events(e))

    early = F.coalesce(F.col("event_type") == "purchase", F.lit(False))
    for part in (early, ~early):
        events.filter(part).write.mode("append").parquet(landed)
        run_incremental(spark, landed, events.schema, clean, sink, sink + "_checkpoint", tasks=STREAM_TASKS)
    return read_sink(spark, sink)


def q_incremental(spark, sf):
    src_schema = spark.read.parquet(f"{sf}/events.parquet").schema
    sink = scratch_path(spark, "survey_incremental")
    ckpt = sink + "_checkpoint"

    def clean(events):
        return cleaning.clean_survey(B.raw_survey_from_events(events))

    for _ in range(2):  # the second run finds no new file and adds nothing
        run_incremental(spark, sf, src_schema, clean, sink, ckpt, glob="events.parquet", tasks=STREAM_TASKS)
    return read_sink(spark, sink)


def q_incremental_dedup(spark, sf):
    """Two landings, the second with the last day of the first again: its repeats
    are dropped by a second run, whose state holds no more than the delay."""
    # event time is a point in time for a watermark, not a wall-clock reading
    events = _t(spark, sf).events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    landing_dir, sink = scratch_path(spark, "events_twice"), scratch_path(spark, "events_once")
    ends = events.agg(F.min(F.unix_micros("ts")).alias("lo"), F.max(F.unix_micros("ts")).alias("hi")).first()
    cut = F.timestamp_micros(F.lit(((ends.lo or 0) + (ends.hi or 0)) // 2))
    for part in (F.col("ts") < cut, F.col("ts") >= cut - F.expr(f"INTERVAL {DEDUP_DELAY}")):
        events.filter(part).write.mode("append").parquet(landing_dir)
        run_incremental(spark, landing_dir, events.schema, lambda batch: batch, sink, sink + "_checkpoint",
                        dedup_keys=["event_id"], dedup_within=("ts", DEDUP_DELAY))
    return read_sink(spark, sink, events.schema).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


QUERIES: dict[str, Query] = {
    "rq1_expenditure_trends": q_rq1,
    "rq2_spending_change_yoy": q_rq2_change,
    "rq2_decisions_per_year": q_rq2_decisions,
    "rq2_spending_vs_decisions": q_rq2_vs,
    "rq3_impact_by_department": q_rq3_impact,
    "rq3_citizen_impact_share": q_rq3_share,
    "survey_scored": q_survey_scored,
    "rq4_satisfaction_by_year": q_rq4,
    "x1_satisfaction_link": q_x1,
    "spending_enriched": q_enriched,
    "clean_votes": q_clean_votes,
    "clean_businesses": q_clean_businesses,
    "businesses_from_pages": q_businesses_from_pages,
    "clean_institutions": q_clean_institutions,
    "clean_accounts": q_clean_accounts,
    "clean_spending": q_clean_spending,
    "clean_survey": q_clean_survey,
    **{f"dq_{name}": _dq(name, fn) for name, fn in _CLEAN_OF.items()},
    "extract_protocols": q_extract_protocols,
    "extract_questions": q_extract_questions,
    "extract_questions_sf": q_extract_questions_sf,
    "questions_per_year": q_questions_per_year,
    "run_counters": q_run_counters,
    "final_vote_documents": q_final_vote_documents,
    "document_ordinals": q_document_ordinals,
    "document_ordinals_all": q_document_ordinals_all,
    "business_xml_files": q_business_xml_files,
    "worklist_json": q_worklist_json,
    "props_from_json": q_props_from_json,
    "doc_manifest": q_doc_manifest,
    "work_grid": q_work_grid,
    "coverage_gaps": q_coverage_gaps,
    "coverage_gaps_window": q_coverage_gaps_window,
    "hits_rejects": q_hits_rejects,
    "pending_work": q_pending_work,
    "daily_window": q_daily_window,
    "sink_roundtrip_parquet": q_roundtrip_parquet,
    "sink_roundtrip_csv": q_roundtrip_csv,
    "sink_roundtrip_json": q_roundtrip_json,
    "sink_roundtrip_partitioned": q_roundtrip_partitioned,
    "incremental_clean": q_incremental,
    "incremental_landings": q_incremental_landings,
    "envelope_records": q_envelope_records,
    "envelope_rejects": q_envelope_rejects,
    "clean_table_catalog": q_clean_table_catalog,
    "append_pending_rerun": q_append_pending_rerun,
    "questions_master_csv": q_questions_master_csv,
    "trends_for_reader": q_trends_for_reader,
    "clean_checked": q_clean_checked,
    "document_files": q_document_files,
    "clean_job_reruns": q_clean_job_reruns,
    "envelope_landing": q_envelope_landing,
    "landing_counters": q_landing_counters,
    "hits_landing": q_hits_landing,
    "distinct_sketches": q_distinct_sketches,
    "catalog_view_trends": _catalog_view("rq1_expenditure_trends", spending=B.spending),
    "catalog_view_decisions": _catalog_view("rq2_spending_vs_decisions", spending=B.spending,
                                            votes=lambda t: B.votes(t, DECISION_FIELDS)),
    "catalog_view_share": _catalog_view("rq3_citizen_impact_share_by_department", spending=B.spending,
                                        institutions=B.institutions),
    "catalog_view_satisfaction": _catalog_view("rq4_satisfaction_by_year", survey=_survey),
    "incremental_dedup": q_incremental_dedup,
    "spending_tree_json": q_spending_tree_json,
    "department_bridge": q_department_bridge,
    "department_bridge_pages": q_department_bridge_pages,
    "search_pages": q_search_pages,
    "survey_code_list": q_survey_code_list,
}
