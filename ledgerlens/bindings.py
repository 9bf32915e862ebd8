"""Bindings: the driver's test tables -> the logical tables of the data model.

The source system's own data (spending API, council protocols, survey CSV)
is not available offline, so each logical table is *derived by Spark* from a
driver table of matching shape and growth:

=================  ==========================  ============================
logical table      derived from                rows grow with
=================  ==========================  ============================
spending           lineitem                    lineitem
institution (raw)  supplier + nation           supplier
account (raw)      part + supplier + nation    part
protocol text      orders (one page per order) orders
vote               protocol text -> extraction orders
business (raw)     orders                      orders
search hits (XML)  orders (one <Hit> each)     orders
survey (raw)       events (one respondent each) events
questionnaire      documents (pages by \\f)     documents
=================  ==========================  ============================

Every expression is row-local; the only joins are with the two small
TPC-H dimensions (supplier, nation).  The source system lands many files; the
test tables are one row group each. So the fixtures that render text (protocols,
hits, pages, survey answers) first deal the few narrow columns they need to
``RENDER_TASKS`` tasks by key, always; a larger table takes a larger number.  The same rules are restated in SQL in
:mod:`ledgerlens.plans.oracle` so an independent engine can check results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.cleaning import clean_votes
from .operators.extract import extract_protocol, split_pages
from .operators.worklist import parse_hits
from .schemas import SCORE_LABELS, survey_answer_columns
from .session import table_path

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


RENDER_TASKS = 32


def _dealt(df: DataFrame, key: str) -> DataFrame:
    return df.repartition(RENDER_TASKS, key)


class Tables:
    """Lazy access to the driver's parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(table_path(self.sf_dir, name))
        return self._cache[name]


# ----------------------------------------------------------------- spending

def amount_type_of(flag: Column) -> Column:
    return (F.when(flag == "R", F.lit("RECHNUNG"))
             .when(flag == "A", F.lit("STADTRAT_ANTRAG"))
             .otherwise(F.lit("GEMEINDERAT_BESCHLUSS")))


def spending(t: Tables) -> DataFrame:
    """Clean spending facts: ``betrag double, betragstyp, institution, jahr int, sachkonto``."""
    li = t.lineitem
    return li.select(
        F.col("l_extendedprice").alias("betrag"),
        amount_type_of(F.col("l_returnflag")).alias("betragstyp"),
        F.col("l_suppkey").cast("string").alias("institution"),
        F.year("l_shipdate").cast("int").alias("jahr"),
        (F.lit(30) + F.col("l_partkey") % 10).cast("string").alias("sachkonto"),
    )


def raw_spending(t: Tables) -> DataFrame:
    """Spending records as the API delivers them: every value a string except
    the year; an amount is empty text for single-unit lines."""
    li = t.lineitem
    return li.select(
        F.when(F.col("l_quantity") == 1, F.lit("")).otherwise(F.col("l_extendedprice").cast("string"))
         .alias("betrag"),
        amount_type_of(F.col("l_returnflag")).alias("betragstyp"),
        F.col("l_suppkey").cast("string").alias("institution"),
        F.year("l_shipdate").cast("int").alias("jahr"),
        (F.lit(30) + F.col("l_partkey") % 10).cast("string").alias("sachkonto"),
    )


# ------------------------------------------------------------- dimensions

def _department(n: DataFrame) -> DataFrame:
    return n.select(F.col("n_nationkey").alias("_nk"), F.struct(
        F.col("n_nationkey").cast("string").alias("key"),
        F.col("n_name").alias("bezeichnung"),
        F.substring("n_name", 1, 3).alias("kurzname")).alias("departement"))


def raw_institutions(t: Tables) -> DataFrame:
    """Institution records with a nested department (supplier -> nation)."""
    s = t.supplier
    d = _department(t.nation)
    return s.join(d, s["s_nationkey"] == d["_nk"], "left").select(
        F.col("s_suppkey").cast("string").alias("key"),
        F.col("s_name").alias("bezeichnung"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("kurzname"),
        "departement")


def raw_accounts(t: Tables) -> DataFrame:
    """Account records with institution -> department nested twice.
    A part is booked by the supplier whose key equals the part size."""
    inst = raw_institutions(t)
    inst = inst.select(F.col("key").alias("_ik"), F.struct("key", "bezeichnung", "kurzname", "departement")
                       .alias("institution"))
    p = t.part
    # a part books one of a few sizes: only those rows of the dimension, a side so
    # small at run time that it is sent to the parts, however hot a size is
    sizes = p.select(F.col("p_size").cast("string").alias("_ik")).distinct()
    inst = inst.join(sizes, "_ik", "left_semi")
    return p.join(inst, p["p_size"].cast("string") == inst["_ik"], "left").select(
        F.col("p_partkey").cast("int").alias("id"),
        F.concat((F.lit(30) + F.col("p_partkey") % 10).cast("string"), F.lit("."),
                 F.col("p_partkey").cast("string")).alias("kontoNr"),
        F.col("p_name").alias("bezeichnung"),
        "institution")


def institutions(t: Tables) -> DataFrame:
    from .operators.cleaning import clean_institutions
    return clean_institutions(raw_institutions(t))


# ---------------------------------------------------------------- protocols

def _n(c: Column) -> Column:
    return c.cast("string")


def protocol_text(t: Tables) -> DataFrame:
    """First page of a vote protocol per order: ``(doc, page_no, text)``.

    Variation is derived from the order key: no business number every 50th,
    no vote date every 7th, no vote time every 13th, a no-break space after
    ``JA:`` every 11th, a non-number yes count every 19th, and the tie-breaker
    is a name, the city footer on the next line, or absent.
    """
    o = _dealt(t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"), "o_orderkey")
    k = F.col("o_orderkey")
    nbsp = "\u00a0"  # no-break space
    number = F.when(k % 50 == 0, F.lit("Geschäfts#: offen")).otherwise(
        F.concat(F.lit("Geschäfts#: "), _n(F.year("o_orderdate")), F.lit("/"), _n(k)))
    date = F.when(k % 7 != 0, F.concat(F.lit("Stimm-Datum: "),
                                       F.date_format("o_orderdate", "dd.MM.yyyy")))
    time = F.when(k % 13 != 0, F.concat(F.lit("Stimm-Zeit: "),
                                        F.format_string("%02d:%02d:%02d", (k % 12 + 8).cast("int"),
                                                        (k % 60).cast("int"), (k % 59).cast("int"))))
    ja = F.when(k % 19 == 0, F.lit("JA: x")).otherwise(
        F.concat(F.lit("JA:"), F.when(k % 11 == 0, F.lit(nbsp)).otherwise(F.lit(" ")), _n(k % 125)))
    tie = (F.when(k % 3 == 0, F.lit("Stichentscheid:\nStadt Zürich"))
            .when(k % 3 == 1, F.concat(F.lit("Stichentscheid: "), F.col("o_orderpriority"))))
    text = F.concat_ws(
        "\n",
        F.lit("Gemeinderat Protokoll"),
        F.concat(F.lit("Geschäftstitel: "), F.col("o_orderpriority"), F.lit(" Kredit")),
        F.concat(F.lit("für "), F.col("o_orderstatus"), F.lit(" Nr "), _n(k)),
        number, date, time, ja,
        F.concat(F.lit("NEIN: "), _n(F.col("o_custkey") % 90)),
        F.concat(F.lit("Enthalten: "), _n(k % 9)),
        F.concat(F.lit("Nicht Präsent: "), _n(k % 17)),
        F.concat(F.lit("Total Stimmen: "), _n(k % 125 + F.col("o_custkey") % 90 + k % 9)),
        tie,
    )
    return o.select(F.concat(F.lit("protokoll_"), _n(k), F.lit(".pdf")).alias("doc"),
                    F.lit(1).alias("page_no"), text.alias("text"))


def votes(t: Tables, names: Sequence[str] | None = None) -> DataFrame:
    """Clean vote table: protocol text -> extraction (of ``names``, default all) -> clean job."""
    return clean_votes(extract_protocol(protocol_text(t), names=names))


# ---------------------------------------------------------------- business

def raw_businesses(t: Tables) -> DataFrame:
    """Flattened business items: ``dateiname, grnr, titel, pdf_files, geschaeftsart``.
    Every 50th number is empty and every 51st missing."""
    o = _dealt(t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"), "o_orderkey")
    k = F.col("o_orderkey")
    grnr = (F.when(k % 50 == 0, F.lit(""))
             .when(k % 51 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(_n(F.year("o_orderdate")), F.lit("/"), _n(k))))
    kinds = (F.when(k % 5 == 0, F.array(F.lit("Motion"),
                                         F.concat(F.lit("Postulat ["), F.col("o_orderstatus"), F.lit("]"))))
              .when(k % 5 == 1, F.array(F.lit("Weisung")))
              .when(k % 5 == 2, F.lit(None).cast("array<string>"))
              .otherwise(F.array(F.lit("Interpellation"), F.col("o_orderpriority"))))
    files = F.array(F.struct(F.concat(F.lit("SCHLUSSabstimmung "), _n(k)).alias("titel"),
                             F.concat(F.lit("F"), _n(k)).alias("file_id")))
    return o.select(F.concat(F.lit("geschaefte_"), _n(F.year("o_orderdate")), F.lit(".json")).alias("dateiname"),
                    grnr.alias("grnr"), F.concat(F.lit("Geschäft "), _n(k)).alias("titel"),
                    files.alias("pdf_files"), kinds.alias("geschaeftsart"))


def departments(k: Column) -> tuple[Column, Column]:
    """The leading departments of order ``k`` (none for every fourth, else one)
    and the involved ones (none, one or two)."""
    name = lambda n: F.concat(F.lit("Departement "), _n(n % 9))
    return (F.when(k % 4 != 0, F.array(name(k))).otherwise(F.array().cast("array<string>")),
            F.slice(F.array(name(k + 1), name(k + 2)), 1, (k % 3).cast("int")))


def business_pages(t: Tables) -> DataFrame:
    """The rows of ``raw_businesses`` as landed search pages, one hit a page:
    ``(dateiname, page)``.  One business type or department is written as a text,
    several as a list; every other page writes its only task as an object, the others as a list."""
    b = raw_businesses(t)
    quoted = F.transform("geschaeftsart", lambda x: F.concat(F.lit('"'), x, F.lit('"')))
    kinds = F.when(F.size("geschaeftsart") == 1, quoted[0]).otherwise(
        F.concat(F.lit("["), F.array_join(quoted, ","), F.lit("]")))
    f = F.col("pdf_files")[0]
    task = F.concat(F.lit('{"Dokumente": {"Dokument": [{"Titel": "Antrag"}, {"Titel": "'), f["titel"],
                    F.lit('", "File": {"@ID": "'), f["file_id"], F.lit('"}}]}}'))
    task = F.when(F.crc32(f["file_id"].cast("binary")) % 2 == 0, task).otherwise(F.concat(F.lit("["), task, F.lit("]")))
    def department(element, names):
        quoted = F.transform(names, lambda x: F.concat(F.lit('"'), x, F.lit('"')))
        value = F.when(F.size(names) == 1, quoted[0]).otherwise(F.concat(F.lit("["), F.array_join(quoted, ","), F.lit("]")))
        return F.when(F.size(names) > 0, F.concat(F.lit(f'"{element}": {{"Departement": '), value, F.lit("}, "))).otherwise(F.lit(""))

    leading, involved = departments(F.substring(f["file_id"], 2, 20).cast("bigint"))
    page = F.concat(
        F.lit('{"SearchDetailResponse": {"@numHits": "1", "Hit": [{"Geschaeft": {'),
        F.coalesce(F.concat(F.lit('"GRNr": "'), "grnr", F.lit('", ')), F.lit("")),
        F.coalesce(F.concat(F.lit('"Geschaeftsart": '), kinds, F.lit(", ")), F.lit("")),
        department("FederfuehrendesDepartement", leading), department("MitbeteiligteDepartemente", involved),
        F.lit('"Titel": "'), "titel", F.lit('", "Ablaufschritte": {"Aufgabe": '), task, F.lit("}}}]}}"))
    return b.select("dateiname", page.alias("page"))


# ---------------------------------------------------------------- XML hits

def _xml_doc(k: Column, a: Column, d: Column) -> Column:
    final = (k + a + d) % 2 == 0
    title = F.concat(F.when(final, F.lit("SCHLUSSabstimmung ")).otherwise(F.lit("Antrag ")),
                     _n(a), F.lit("."), _n(d))
    file_el = (F.when((k + a * d) % 4 == 0, F.lit(""))
                .when((k + d) % 11 == 0, F.lit("<File/>"))
                .otherwise(F.concat(F.lit('<File ID="'), _n(k), F.lit("-"), _n(a), F.lit("-"), _n(d),
                                    F.lit('"/>'))))
    return F.concat(F.lit("<Dokument><Titel>"), title, F.lit("</Titel>"), file_el, F.lit("</Dokument>"))


def hits_xml(t: Tables) -> DataFrame:
    """One search-result ``<Hit>`` per order, as XML text.

    An order has 1 + key%3 tasks, task ``a`` has 1 + (key+a)%3 documents;
    document ``d`` of task ``a`` is a final vote when key+a+d is even, has no
    file when key+a*d is a multiple of 4 and a file without ID when key+d is
    a multiple of 11.  Every 50th order has no business number, every 9th no
    title; departments as :func:`departments` says, without any the branch is missing.
    """
    o = _dealt(t.orders.select("o_orderkey", "o_orderdate"), "o_orderkey")
    k = F.col("o_orderkey")
    tasks = F.transform(
        F.sequence(F.lit(1).cast("bigint"), (k % 3 + 1)),
        lambda a: F.concat(
            F.lit("<Aufgabe><Dokumente>"),
            F.array_join(F.transform(F.sequence(F.lit(1).cast("bigint"), (k + a) % 3 + 1),
                                     lambda d: _xml_doc(k, a, d)), ""),
            F.lit("</Dokumente></Aufgabe>")))
    grnr = F.when(k % 50 != 0, F.concat(F.lit("<GRNr>"), _n(F.year("o_orderdate")), F.lit("/"), _n(k),
                                        F.lit("</GRNr>"))).otherwise(F.lit(""))
    title = F.when(k % 9 != 0, F.concat(F.lit("<Titel>Geschäft "), _n(k), F.lit("</Titel>"))).otherwise(F.lit(""))

    def branch(element, names):
        each = F.transform(names, lambda x: F.concat(F.lit("<Departement>"), x, F.lit("</Departement>")))
        return F.when(F.size(names) > 0, F.concat(F.lit(f"<{element}>"), F.array_join(each, ""), F.lit(f"</{element}>"))).otherwise(F.lit(""))

    leading, involved = departments(k)
    xml = F.concat(
        F.lit('<Hit xmlns="http://example.org/searchDetailResponse">'
              '<Geschaeft xmlns="http://example.org/Geschaeft">'),
        grnr, title, branch("FederfuehrendesDepartement", leading), branch("MitbeteiligteDepartemente", involved),
        F.lit("<Ablaufschritte>"), F.array_join(tasks, ""),
        F.lit("</Ablaufschritte></Geschaeft></Hit>"))
    return o.select(k.alias("o_orderkey"), F.year("o_orderdate").cast("int").alias("year_source"),
                    xml.alias("xml"))


def hits(t: Tables) -> DataFrame:
    return parse_hits(hits_xml(t))


# ------------------------------------------------------------------ survey

_LABEL_1, _LABEL_6 = SCORE_LABELS[0][0], SCORE_LABELS[-1][0]


_ANSWERS = 8


def _answer_label(n: int) -> str:
    """0 -> null, 1 and 6 -> the labelled ends, 7 -> 'weiss nicht', else 'Note n'."""
    if n == 0:
        return "NULL"
    return f"'{ {1: _LABEL_1, 6: _LABEL_6, 7: 'weiss nicht'}.get(n, f'Note {n}') }'"


def answer_label_sql(n: str) -> str:
    """The label of ``n % 8`` by its place in a constant list (a remainder has the
    sign of ``n``): a CASE with a text built for each of some 400 columns was
    most of a survey job's time."""
    labels = ", ".join(_answer_label(i) for i in range(1 - _ANSWERS, _ANSWERS))
    return f"get(array({labels}), CAST({n} % {_ANSWERS} AS INT) + {_ANSWERS - 1})"


def raw_survey(t: Tables) -> DataFrame:
    return raw_survey_from_events(_dealt(t.events.select("event_id", "user_id", "event_type", "value"), "event_id"))


def raw_survey_from_events(e: DataFrame) -> DataFrame:
    """One respondent per event; every survey column is text.

    Year 2019 + event_id%5; weights from the event value (pgewicht = value + 1,
    missing for every third event); answer column j is label((event_id + j) % 8).
    The ~400 columns are given as SQL text, one call into the JVM.
    """
    cols = [
        "CAST(2019 + event_id % 5 AS STRING) AS Jahr",
        "event_type AS methode",
        "CASE WHEN value IS NOT NULL THEN format_string('%.2f', value) END AS sgewicht",
        "CASE WHEN event_id % 3 <> 0 AND value IS NOT NULL THEN format_string('%.2f', value + 1) END AS pgewicht",
        "CAST(user_id AS STRING) AS schichtId",
        "concat('Kreis ', CAST(user_id % 12 + 1 AS STRING)) AS A1BVSKreis01",
        "CAST(user_id % 34 AS STRING) AS A1BVSQuar03",
        "CASE WHEN user_id % 2 = 0 THEN 'weiblich' ELSE 'männlich' END AS A1BVSSex01",
        "CAST(user_id % 60 + 18 AS STRING) AS A1BVSAlterV03",
    ]
    cols += [f"{answer_label_sql(f'(event_id + {j})')} AS {c}"
             for j, c in enumerate(survey_answer_columns())]
    return e.selectExpr(*cols)


# ------------------------------------------------------------ questionnaire

QUESTION_BINDING_PATTERN = r"^([AE][a-z]*) +(.*)"


def questionnaire_pages(t: Tables) -> DataFrame:
    """``(doc_id, year, page, text)``: a document's language stands in for the
    questionnaire year; pages are split at form feeds."""
    d = t.documents.select("doc_id", F.col("lang").alias("year"), "text")
    return split_pages(d)


def numbered_questionnaire_pages(t: Tables) -> DataFrame:
    """The same documents as questionnaires in the source's own form: of each
    three lines the first is a question ``F<n>a.``, the second its continuation
    (or, on even lines, a box to tick) and the third a question ``S<n>.``; a form
    feed ends every tenth line."""
    def line(x, i):
        n = (i + 1).cast("string")
        body = (F.when(i % 3 == 0, F.concat(F.lit("F"), n, F.lit("a. "), x))
                 .when(i % 3 == 2, F.concat(F.lit("S"), n, F.lit(". "), x))
                 .when(i % 2 == 1, F.concat(F.lit("☐ "), x)).otherwise(x))
        return F.concat(F.when(i == 0, F.lit("")).when(i % 10 == 0, F.lit("\f")).otherwise(F.lit("\n")), body)

    lines = F.split(F.replace("text", F.lit("\f"), F.lit(" ")), "\n", -1)
    d = t.documents.select("doc_id", F.col("lang").alias("year"), F.array_join(F.transform(lines, line), "").alias("text"))
    return split_pages(d)
