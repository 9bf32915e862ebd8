"""Work lists: final-vote documents, document ordinals, spending work grid,
coverage gaps and pending work.

The source system drove these through a message queue; here a work list is
a DataFrame.  Unnesting the search tree is row-local (``filter``/``transform``
over the hit's own arrays), document ordinals come from ``posexplode`` (no
window), the grid multiplies each key by *parameter* lists with ``explode``
(no cross join of data), and "what is missing" is a ``left_anti`` join
against distinct fact keys, de-duplicated map-side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import contains_ci
from ..schemas import AMOUNT_TYPES, FINAL_VOTE_PHRASE, HIT_XML, NO_TITLE


def parse_hits(df: DataFrame, xml: str = "xml") -> DataFrame:
    """One ``<Hit>`` element per row (text) -> the declared hit struct."""
    return df.select("*", F.from_xml(F.col(xml), HIT_XML, {"mode": "PERMISSIVE"}).alias("hit"))


def rejected_hits(df: DataFrame, xml: str = "xml") -> DataFrame:
    """The rows whose XML does not parse as a hit, with the raw text in
    ``_corrupt_record``; :func:`final_vote_items` has no item of them."""
    schema = StructType([*HIT_XML.fields, StructField("_corrupt_record", StringType())])
    hit = F.from_xml(F.col(xml), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    bad = df.select("*", F.explode(F.array(hit["_corrupt_record"])).alias("_corrupt_record"))
    return bad.filter(F.col("_corrupt_record").isNotNull())


def _present(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def final_vote_items(hits: DataFrame, *, hit: str = "hit", phrase: str = FINAL_VOTE_PHRASE,
                     year_source: Column | int | None = None) -> DataFrame:
    """Business items with at least one final-vote document.

    Output ``(grnr, titel, pdf_files, year_source)``; ``pdf_files`` keeps the
    document order of the search tree.  A hit without number is skipped, a
    missing title becomes 'No Title', a document counts when its title
    contains ``phrase`` (any case) and it has a file with an ID.
    """
    g = F.col(f"{hit}.Geschaeft")
    docs = F.flatten(F.transform(
        F.coalesce(g["Ablaufschritte"]["Aufgabe"], F.array()),
        lambda a: F.coalesce(a["Dokumente"]["Dokument"], F.array())))
    finals = F.transform(
        F.filter(docs, lambda d: _present(d["Titel"]) & contains_ci(d["Titel"], phrase)
                 & _present(d["File"]["_ID"])),
        lambda d: F.struct(d["Titel"].alias("titel"), d["File"]["_ID"].alias("file_id")))
    ys = year_source if isinstance(year_source, Column) else F.lit(year_source).cast("int")
    item = F.struct(
        g["GRNr"].alias("grnr"),
        F.coalesce(g["Titel"], F.lit(NO_TITLE)).alias("titel"),
        finals.alias("pdf_files"),
        ys.alias("year_source"))
    # The keep-condition is applied inside the generator: a Filter would be
    # pushed below the projection and re-parse the hit once per predicate.
    keep = F.filter(F.array(item), lambda r: _present(r["grnr"]) & (F.size(r["pdf_files"]) > 0))
    return hits.select(F.inline(keep))


def document_items(hits: DataFrame, *, hit: str = "hit") -> DataFrame:
    """``(grnr, pdf_files)`` of every hit with a number: all documents in the
    order of the search tree, with or without title and file."""
    g = F.col(f"{hit}.Geschaeft")
    files = F.flatten(F.transform(
        F.coalesce(g["Ablaufschritte"]["Aufgabe"], F.array()),
        lambda a: F.transform(F.coalesce(a["Dokumente"]["Dokument"], F.array()),
                              lambda d: F.struct(d["Titel"].alias("titel"), d["File"]["_ID"].alias("file_id")))))
    item = F.struct(g["GRNr"].alias("grnr"), files.alias("pdf_files"))
    # As above: the condition stays inside the generator.
    return hits.select(F.inline(F.filter(F.array(item), lambda r: _present(r["grnr"]))))


def final_vote_documents(items: DataFrame) -> DataFrame:
    """One row per final-vote document: ``(grnr, titel, doc_titel, file_id)``."""
    return items.select("grnr", "titel", F.explode("pdf_files").alias("f")) \
                .select("grnr", "titel", F.col("f.titel").alias("doc_titel"),
                        F.col("f.file_id").alias("file_id"))


def number_documents(items: DataFrame) -> DataFrame:
    """Download list: ordinal of each document within its item, 1-based and
    counted *before* documents without a file ID are skipped, plus the file
    name ``<grnr with / as ->_abstimmung_<ordinal>.pdf``."""
    x = items.select("grnr", F.posexplode("pdf_files").alias("pos", "f"))
    base = F.replace(F.col("grnr"), F.lit("/"), F.lit("-"))
    ordinal = (F.col("pos") + 1).cast("int")
    return (x.filter(_present(F.col("f.file_id")))
             .select("grnr", ordinal.alias("ordinal"),
                     F.coalesce(F.col("f.titel"), F.lit("unknown")).alias("doc_titel"),
                     F.col("f.file_id").alias("file_id"),
                     F.concat(base, F.lit("_abstimmung_"), ordinal.cast("string"), F.lit(".pdf"))
                      .alias("pdf_filename")))


def items_to_json(items: DataFrame) -> DataFrame:
    """Work-item messages as JSON text (``grnr, titel, pdf_files, year_source``)."""
    return items.select(F.to_json(F.struct("grnr", "titel", "pdf_files", "year_source")).alias("body"))


def department_bridge(items: DataFrame, *, grnr: str = "grnr", leading: str = "federfuehrend",
                      involved: str = "mitbeteiligt") -> DataFrame:
    """``(grnr, role, department)``: one row for each department of a business,
    ``leading`` or ``involved``, from the department lists of
    :func:`business_items` (JSON) or :func:`hit_businesses` (XML). Blank names
    and repeated ones count once or not at all; a business without a department
    has no row, nor has one without number."""
    def role(name, column):
        names = F.array_distinct(F.filter(F.col(column), lambda d: _present(F.trim(d))))
        return F.transform(names, lambda d: F.struct(F.lit(name).alias("role"), d.alias("department")))

    return (items.filter(_present(F.col(grnr)))
            .select(F.col(grnr).alias("grnr"), F.inline(F.concat(role("leading", leading), role("involved", involved)))))


def hit_businesses(hits: DataFrame, *, hit: str = "hit") -> DataFrame:
    """``(grnr, federfuehrend, mitbeteiligt)`` of every hit: its department lists,
    empty where a branch is missing, one name or many alike."""
    g = F.col(f"{hit}.Geschaeft")
    none = F.array().cast("array<string>")
    item = F.struct(g["GRNr"].alias("grnr"),
                    F.coalesce(g["FederfuehrendesDepartement"]["Departement"], none).alias("federfuehrend"),
                    F.coalesce(g["MitbeteiligteDepartemente"]["Departement"], none).alias("mitbeteiligt"))
    # As above: a later filter stays above the parse.
    return hits.select(F.inline(F.array(item)))


# A landed search page: the root element's name, then the hits. Elements that
# the page writes as one object or as a list, by their number, are kept as
# JSON text and made lists by _listed.
_PAGE = "map<string, struct<Hit: string>>"
_HIT = """array<struct<Geschaeft: struct<GRNr: string, Titel: string, Geschaeftsart: string,
  FederfuehrendesDepartement: struct<Departement: string>, MitbeteiligteDepartemente: struct<Departement: string>,
  Ablaufschritte: struct<Aufgabe: string>>>>"""
_TASKS = "array<struct<Dokumente: struct<Dokument: string>>>"
_DOCUMENTS = "array<struct<Titel: string, File: struct<`@ID`: string>>>"


def _listed(c: Column, schema: str) -> Column:
    """JSON text of a list or of one object -> the list; absent -> empty."""
    text = F.when(F.startswith(F.ltrim(c), F.lit("[")), c).otherwise(F.concat(F.lit("["), c, F.lit("]")))
    return F.coalesce(F.from_json(text, schema), F.array().cast(schema))


def _names(c: Column) -> Column:
    """A text, or JSON text of a list of them -> list of texts (objects as JSON); absent -> null."""
    return F.coalesce(F.when(F.startswith(F.ltrim(c), F.lit("[")), F.from_json(c, "array<string>")),
                      F.when(c.isNotNull(), F.array(c)))


def business_items(pages: DataFrame, *, page: str = "page", dateiname: str = "dateiname",
                   phrase: str = FINAL_VOTE_PHRASE) -> DataFrame:
    """Landed search pages (JSON text) -> one row per business, for ``clean_businesses``:
    ``(dateiname, grnr, titel, pdf_files, geschaeftsart, federfuehrend, mitbeteiligt)``.

    ``pdf_files`` holds the final-vote documents that have a file.  Departments
    are lists, empty where the page has none; ``geschaeftsart`` is a list, null
    where absent.  A page without hits has no rows, nor has one that does not
    parse: :func:`rejected_pages` gives those.
    """
    roots = F.map_values(F.from_json(F.col(page), _PAGE))
    hits = F.flatten(F.transform(roots, lambda r: _listed(r["Hit"], _HIT)))
    g = F.col("_hit.Geschaeft")
    documents = F.flatten(F.transform(_listed(g["Ablaufschritte"]["Aufgabe"], _TASKS),
                                      lambda a: _listed(a["Dokumente"]["Dokument"], _DOCUMENTS)))
    finals = F.transform(
        F.filter(documents, lambda d: _present(d["Titel"]) & contains_ci(d["Titel"], phrase)
                 & _present(d["File"]["@ID"])),
        lambda d: F.struct(d["Titel"].alias("titel"), d["File"]["@ID"].alias("file_id")))
    none = F.array().cast("array<string>")
    item = F.struct(
        F.col(dateiname).alias("dateiname"), g["GRNr"].alias("grnr"), F.coalesce(g["Titel"], F.lit(NO_TITLE)).alias("titel"),
        finals.alias("pdf_files"), _names(g["Geschaeftsart"]).alias("geschaeftsart"),
        F.coalesce(_names(g["FederfuehrendesDepartement"]["Departement"]), none).alias("federfuehrend"),
        F.coalesce(_names(g["MitbeteiligteDepartemente"]["Departement"]), none).alias("mitbeteiligt"))
    # Through a generator, as in final_vote_items: a later filter is not pushed below the parse.
    return pages.select(dateiname, F.explode(hits).alias("_hit")).select(F.inline(F.array(item)))


def rejected_pages(pages: DataFrame, page: str = "page") -> DataFrame:
    """The pages that are not JSON objects, or empty ones (cut off, no text, no JSON)."""
    schema = "map<string, string>"
    return pages.filter(F.coalesce(F.size(F.from_json(F.col(page), schema, {"mode": "PERMISSIVE"})), F.lit(-1)) < 1)


def work_grid(institutions: DataFrame, years: Sequence[int] | Column,
              amount_types: Sequence[str] = AMOUNT_TYPES, key: str = "institution") -> DataFrame:
    """Every (institution, year, amount type) combination to fetch.

    The years and amount types are parameter lists, exploded next to each
    institution row: the output grows linearly with the institutions, and
    there is no cross join or shuffle.
    """
    ys = years if isinstance(years, Column) else F.array(*[F.lit(int(y)) for y in years])
    ts = F.array(*[F.lit(t) for t in amount_types])
    return (institutions.select(F.col(key).alias("institution"), F.explode(ys).alias("jahr"))
            .select("institution", "jahr", F.explode(ts).alias("betragstyp")))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key tuples; partial aggregation removes duplicates before the
    shuffle, so a key that holds a large share of the rows ships once per task."""
    return df.select(*keys).dropDuplicates(list(keys))


def coverage_gaps(grid: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Grid combinations for which no fact row exists."""
    return grid.join(distinct_keys(facts, keys), list(keys), "left_anti")


@dataclass(frozen=True)
class Days:
    """A grid dimension: every day from ``lo`` to ``hi``, given as dates or as
    columns of one value (scalar subqueries); nothing if either is null."""
    lo: Column | date
    hi: Column | date


@dataclass(frozen=True)
class Values:
    """A grid dimension: the values of a list, or of an array column of one value."""
    values: Sequence | Column


def missing_combinations(facts: DataFrame, entity: str, dims: dict[str, Days | Values | Sequence],
                         entities: DataFrame | None = None) -> DataFrame:
    """Coverage gaps without materialising the grid: for every entity, the
    combinations of ``dims`` (e.g. days x types) for which no fact row exists.

    Every combination has a number, computed from its values (a day by its
    distance, a value by its place in the list). The numbers of an entity's
    facts are kept as sparse bitmaps: a row (entity, bucket) with a 64-bit word,
    OR-ed map-side, so a hot entity ships at most one row per bucket and task,
    and a bucket without facts is no row. The missing combinations are then
    generated row-locally from the unset bits of all buckets. The plan is the
    same for any grid; the grid itself is never shuffled.  A fact outside the
    grid (or with a null dimension) covers nothing, but its entity is there.
    ``entities`` (one column named ``entity``) adds entities without any fact.
    """
    dims = {n: d if isinstance(d, (Days, Values)) else Values(d) for n, d in dims.items()}
    names = list(dims)
    start, size = {}, {}
    for n, d in dims.items():
        if isinstance(d, Days):
            lo, hi = (x if isinstance(x, Column) else F.lit(x) for x in (d.lo, d.hi))
            start[n], size[n] = lo, F.coalesce(F.greatest(F.datediff(hi, lo) + 1, F.lit(0)), F.lit(0)).cast("long")
        else:
            start[n] = d.values if isinstance(d.values, Column) else F.array(*[F.lit(v) for v in d.values])
            size[n] = F.coalesce(F.size(start[n]), F.lit(0)).cast("long")

    def grid(df):
        """``df`` with the starts and sizes of the dimensions, the same in every row."""
        return df.select("*", *[c.alias(f"_{k}_{n}") for n in names for k, c in (("start", start[n]), ("size", size[n]))])

    g = grid(facts.select(entity, *names))
    ok, idx = F.lit(True), F.lit(0).cast("long")
    for n, d in dims.items():
        begin = F.col(f"_start_{n}")
        at = (F.datediff(F.col(n), begin) if isinstance(d, Days) else F.array_position(begin, F.col(n)) - 1).cast("long")
        ok = ok & (at >= 0) & (at < F.col(f"_size_{n}"))
        idx = idx * F.col(f"_size_{n}") + at
    g = g.select(entity, F.when(ok, idx).alias("_i"))
    words = (g.groupBy(entity, F.expr("_i DIV 64").alias("_bucket"))
             .agg(F.expr("bit_or(shiftleft(1L, CAST(_i % 64 AS INT)))").alias("_word")))
    have = words.groupBy(entity).agg(F.map_from_entries(F.collect_list(
        F.when(F.col("_bucket").isNotNull(), F.struct("_bucket", "_word")))).alias("_words"))
    if entities is not None:
        have = entities.select(entity).distinct().join(have, entity, "left")
    have = grid(have)
    total = F.lit(1).cast("long")
    for n in names:
        total = total * F.col(f"_size_{n}")
    have = have.withColumn("_total", total).filter("_total > 0")
    buckets = have.withColumn("_bucket", F.explode(F.expr("sequence(0L, (_total - 1) DIV 64)")))
    buckets = buckets.withColumn("_word", F.coalesce(F.try_element_at("_words", F.col("_bucket")), F.lit(0).cast("long"))).drop("_words")
    unset = F.expr("filter(sequence(_bucket * 64, least(_bucket * 64 + 63, _total - 1)), "
                   "i -> shiftright(_word, CAST(i % 64 AS INT)) & 1L = 0)")
    out = buckets.withColumn("_i", F.explode(unset))
    stride, values = F.lit(1).cast("long"), {}
    for n in reversed(names):
        place = (F.floor(F.col("_i") / stride) % F.col(f"_size_{n}")).cast("int")
        begin = F.col(f"_start_{n}")
        values[n] = F.date_add(begin, place) if isinstance(dims[n], Days) else F.element_at(begin, place + 1)
        stride = stride * F.col(f"_size_{n}")
    return out.select(entity, *[values[n].alias(n) for n in names])


def pending(work: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Work items not finished yet (idempotent re-runs skip what exists)."""
    return work.join(distinct_keys(done, keys), list(keys), "left_anti")
