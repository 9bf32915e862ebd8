"""Field extraction from document text held as a table.

Vote protocols: ``(doc, page_no, text)`` -> one vote record per document,
read from its first page.  Questionnaires: ``(year, page, text)`` -> one row
per question.  Both are row-local (regular expressions and array
higher-order functions over each row's own text): no shuffle, no Python
worker, and every text is processed whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import field, int_field, ustrip
from ..schemas import PROTOCOL_FOOTER

# Fixed patterns of the vote protocol's first page (label, then value).
P_TITLE = r"(?s)Geschäftstitel:(.*?)Geschäfts#:"
P_NUMBER = r"(?U)Geschäfts#:\s*([\d/]+)"
P_DATE = r"(?U)Stimm-Datum:\s*(\d{2}\.\d{2}\.\d{4})"
P_TIME = r"(?U)Stimm-Zeit:\s*(\d{2}:\d{2}:\d{2})"
P_COUNTERS = (
    ("JA", r"(?U)JA:\s*(\d+)"),
    ("NEIN", r"(?U)NEIN:\s*(\d+)"),
    ("Enthalten", r"(?U)Enthalten:\s*(\d+)"),
    ("Nicht_Praesent", r"(?U)Nicht Präsent:\s*(\d+)"),
    ("Total_Stimmen", r"(?U)Total Stimmen:\s*(\d+)"),
)
P_TIEBREAK = r"(?U)(?d)Stichentscheid:\s*(.*)"
PROTOCOL_FIELDS = ("Geschäftstitel", "Geschäftsnummer", "Stimm_Datum", "Stimm_Zeit",
                   *(name for name, _ in P_COUNTERS), "Stichentscheid")

# Questionnaire question: "F12a. text" or "S3. text" at the start of a line.
QUESTION_PATTERN = r"(?U)(?d)^(S\d+[a-z]?|F\d+[a-z]?)\.\s+(.*)"
STOP_PREFIX = "☐"


def tie_breaker(text: Column) -> Column:
    """Three states: null = label absent; '' = empty or only the city footer."""
    v = ustrip(F.regexp_extract(text, P_TIEBREAK, 1))
    return (F.when(~text.rlike(P_TIEBREAK), F.lit(None).cast("string"))
             .when(v.contains(PROTOCOL_FOOTER), F.lit(""))
             .otherwise(v))


def protocol_fields(text: Column) -> list[Column]:
    title = ustrip(F.regexp_replace(field(text, P_TITLE), "\n", " "))
    cols = [
        title.alias("Geschäftstitel"),
        field(text, P_NUMBER, group_never_empty=True).alias("Geschäftsnummer"),
        field(text, P_DATE, group_never_empty=True).alias("Stimm_Datum"),
        field(text, P_TIME, group_never_empty=True).alias("Stimm_Zeit"),
    ]
    cols += [int_field(text, p).alias(name) for name, p in P_COUNTERS]
    cols.append(tie_breaker(text).alias("Stichentscheid"))
    return cols


def extract_protocol(df: DataFrame, *, text: str = "text", doc: str = "doc",
                     page: str | None = "page_no", context: str | None = None,
                     first_page: int = 1, names: Sequence[str] | None = None) -> DataFrame:
    """Vote records from protocol text, one per document (its first page).

    ``context`` names a column with the business number known from the work
    item; it fills ``Geschäftsnummer`` where the text has none.  ``names`` lists
    the fields to extract (default all); the generator below hides unused ones
    from column pruning, so a caller that needs one field should say so.
    """
    src = df if page is None else df.filter(F.col(page) == first_page)
    t = F.col(text)
    fields = dict(zip(PROTOCOL_FIELDS, protocol_fields(t)))
    if context is not None:
        fields["Geschäftsnummer"] = F.coalesce(field(t, P_NUMBER, group_never_empty=True),
                                               F.col(context)).alias("Geschäftsnummer")
    wanted = [fields[n] for n in (PROTOCOL_FIELDS if names is None else names)]
    # Emitted through a one-row generator: a later filter on an extracted
    # field (e.g. the non-empty business number) cannot be pushed below it,
    # so the regular expressions run once per document.
    return src.select(F.inline(F.array(F.struct(F.col(doc).alias("Dateiname"), *wanted))))


def with_status(votes: DataFrame) -> DataFrame:
    """Per-document outcome: ``ok`` (all fields found), ``partial`` (number
    found, something else missing) or ``error`` (no business number).  A bad
    document never stops the others; the counters are one aggregate over it."""
    number = F.col("Geschäftsnummer").isNotNull()
    complete = F.col("Stimm_Datum").isNotNull() & F.col("Stimm_Zeit").isNotNull() & F.col("JA").isNotNull()
    return votes.withColumn("status", F.when(~number, F.lit("error"))
                            .when(complete, F.lit("ok")).otherwise(F.lit("partial")))


def run_counters(votes: DataFrame) -> DataFrame:
    """``processed, parsed, partial, errors`` over extracted vote records."""
    s = F.col("status")
    return with_status(votes).agg(F.count(F.lit(1)).alias("processed"),
                                  F.count_if(s == "ok").alias("parsed"),
                                  F.count_if(s == "partial").alias("partial"),
                                  F.count_if(s == "error").alias("errors"))


def extract_questions(df: DataFrame, *, text: str = "text", year: str = "year",
                      page: str = "page", pattern: str = QUESTION_PATTERN,
                      stop_prefix: str = STOP_PREFIX, carry: tuple[str, ...] = ()) -> DataFrame:
    """Questions from questionnaire pages: ``(carry..., year, page, id, text)``.

    Each page's text is split on newlines and stripped.  A line matching
    ``pattern`` (group 1 = id, group 2 = text) starts a question; the next line
    is appended (after one space) when it is non-empty, is not itself a
    question and does not start with ``stop_prefix``.  The look-ahead is an
    index into the same row's array, so no window and no shuffle is needed.
    """
    lines = F.transform(F.split(F.col(text), "\n", -1), lambda l: ustrip(l))
    keep = [F.col(c) for c in carry]
    src = df.select(*keep, F.col(year).alias("year"), F.col(page).alias("page"), lines.alias("_lines"))
    L = F.col("_lines")
    # One pass of the pattern over the lines; the groups are cut out, and the
    # next line looked at, only where it matched.
    at = F.filter(F.sequence(F.lit(1), F.size(L)), lambda i: F.element_at(L, i).rlike(pattern))

    def question(i):
        line, nxt = F.element_at(L, i), F.try_element_at(L, i + 1)
        goes_on = nxt.isNotNull() & (nxt != "") & ~nxt.startswith(stop_prefix) & ~nxt.rlike(pattern)
        body = F.regexp_extract(line, pattern, 2)
        return F.struct(F.regexp_extract(line, pattern, 1).alias("id"),
                        F.when(goes_on, F.concat(body, F.lit(" "), nxt)).otherwise(body).alias("text"))

    return src.select(*carry, "year", "page", F.inline(F.transform(at, question)))


def split_pages(df: DataFrame, *, text: str = "text", page_break: str = "\f") -> DataFrame:
    """Document text -> one row per page; pages numbered from 1, empty ones included."""
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.posexplode(F.split(F.col(text), page_break, -1)).alias("_pos", text)) \
             .select(*others, (F.col("_pos") + 1).cast("int").alias("page"), text)


def questions_per_year(questions: DataFrame, year: str = "year") -> DataFrame:
    """Number of questions per questionnaire year."""
    return questions.groupBy(year).agg(F.count(F.lit(1)).alias("n_questions"))
