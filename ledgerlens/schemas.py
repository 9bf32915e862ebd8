"""Declared schemas, mapping lists and fixed vocabularies of the data model.

Every logical table of the civic-spending star has a declared ``StructType``
here, so that readers never infer a schema from the data (inference costs an
extra pass over the input and drifts between files).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for right results.
# ---------------------------------------------------------------------------

# Amount types of the spending API, in the order the work grid enumerates them.
AMOUNT_TYPES = ("GEMEINDERAT_BESCHLUSS", "RECHNUNG", "STADTRAT_ANTRAG")

# Two-digit accounts counted as "Citizen Impact"; every other account
# (including null and values with surrounding blanks) is "Overhead".
CITIZEN_IMPACT_ACCOUNTS = ("30", "31", "33", "34", "35", "36", "39")
CITIZEN_IMPACT = "Citizen Impact"
OVERHEAD = "Overhead"

# Measure labels of the expenditure-trend view, one per amount type.
TREND_TYPES = (
    ("Accounts", "RECHNUNG"),
    ("Budget", "GEMEINDERAT_BESCHLUSS"),
    ("Supplementary Credits", "STADTRAT_ANTRAG"),
)

# Survey answer label -> score.  Anything else (e.g. "weiss nicht") is null.
SCORE_LABELS = (
    ("Note 1 (überhaupt nicht gut)", 1),
    ("Note 2", 2),
    ("Note 3", 3),
    ("Note 4", 4),
    ("Note 5", 5),
    ("Note 6 (sehr gut)", 6),
)

# Phrase that marks a final-vote document (matched case-insensitively).
FINAL_VOTE_PHRASE = "schlussabstimmung"

# Footer that a tie-breaker line may run into; such a value means "no text".
PROTOCOL_FOOTER = "Stadt Zürich"

# Default title of a business item that has none.
NO_TITLE = "No Title"

# Plausible year range used by the data-quality rules.
YEAR_MIN, YEAR_MAX = 1900, 2100

# Survey questionnaire years and the first year of the historical load.
QUESTIONNAIRE_YEARS = (2019, 2021, 2023)
HISTORY_START_YEAR = 2019

# ---------------------------------------------------------------------------
# Survey layout.  The 402 mapped survey columns are built from a rule:
# five design columns, four stratification columns, then answer columns
# named <stem><item><wave> where items run aa, ab, ..., az, ba, ...
# Fixed values: (stem, number of items, wave suffix), in questionnaire order.
# ---------------------------------------------------------------------------

SURVEY_DESIGN_COLUMNS = ("Jahr", "methode", "sgewicht", "pgewicht", "schichtId")
SURVEY_STRATA_COLUMNS = ("A1BVSKreis01", "A1BVSQuar03", "A1BVSSex01", "A1BVSAlterV03")
SURVEY_ANSWER_STEMS = (
    ("A2001", 1, "01"), ("A2002", 1, "01"), ("A2003", 7, "01"), ("A2004", 15, "01"),
    ("A2005", 15, "01"), ("A2006", 1, "01"), ("A2007", 1, "01"), ("A2008", 1, "01"),
    ("A2009", 1, "01"), ("A2010", 1, "01"), ("A2011", 1, "01"), ("A2012", 1, "01"),
    ("A2013", 6, "01"), ("A2014", 5, "01"), ("A3001", 1, "03"), ("A3002", 1, "01"),
    ("A3003", 1, "01"), ("A3004", 1, "02"), ("A3005", 1, "01"), ("A3006", 1, "01"),
    ("A3007", 3, "01"), ("A3008", 1, "01"), ("A3009", 1, "01"), ("A3010", 1, "01"),
    ("A3011", 1, "01"), ("A3012", 1, "01"), ("A3013", 1, "01"), ("A3014", 6, "01"),
    ("A3015", 6, "01"), ("A3016", 10, "01"), ("A3017", 1, "01"), ("A3018", 6, "01"),
    ("A3019", 6, "01"), ("A4001", 1, "01"), ("A4002", 1, "01"), ("A4003", 1, "01"),
    ("A4004", 8, "01"), ("A4006", 1, "01"), ("A4007", 8, "01"), ("A4008", 13, "01"),
    ("A5001", 1, "01"), ("A5008", 4, "01"), ("A5002", 1, "01"), ("A5003", 1, "01"),
    ("A5009", 5, "01"), ("A5004", 1, "01"), ("A5005", 1, "01"), ("A5010", 5, "01"),
    ("A5006", 1, "01"), ("A5007", 1, "01"), ("A5011", 5, "01"), ("A5012", 1, "01"),
    ("A6001", 2, "01"), ("A6002", 1, "01"), ("A6003", 5, "01"), ("A7001", 11, "01"),
    ("A7002", 77, "01"), ("A7003", 13, "01"), ("A7004", 9, "01"), ("A7005", 9, "01"),
    ("A7006", 11, "01"), ("A7007", 7, "01"), ("A7008", 8, "01"), ("A7009", 1, "01"),
    ("A7010", 13, "01"), ("A8002", 3, "01"), ("A9001", 5, "01"), ("A9002", 1, "01"),
    ("A9003", 1, "01"), ("A9004", 1, "01"), ("A9005", 3, "01"), ("B1001", 1, "01"),
    ("B1002", 2, "01"), ("B1003", 13, "01"), ("B1004", 16, "01"), ("B1005", 1, "01"),
    ("B1006", 1, "01"), ("B1007", 9, "01"), ("B1008", 1, "01"), ("A1027", 1, "01"),
)

# The two answer columns the satisfaction views score.
SCORE_COLUMNS = (
    ("A2001aa01", "score_beliebtheit_zh", "float_beliebtheit_zh"),
    ("A2002aa01", None, "float_quality_of_life"),
)


def _item_label(i: int) -> str:
    return chr(ord("a") + i // 26) + chr(ord("a") + i % 26)


def survey_answer_columns() -> list[str]:
    return [f"{stem}{_item_label(i)}{wave}"
            for stem, n, wave in SURVEY_ANSWER_STEMS for i in range(n)]


def survey_columns() -> list[str]:
    return list(SURVEY_DESIGN_COLUMNS) + list(SURVEY_STRATA_COLUMNS) + survey_answer_columns()


# ---------------------------------------------------------------------------
# Mapping lists: (source, source type, target, target type).
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Mapping:
    source: str
    source_type: str
    target: str
    target_type: str


def _m(*rows):
    return [Mapping(*r) for r in rows]


VOTE_MAPPING = _m(
    ("dateiname", "string", "dateiname", "string"),
    ("geschäftstitel", "string", "geschaeftstitel", "string"),
    ("geschäftsnummer", "string", "geschaeftsnummer", "string"),
    ("stimm_datum", "string", "stimm_datum", "string"),
    ("stimm_zeit", "string", "stimm_zeit", "string"),
    ("ja", "int", "ja", "int"),
    ("nein", "int", "nein", "int"),
    ("enthalten", "int", "enthalten", "int"),
    ("nicht_praesent", "int", "nicht_praesent", "int"),
    ("total_stimmen", "int", "total_stimmen", "int"),
    ("stichentscheid", "string", "stichentscheid", "string"),
)

BUSINESS_MAPPING = _m(
    ("dateiname", "string", "dateiname", "string"),
    ("grnr", "string", "grnr", "string"),
    ("titel", "string", "titel", "string"),
    ("pdf_files", "string", "pdf_files", "string"),
    ("geschaeftsart", "string", "geschaeftsart", "string"),
)

INSTITUTION_MAPPING = _m(
    ("bezeichnung", "string", "bezeichnung", "string"),
    ("departement.bezeichnung", "string", "departement.bezeichnung", "string"),
    ("departement.key", "string", "departement.key", "string"),
    ("departement.kurzname", "string", "departement.kurzname", "string"),
    ("key", "string", "key", "string"),
    ("kurzname", "string", "kurzname", "string"),
)

ACCOUNT_MAPPING = _m(
    ("bezeichnung", "string", "bezeichnung", "string"),
    ("id", "int", "id", "int"),
    ("institution.bezeichnung", "string", "institution.bezeichnung", "string"),
    ("institution.departement.bezeichnung", "string", "departement.bezeichnung", "string"),
    ("institution.departement.key", "string", "departement.key", "string"),
    ("institution.departement.kurzname", "string", "departement.kurzname", "string"),
    ("institution.key", "string", "institution.key", "string"),
    ("institution.kurzname", "string", "institution.kurzname", "string"),
    ("kontoNr", "string", "kontoNr", "string"),
)

SPENDING_MAPPING = _m(
    ("betrag", "string", "betrag", "double"),
    ("betragstyp", "string", "betragstyp", "string"),
    ("institution", "string", "institution", "string"),
    ("jahr", "int", "jahr", "int"),
    ("sachkonto", "string", "sachkonto", "string"),
)


def survey_mapping() -> list[Mapping]:
    return [Mapping(c, "string", c, "string") for c in survey_columns()]


# ---------------------------------------------------------------------------
# Raw-zone schemas (declared on read).
# ---------------------------------------------------------------------------

S = StringType()

DEPARTMENT_STRUCT = StructType([
    StructField("key", S), StructField("bezeichnung", S), StructField("kurzname", S),
])

INSTITUTION_RECORD = StructType([
    StructField("key", S), StructField("bezeichnung", S), StructField("kurzname", S),
    StructField("departement", DEPARTMENT_STRUCT),
])

ACCOUNT_RECORD = StructType([
    StructField("id", IntegerType()), StructField("kontoNr", S), StructField("bezeichnung", S),
    StructField("institution", INSTITUTION_RECORD),
])

SPENDING_RECORD = StructType([
    StructField("betrag", S), StructField("betragstyp", S), StructField("institution", S),
    StructField("jahr", IntegerType()), StructField("sachkonto", S),
])


def envelope(record: StructType) -> StructType:
    """``{"value": [record, ...]}`` as returned by the spending API."""
    return StructType([StructField("value", ArrayType(record))])


VOTE_RECORD = StructType([
    StructField("Dateiname", S), StructField("Geschäftstitel", S),
    StructField("Geschäftsnummer", S), StructField("Stimm_Datum", S),
    StructField("Stimm_Zeit", S), StructField("JA", IntegerType()),
    StructField("NEIN", IntegerType()), StructField("Enthalten", IntegerType()),
    StructField("Nicht_Praesent", IntegerType()), StructField("Total_Stimmen", IntegerType()),
    StructField("Stichentscheid", S),
])

PDF_FILE = StructType([StructField("titel", S), StructField("file_id", S)])

WORK_ITEM = StructType([
    StructField("institution", S), StructField("jahr", IntegerType()), StructField("betragstyp", S),
])

VOTE_ITEM = StructType([
    StructField("grnr", S), StructField("titel", S),
    StructField("pdf_files", ArrayType(PDF_FILE)), StructField("year_source", IntegerType()),
])

# One <Hit> of the parliamentary search response.  Repeated elements are
# declared as arrays, so that one child and many children read the same way.
HIT_XML = StructType([
    StructField("Geschaeft", StructType([
        StructField("GRNr", S),
        StructField("Titel", S),
        StructField("FederfuehrendesDepartement", StructType([StructField("Departement", ArrayType(S))])),
        StructField("MitbeteiligteDepartemente", StructType([StructField("Departement", ArrayType(S))])),
        StructField("Ablaufschritte", StructType([
            StructField("Aufgabe", ArrayType(StructType([
                StructField("Dokumente", StructType([
                    StructField("Dokument", ArrayType(StructType([
                        StructField("Titel", S),
                        StructField("File", StructType([StructField("_ID", S)])),
                    ]))),
                ])),
            ]))),
        ])),
    ])),
])
