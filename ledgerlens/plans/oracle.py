"""Oracle SQL: for each query key, DuckDB SQL over the driver's tables that
computes the same result independently of Spark.

The bindings are restated here as SQL; where Spark parses text it rendered
(protocols, XML), the oracle computes the expected fields directly from the
source columns, so a parsing error cannot hide in both engines at once.
Money is summed as DECIMAL(38,10) and reported as DOUBLE on both sides.
"""

from __future__ import annotations

from ..operators import quality
from ..operators.cleaning import CLEAN_JOBS
from ..schemas import (
    CITIZEN_IMPACT_ACCOUNTS,
    SCORE_LABELS,
    survey_answer_columns,
    survey_columns,
)
from .catalog import LANDING_YEAR, MANIFEST_SUFFIX, SURVEY_YEAR_OFFSET, WINDOW_DAYS, WINDOW_TYPES

M = "DECIMAL(38,10)"
IMPACT_IN = ", ".join(f"'{a}'" for a in CITIZEN_IMPACT_ACCOUNTS)


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


# ----------------------------------------------------------------- bindings

AMOUNT_TYPE = ("CASE l_returnflag WHEN 'R' THEN 'RECHNUNG' WHEN 'A' THEN 'STADTRAT_ANTRAG' "
               "ELSE 'GEMEINDERAT_BESCHLUSS' END")

SPENDING = f"""spending AS (
  SELECT l_extendedprice AS betrag, {AMOUNT_TYPE} AS betragstyp,
         CAST(l_suppkey AS VARCHAR) AS institution, CAST(year(l_shipdate) AS INTEGER) AS jahr,
         CAST(30 + l_partkey % 10 AS VARCHAR) AS sachkonto
  FROM lineitem)"""

CLEAN_SPENDING = f"""clean_spending AS (
  SELECT CASE WHEN l_quantity = 1 THEN NULL ELSE l_extendedprice END AS betrag,
         {AMOUNT_TYPE} AS betragstyp,
         CAST(l_suppkey AS VARCHAR) AS institution, CAST(year(l_shipdate) AS INTEGER) AS jahr,
         CAST(30 + l_partkey % 10 AS VARCHAR) AS sachkonto
  FROM lineitem)"""

INSTITUTIONS = """institutions AS (
  SELECT s.s_name AS bezeichnung, n.n_name AS "departement.bezeichnung",
         CAST(n.n_nationkey AS VARCHAR) AS "departement.key",
         substring(n.n_name, 1, 3) AS "departement.kurzname",
         CAST(s.s_suppkey AS VARCHAR) AS key, 'S' || CAST(s.s_suppkey AS VARCHAR) AS kurzname
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey)"""

ACCOUNTS = f"""{INSTITUTIONS},
accounts AS (
  SELECT p.p_name AS bezeichnung, CAST(p.p_partkey AS INTEGER) AS id,
         i.bezeichnung AS "institution.bezeichnung",
         i."departement.bezeichnung", i."departement.key", i."departement.kurzname",
         i.key AS "institution.key", i.kurzname AS "institution.kurzname",
         CAST(30 + p.p_partkey % 10 AS VARCHAR) || '.' || CAST(p.p_partkey AS VARCHAR) AS "kontoNr"
  FROM part p LEFT JOIN institutions i ON CAST(p.p_size AS VARCHAR) = i.key)"""

# Expected fields of the protocol page rendered per order.
PROTOCOLS = """protocols AS (
  SELECT 'protokoll_' || CAST(o_orderkey AS VARCHAR) || '.pdf' AS "Dateiname",
         o_orderpriority || ' Kredit für ' || o_orderstatus || ' Nr ' || CAST(o_orderkey AS VARCHAR)
           AS "Geschäftstitel",
         CASE WHEN o_orderkey % 50 <> 0
              THEN CAST(year(o_orderdate) AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR) END
           AS "Geschäftsnummer",
         CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%d.%m.%Y') END AS "Stimm_Datum",
         CASE WHEN o_orderkey % 13 <> 0 THEN printf('%02d:%02d:%02d', CAST(o_orderkey % 12 + 8 AS INTEGER),
              CAST(o_orderkey % 60 AS INTEGER), CAST(o_orderkey % 59 AS INTEGER)) END AS "Stimm_Zeit",
         CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_orderkey % 125 AS INTEGER) END AS "JA",
         CAST(o_custkey % 90 AS INTEGER) AS "NEIN",
         CAST(o_orderkey % 9 AS INTEGER) AS "Enthalten",
         CAST(o_orderkey % 17 AS INTEGER) AS "Nicht_Praesent",
         CAST(o_orderkey % 125 + o_custkey % 90 + o_orderkey % 9 AS INTEGER) AS "Total_Stimmen",
         CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN o_orderpriority END AS "Stichentscheid",
         o_orderdate
  FROM orders)"""

VOTES = f"""{PROTOCOLS},
votes AS (
  SELECT "Dateiname" AS dateiname, "Geschäftstitel" AS geschaeftstitel,
         "Geschäftsnummer" AS geschaeftsnummer, "Stimm_Datum" AS stimm_datum,
         "Stimm_Zeit" AS stimm_zeit, "JA" AS ja, "NEIN" AS nein, "Enthalten" AS enthalten,
         "Nicht_Praesent" AS nicht_praesent, "Total_Stimmen" AS total_stimmen,
         "Stichentscheid" AS stichentscheid,
         TRY_CAST(substring("Geschäftsnummer", 1, 4) AS INTEGER) AS year
  FROM protocols WHERE "Geschäftsnummer" IS NOT NULL AND "Geschäftsnummer" <> '')"""

BUSINESSES = """businesses AS (
  SELECT 'geschaefte_' || CAST(year(o_orderdate) AS VARCHAR) || '.json' AS dateiname,
         CAST(year(o_orderdate) AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR) AS grnr,
         'Geschäft ' || CAST(o_orderkey AS VARCHAR) AS titel,
         '[{"titel":"SCHLUSSabstimmung ' || CAST(o_orderkey AS VARCHAR) || '","file_id":"F'
           || CAST(o_orderkey AS VARCHAR) || '"}]' AS pdf_files,
         CASE o_orderkey % 5 WHEN 0 THEN 'Motion, Postulat ' || o_orderstatus
                             WHEN 1 THEN 'Weisung' WHEN 2 THEN NULL
                             ELSE 'Interpellation, ' || o_orderpriority END AS geschaeftsart,
         CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders WHERE o_orderkey % 50 <> 0 AND o_orderkey % 51 <> 0)"""


def _label(n: str) -> str:
    return (f"CASE {n} WHEN 0 THEN NULL WHEN 1 THEN '{SCORE_LABELS[0][0]}' "
            f"WHEN 6 THEN '{SCORE_LABELS[-1][0]}' WHEN 7 THEN 'weiss nicht' "
            f"ELSE 'Note ' || CAST({n} AS VARCHAR) END")


def _survey() -> str:
    cols = [
        "CAST(2019 + event_id % 5 AS VARCHAR) AS \"Jahr\"",
        "event_type AS methode",
        "printf('%.2f', value) AS sgewicht",
        "CASE WHEN event_id % 3 <> 0 THEN printf('%.2f', value + 1) END AS pgewicht",
        "CAST(user_id AS VARCHAR) AS \"schichtId\"",
        "'Kreis ' || CAST(user_id % 12 + 1 AS VARCHAR) AS \"A1BVSKreis01\"",
        "CAST(user_id % 34 AS VARCHAR) AS \"A1BVSQuar03\"",
        "CASE WHEN user_id % 2 = 0 THEN 'weiblich' ELSE 'männlich' END AS \"A1BVSSex01\"",
        "CAST(user_id % 60 + 18 AS VARCHAR) AS \"A1BVSAlterV03\"",
    ]
    cols += [f"{_label(f'((event_id + {j}) % 8)')} AS {q(c)}"
             for j, c in enumerate(survey_answer_columns())]
    return "survey AS (SELECT " + ",\n  ".join(cols) + " FROM events)"


def _score(col: str, typ: str | None = None) -> str:
    whens = " ".join(f"WHEN '{lbl}' THEN {v}" for lbl, v in SCORE_LABELS)
    e = f"CASE {q(col)} {whens} ELSE NULL END"
    return f"CAST({e} AS {typ})" if typ else e


SCORED_COLS = (f"{_score('A2001aa01')} AS score_beliebtheit_zh, "
               f"{_score('A2001aa01', 'DOUBLE')} AS float_beliebtheit_zh, "
               f"{_score('A2002aa01', 'DOUBLE')} AS float_quality_of_life")

SATISFACTION = f"""{_survey()},
scored AS (SELECT *, {SCORED_COLS} FROM survey),
sat AS (SELECT TRY_CAST("Jahr" AS INTEGER) AS year, AVG(float_quality_of_life) AS avg_quality_of_life,
               AVG(float_beliebtheit_zh) AS avg_beliebtheit_zh FROM scored GROUP BY 1)"""

CHANGE = f"""{SPENDING},
yearly AS (SELECT CAST(jahr AS INTEGER) AS year, CAST(SUM(CAST(betrag AS {M})) AS DOUBLE) AS total
           FROM spending GROUP BY 1),
change AS (SELECT year, total - LAG(total) OVER (ORDER BY year NULLS FIRST) AS expenditure_change
           FROM yearly)"""

DECISIONS = f"""{VOTES},
decisions AS (SELECT CAST(year AS INTEGER) AS year, COUNT(*) AS number_of_decisions
              FROM votes GROUP BY 1)"""

IMPACT = f"CASE WHEN CAST(sachkonto AS VARCHAR) IN ({IMPACT_IN}) THEN 'Citizen Impact' ELSE 'Overhead' END"

# Final-vote documents of the XML hits, computed from the rendering rules.
FINAL_DOCS = """o AS (SELECT o_orderkey AS k, o_orderdate FROM orders WHERE o_orderkey % 50 <> 0),
ta AS (SELECT k, o_orderdate, unnest(range(1, CAST(k % 3 + 2 AS BIGINT))) AS a FROM o),
td AS (SELECT k, o_orderdate, a, unnest(range(1, CAST((k + a) % 3 + 2 AS BIGINT))) AS d FROM ta),
finals AS (
  SELECT k, a, d, CAST(year(o_orderdate) AS VARCHAR) || '/' || CAST(k AS VARCHAR) AS grnr,
         CASE WHEN k % 9 <> 0 THEN 'Geschäft ' || CAST(k AS VARCHAR) ELSE 'No Title' END AS titel,
         CAST(year(o_orderdate) AS INTEGER) AS year_source,
         'SCHLUSSabstimmung ' || CAST(a AS VARCHAR) || '.' || CAST(d AS VARCHAR) AS doc_titel,
         CAST(k AS VARCHAR) || '-' || CAST(a AS VARCHAR) || '-' || CAST(d AS VARCHAR) AS file_id,
         ROW_NUMBER() OVER (PARTITION BY k ORDER BY a, d) AS ordinal
  FROM td
  WHERE (k + a + d) % 2 = 0 AND (k + a * d) % 4 <> 0 AND (k + d) % 11 <> 0)"""

# All documents of the hits, numbered before any is left out.
ALL_DOCS = """o AS (SELECT o_orderkey AS k, o_orderdate FROM orders WHERE o_orderkey % 50 <> 0),
ta AS (SELECT k, o_orderdate, unnest(range(1, CAST(k % 3 + 2 AS BIGINT))) AS a FROM o),
td AS (SELECT k, o_orderdate, a, unnest(range(1, CAST((k + a) % 3 + 2 AS BIGINT))) AS d FROM ta),
documents_of_hits AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) || '/' || CAST(k AS VARCHAR) AS grnr,
         CASE WHEN (k + a + d) % 2 = 0 THEN 'SCHLUSSabstimmung ' ELSE 'Antrag ' END
           || CAST(a AS VARCHAR) || '.' || CAST(d AS VARCHAR) AS doc_titel,
         CASE WHEN (k + a * d) % 4 <> 0 AND (k + d) % 11 <> 0
              THEN CAST(k AS VARCHAR) || '-' || CAST(a AS VARCHAR) || '-' || CAST(d AS VARCHAR) END AS file_id,
         ROW_NUMBER() OVER (PARTITION BY k ORDER BY a, d) AS ordinal
  FROM td)"""


# ----------------------------------------------------------------- quality

def _metric_sql(rule) -> str:
    if isinstance(rule, quality.RowCount):
        return "CAST(COUNT(*) AS DOUBLE)"
    if isinstance(rule, quality.ColumnCount):
        return None  # filled from the column list
    c = q(rule.column)
    if isinstance(rule, quality.Completeness):
        return f"CAST(COUNT({c}) AS DOUBLE) / NULLIF(COUNT(*), 0)"
    if isinstance(rule, quality.DistinctCount):
        return f"CAST(COUNT(DISTINCT {c}) AS DOUBLE)"
    if isinstance(rule, quality.MinValue):
        return f"CAST(MIN({c}) AS DOUBLE)"
    if isinstance(rule, quality.MaxValue):
        return f"CAST(MAX({c}) AS DOUBLE)"
    raise TypeError(rule)


def _passed_sql(rule, m: str) -> str:
    if isinstance(rule, (quality.RowCount, quality.ColumnCount, quality.DistinctCount)):
        return f"{m} > {rule.threshold!r}"
    if isinstance(rule, quality.Completeness):
        return f"{m} >= {rule.threshold!r}"
    if isinstance(rule, quality.MinValue):
        return f"({m} IS NULL OR {m} >= {rule.threshold!r})"
    if isinstance(rule, quality.MaxValue):
        return f"({m} IS NULL OR {m} <= {rule.threshold!r})"
    raise TypeError(rule)


def dq_sql(ctes: str, table: str, n_columns: int, rules) -> str:
    rules = quality._flat(rules)
    metrics = []
    for i, r in enumerate(rules):
        m = _metric_sql(r)
        metrics.append(f"{m if m else f'CAST({n_columns} AS DOUBLE)'} AS m{i}")
    rows = []
    for i, r in enumerate(rules):
        col = "NULL" if getattr(r, "column", None) is None else "'" + r.column + "'"
        rule_text = r.describe().replace("'", "''")
        rows.append(
            f"SELECT {i + 1} AS rule_no, '{rule_text}' AS rule, CAST({col} AS VARCHAR) AS \"column\", "
            f"m{i} AS metric, CAST({r.threshold!r} AS DOUBLE) AS threshold, "
            f"CASE WHEN COALESCE({_passed_sql(r, f'm{i}')}, false) THEN 'Passed' ELSE 'Failed' END AS outcome "
            f"FROM metrics")
    return (f"WITH {ctes},\nmetrics AS (SELECT {', '.join(metrics)} FROM {table})\n"
            + "\nUNION ALL\n".join(rows))


def _dq_all() -> dict[str, str]:
    sets = {
        "votes": (VOTES, "votes", 12),
        "businesses": (BUSINESSES, "businesses", 6),
        "institutions": (INSTITUTIONS, "institutions", 6),
        "accounts": (ACCOUNTS, "accounts", 9),
        "spending": (CLEAN_SPENDING, "clean_spending", 5),
        "survey": (_survey(), "survey", len(survey_columns())),
    }
    return {f"dq_{k}": dq_sql(ctes, table, n, CLEAN_JOBS[k][1]) for k, (ctes, table, n) in sets.items()}


# ----------------------------------------------------------------- queries

_DOCUMENT_LINES = """pages AS (
  SELECT doc_id, lang AS year, generate_subscripts(string_split(text, chr(12)), 1) AS page,
         unnest(string_split(text, chr(12))) AS page_text
  FROM documents),
raw_lines AS (
  SELECT doc_id, year, page, generate_subscripts(string_split(page_text, chr(10)), 1) AS i,
         unnest(string_split(page_text, chr(10))) AS raw
  FROM pages)"""

# The lines of the questionnaires in the source's own form, ten a page.
_NUMBERED_LINES = """plain AS (
  SELECT doc_id, lang AS year, unnest(string_split(replace(text, chr(12), ' '), chr(10))) AS x,
         generate_subscripts(string_split(replace(text, chr(12), ' '), chr(10)), 1) AS i
  FROM documents),
raw_lines AS (
  SELECT doc_id, year, (i - 1) // 10 + 1 AS page, i,
         CASE i % 3 WHEN 1 THEN 'F' || CAST(i AS VARCHAR) || 'a. ' || x
                    WHEN 0 THEN 'S' || CAST(i AS VARCHAR) || '. ' || x
                    ELSE CASE WHEN i % 2 = 0 THEN '☐ ' || x ELSE x END END AS raw
  FROM plain)"""


def _questions_sql(lines: str = _DOCUMENT_LINES, pat: str = r"^([AE][a-z]*) +(.*)") -> str:
    # Pages split on form feed, lines on newline, stripped; a match of the
    # pattern is a question, the next line is appended when it is
    # non-empty, no question itself and does not start with the stop prefix.
    return f"""WITH {lines},
lines AS (SELECT doc_id, year, page, i, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS line FROM raw_lines),
la AS (SELECT *, LEAD(line) OVER (PARTITION BY doc_id, page ORDER BY i) AS nxt FROM lines)
SELECT doc_id, year, CAST(page AS INTEGER) AS page,
       regexp_extract(line, '{pat}', 1) AS id,
       CASE WHEN nxt IS NOT NULL AND nxt <> '' AND NOT regexp_matches(nxt, '{pat}')
                 AND NOT starts_with(nxt, '☐')
            THEN regexp_extract(line, '{pat}', 2) || ' ' || nxt
            ELSE regexp_extract(line, '{pat}', 2) END AS text
FROM la WHERE regexp_matches(line, '{pat}')"""


def oracle_sql() -> dict[str, str]:
    s: dict[str, str] = {}
    s["rq1_expenditure_trends"] = f"""WITH {SPENDING}
SELECT CAST(jahr AS INTEGER) AS year, 'Accounts' AS type,
  CAST(COALESCE(SUM(CASE WHEN betragstyp = 'RECHNUNG' THEN CAST(betrag AS {M}) END), 0) AS DOUBLE) AS expenditure_mchf
FROM spending GROUP BY 1
UNION ALL
SELECT CAST(jahr AS INTEGER), 'Budget',
  CAST(COALESCE(SUM(CASE WHEN betragstyp = 'GEMEINDERAT_BESCHLUSS' THEN CAST(betrag AS {M}) END), 0) AS DOUBLE)
FROM spending GROUP BY 1
UNION ALL
SELECT CAST(jahr AS INTEGER), 'Supplementary Credits',
  CAST(COALESCE(SUM(CASE WHEN betragstyp = 'STADTRAT_ANTRAG' THEN CAST(betrag AS {M}) END), 0) AS DOUBLE)
FROM spending GROUP BY 1"""
    s["rq2_spending_change_yoy"] = f"WITH {CHANGE} SELECT year, expenditure_change FROM change"
    s["rq2_decisions_per_year"] = f"WITH {DECISIONS} SELECT year, number_of_decisions FROM decisions"
    s["rq2_spending_vs_decisions"] = f"""WITH {CHANGE}, {DECISIONS}
SELECT c.year, c.expenditure_change, d.number_of_decisions
FROM change c LEFT JOIN decisions d ON d.year = c.year"""
    dept = f"""WITH {SPENDING}, {INSTITUTIONS},
e AS (SELECT s.*, {IMPACT} AS impact_category, i."departement.bezeichnung" AS department
      FROM spending s LEFT JOIN institutions i ON s.institution = i.key)"""
    s["rq3_impact_by_department"] = f"""{dept}
SELECT department, impact_category, CAST(SUM(CAST(betrag AS {M})) AS DOUBLE) AS spend_chf
FROM e GROUP BY 1, 2"""
    s["rq3_citizen_impact_share"] = f"""{dept}
SELECT department,
  CAST(SUM(CASE WHEN impact_category = 'Citizen Impact' THEN CAST(betrag AS {M}) ELSE 0 END) AS DOUBLE) * 1.0
    / NULLIF(CAST(SUM(CAST(betrag AS {M})) AS DOUBLE), 0) AS citizen_impact_share
FROM e GROUP BY 1"""
    s["survey_scored"] = f"WITH {_survey()} SELECT *, {SCORED_COLS} FROM survey"
    s["rq4_satisfaction_by_year"] = f"WITH {SATISFACTION} SELECT * FROM sat"
    s["x1_satisfaction_link"] = f"""WITH {CHANGE}, {SATISFACTION}
SELECT c.year, c.expenditure_change,
  a.avg_quality_of_life AS quality_same_year, b.avg_quality_of_life AS quality_next_year,
  a.avg_beliebtheit_zh AS beliebtheit_same_year, b.avg_beliebtheit_zh AS beliebtheit_next_year
FROM change c
LEFT JOIN sat a ON a.year + ({SURVEY_YEAR_OFFSET}) = c.year
LEFT JOIN sat b ON b.year + ({SURVEY_YEAR_OFFSET}) - 1 = c.year"""
    s["spending_enriched"] = f"""WITH {SPENDING}
SELECT *, {IMPACT} AS impact_category,
  CASE WHEN betragstyp = 'RECHNUNG' THEN betrag END AS accounts_amount,
  CASE WHEN betragstyp = 'GEMEINDERAT_BESCHLUSS' THEN betrag END AS budget_amount,
  CASE WHEN betragstyp = 'STADTRAT_ANTRAG' THEN betrag END AS supplementary_credits_amount
FROM spending"""
    s["clean_votes"] = f"WITH {VOTES} SELECT * FROM votes"
    s["clean_businesses"] = f"WITH {BUSINESSES} SELECT * FROM businesses"
    s["businesses_from_pages"] = s["clean_businesses"]
    s["clean_institutions"] = f"WITH {INSTITUTIONS} SELECT * FROM institutions"
    s["clean_accounts"] = f"WITH {ACCOUNTS} SELECT * FROM accounts"
    s["clean_spending"] = f"WITH {CLEAN_SPENDING} SELECT * FROM clean_spending"
    s["clean_survey"] = f"WITH {_survey()} SELECT * FROM survey"
    s.update(_dq_all())
    s["extract_protocols"] = f"""WITH {PROTOCOLS}
SELECT "Dateiname", "Geschäftstitel", "Geschäftsnummer", "Stimm_Datum", "Stimm_Zeit", "JA", "NEIN",
       "Enthalten", "Nicht_Praesent", "Total_Stimmen", "Stichentscheid" FROM protocols"""
    s["extract_questions"] = _questions_sql()
    s["extract_questions_sf"] = _questions_sql(_NUMBERED_LINES, r"^(S\d+[a-z]?|F\d+[a-z]?)\.\s+(.*)")
    s["questions_per_year"] = (f"WITH qs AS ({_questions_sql()}) "
                               "SELECT year, COUNT(*) AS n_questions FROM qs GROUP BY 1")
    s["run_counters"] = f"""WITH {PROTOCOLS},
st AS (SELECT "Geschäftsnummer" IS NOT NULL AS num,
              ("Stimm_Datum" IS NOT NULL AND "Stimm_Zeit" IS NOT NULL AND "JA" IS NOT NULL) AS complete
       FROM protocols)
SELECT COUNT(*) AS processed, COUNT(*) FILTER (WHERE num AND complete) AS parsed,
       COUNT(*) FILTER (WHERE num AND NOT complete) AS partial, COUNT(*) FILTER (WHERE NOT num) AS errors
FROM st"""
    s["final_vote_documents"] = f"WITH {FINAL_DOCS} SELECT grnr, titel, doc_titel, file_id FROM finals"
    s["document_ordinals"] = f"""WITH {FINAL_DOCS}
SELECT grnr, CAST(ordinal AS INTEGER) AS ordinal, doc_titel, file_id,
       replace(grnr, '/', '-') || '_abstimmung_' || CAST(ordinal AS VARCHAR) || '.pdf' AS pdf_filename
FROM finals"""
    s["worklist_json"] = f"""WITH {FINAL_DOCS}
SELECT grnr, titel, year_source, CAST(COUNT(*) AS INTEGER) AS n_files,
       arg_min(file_id, ordinal) AS first_file_id
FROM finals GROUP BY grnr, titel, year_source"""
    s["props_from_json"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"
    s["doc_manifest"] = f"""SELECT page_id, url,
  regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1) AS dateiname
FROM pages WHERE lower(regexp_replace(url, '[?#].*$', '')) LIKE '%{MANIFEST_SUFFIX.lower()}'"""
    types = ", ".join(f"('{t}')" for t in ("GEMEINDERAT_BESCHLUSS", "RECHNUNG", "STADTRAT_ANTRAG"))
    s["work_grid"] = f"""SELECT CAST(s_suppkey AS VARCHAR) AS institution, CAST(y.jahr AS INTEGER) AS jahr, t.betragstyp
FROM supplier, (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1)) AS jahr FROM orders) y,
     (VALUES {types}) t(betragstyp)"""
    ev = ", ".join(f"('{t}')" for t in WINDOW_TYPES)
    grids = {
        "coverage_gaps": """days AS (SELECT CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day FROM events),
types AS (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL),""",
        "coverage_gaps_window": f"""days AS (SELECT CAST(unnest(generate_series(DATE '{WINDOW_DAYS[0]}', DATE '{WINDOW_DAYS[1]}', INTERVAL 1 DAY)) AS DATE) AS day),
types AS (SELECT * FROM (VALUES {ev}) t(event_type)),"""}
    for name, lists in grids.items():
        s[name] = f"""WITH users AS (SELECT DISTINCT user_id FROM events),
{lists}
grid AS (SELECT user_id, day, event_type FROM users, days, types)
SELECT g.user_id, g.event_type, g.day FROM grid g
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = g.user_id AND e.event_type = g.event_type
                  AND CAST(e.ts AS DATE) = g.day)"""
    s["hits_rejects"] = "SELECT o_orderkey, true AS has_raw FROM orders WHERE o_orderkey % 50 = 0"
    s["pending_work"] = """SELECT o_orderkey, o_custkey, o_orderdate FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)"""
    s["daily_window"] = """SELECT event_id, ts, user_id, event_type FROM events
WHERE ts > TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-10 23:59:59'"""
    s["sink_roundtrip_parquet"] = s["clean_spending"]
    s["sink_roundtrip_csv"] = "SELECT doc_id, lang, text FROM documents"
    s["sink_roundtrip_json"] = "SELECT doc_id, lang, text FROM documents"
    s["sink_roundtrip_partitioned"] = f"""WITH {SPENDING}
SELECT institution, jahr, betragstyp, CAST(SUM(CAST(betrag AS {M})) AS DOUBLE) AS betrag,
       COUNT(*) AS n_rows
FROM spending GROUP BY 1, 2, 3"""
    s["incremental_clean"] = s["clean_survey"]
    s["incremental_landings"] = s["clean_survey"]
    s["document_ordinals_all"] = f"""WITH {ALL_DOCS}
SELECT grnr, CAST(ordinal AS INTEGER) AS ordinal, doc_titel, file_id,
       replace(grnr, '/', '-') || '_abstimmung_' || CAST(ordinal AS VARCHAR) || '.pdf' AS pdf_filename
FROM documents_of_hits WHERE file_id IS NOT NULL"""
    s["business_xml_files"] = s["final_vote_documents"]
    s["envelope_records"] = """SELECT o_orderkey * 10 + i AS nr, o_orderpriority AS titel
FROM (SELECT o_orderkey, o_orderpriority, unnest(range(0, o_orderkey % 3 + 1)) AS i FROM orders)
WHERE o_orderkey % 50 <> 0"""
    s["envelope_rejects"] = "SELECT o_orderkey * 10 AS first_nr FROM orders WHERE o_orderkey % 50 = 0"
    s["clean_table_catalog"] = s["clean_institutions"]
    s["append_pending_rerun"] = "SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM orders"
    s["questions_master_csv"] = s["extract_questions"]
    s["trends_for_reader"] = f"""SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY year ASC NULLS LAST, type) AS INTEGER) AS row_no
FROM ({s["rq1_expenditure_trends"]})"""
    rules = quality._flat(CLEAN_JOBS["spending"][1])
    parts = {"run 1": f"jahr < {LANDING_YEAR}", "run 2": f"jahr >= {LANDING_YEAR}", "run 3": f"jahr < {LANDING_YEAR}"}
    runs = " UNION ALL ".join(
        f"""SELECT '{run}' AS what, rule, metric, outcome FROM (
{dq_sql(CLEAN_SPENDING + f", part AS (SELECT * FROM clean_spending WHERE {which})", "part", 5, rules)})"""
        for run, which in parts.items())
    s["clean_job_reruns"] = f"""{runs}
UNION ALL SELECT 'rows of a year', CAST(year(l_shipdate) AS VARCHAR), CAST(COUNT(*) AS DOUBLE), NULL FROM lineitem GROUP BY year(l_shipdate)
UNION ALL SELECT 'results of a run', unnest(['early', 'late']), {len(rules)}.0, NULL"""
    s["clean_checked"] = f"""SELECT a.*, n_failed FROM ({s["clean_accounts"]}) a,
(SELECT COUNT(*) AS n_failed FROM ({s["dq_accounts"]}) WHERE outcome = 'Failed')"""
    s["document_files"] = "SELECT DISTINCT lang, source FROM documents"
    s["envelope_landing"] = f"""SELECT 'good' AS status, nr, titel FROM ({s["envelope_records"]})
UNION ALL SELECT 'rejected', first_nr, NULL FROM ({s["envelope_rejects"]})"""
    s["landing_counters"] = """SELECT COUNT(*) AS n_read, COUNT(*) FILTER (WHERE o_orderkey % 50 <> 0) AS n_good,
       COUNT(*) FILTER (WHERE o_orderkey % 50 = 0) AS n_rejected FROM orders"""
    s["hits_landing"] = f"""SELECT 'good' AS status, grnr, file_id FROM ({s["final_vote_documents"]})
UNION ALL SELECT 'rejected', CAST(o_orderkey AS VARCHAR), NULL FROM orders WHERE o_orderkey % 50 = 0"""
    s["distinct_sketches"] = """SELECT 'event_id' AS "column", COUNT(*) AS n_rows, COUNT(DISTINCT event_id) AS n_exact, true AS within FROM events
UNION ALL SELECT 'user_id', COUNT(*), COUNT(DISTINCT user_id), true FROM events"""
    s["catalog_view_trends"] = s["rq1_expenditure_trends"]
    s["catalog_view_decisions"] = s["rq2_spending_vs_decisions"]
    s["catalog_view_share"] = s["rq3_citizen_impact_share"]
    s["catalog_view_satisfaction"] = s["rq4_satisfaction_by_year"]
    s["incremental_dedup"] = "SELECT event_id, ts, user_id, event_type, value FROM events"
    s["spending_tree_json"] = f"""WITH {SPENDING}
SELECT '0' || right(institution, 1) AS gruppe, lpad(institution, 6, '0') AS institution, jahr, betragstyp, sachkonto,
       CAST(SUM(CAST(betrag AS {M})) AS DOUBLE) AS betrag FROM spending GROUP BY 1, 2, 3, 4, 5"""
    bridge = """SELECT CAST(year(o_orderdate) AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR) AS grnr, role,
       'Departement ' || CAST(n % 9 AS VARCHAR) AS department
FROM (SELECT *, 'leading' AS role, o_orderkey AS n FROM orders WHERE o_orderkey % 4 <> 0
      UNION ALL SELECT *, 'involved', o_orderkey + unnest(range(1, o_orderkey % 3 + 1)) FROM orders)
WHERE o_orderkey % 50 <> 0"""
    s["department_bridge"] = bridge
    s["search_pages"] = """SELECT *, (position - 1) // 100 + 1 AS page FROM (
SELECT o_orderkey, o_orderdate AS beginn_start, CAST(year(o_orderdate) AS INTEGER) AS year_source,
       ROW_NUMBER() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS position
FROM orders WHERE o_orderdate > make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0)
  AND o_orderdate < make_timestamp(year(o_orderdate), 12, 31, 23, 59, 59))"""
    s["survey_code_list"] = """SELECT event_type AS code, 'Antwort "' || event_type || '", alle' AS bezeichnung,
       COUNT(*) AS n_answers FROM events GROUP BY event_type"""
    s["department_bridge_pages"] = bridge + " AND o_orderkey % 51 <> 0"
    return s
