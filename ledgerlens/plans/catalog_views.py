"""The views as persistent views of the catalogue, over saved clean tables.

The definitions are the same plans as in :mod:`.views` (facts are aggregated
before the dimension is joined, one aggregation for the three amount types), as
SQL text, because only text can be stored.  A view may read another one; they
outlive the session that made them, and any session of the catalogue reads them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..schemas import CITIZEN_IMPACT, CITIZEN_IMPACT_ACCOUNTS, OVERHEAD, SCORE_COLUMNS, SCORE_LABELS, TREND_TYPES
from .views import MONEY


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(s: str) -> str:
    return "`" + s.replace("`", "``") + "`"


def _score(column: str, kind: str) -> str:
    whens = " ".join(f"WHEN {_text(label)} THEN {value}" for label, value in SCORE_LABELS)
    return f"CAST(CASE {_name(column)} {whens} END AS {kind})"


def _sum(condition: str | None = None) -> str:
    amount = f"CAST(betrag AS {MONEY})"
    return f"SUM({amount})" if condition is None else f"SUM(CASE WHEN {condition} THEN {amount} END)"


def definitions(spending: str | None = None, votes: str | None = None, institutions: str | None = None,
                survey: str | None = None, prefix: str = "v_") -> dict[str, str]:
    """View name (without prefix) -> its query, for the tables that are given,
    each after those it reads."""
    def v(name):
        return _name(prefix + name)

    out = {}
    if spending:
        accounts = ", ".join(_text(a) for a in CITIZEN_IMPACT_ACCOUNTS)
        out["sachkonto2stellig_enriched"] = f"""
SELECT *, CASE WHEN CAST(sachkonto AS STRING) IN ({accounts}) THEN {_text(CITIZEN_IMPACT)} ELSE {_text(OVERHEAD)} END AS impact_category,
       CASE WHEN betragstyp = 'RECHNUNG' THEN betrag END AS accounts_amount,
       CASE WHEN betragstyp = 'GEMEINDERAT_BESCHLUSS' THEN betrag END AS budget_amount,
       CASE WHEN betragstyp = 'STADTRAT_ANTRAG' THEN betrag END AS supplementary_credits_amount
FROM {spending}"""
        sums = ", ".join(f"CAST(COALESCE({_sum(f'betragstyp = {_text(code)}')}, 0) AS DOUBLE) AS m{i}"
                         for i, (_, code) in enumerate(TREND_TYPES))
        pairs = ", ".join(f"{_text(label)}, m{i}" for i, (label, _) in enumerate(TREND_TYPES))
        out["rq1_expenditure_trends"] = f"""
SELECT year, stack({len(TREND_TYPES)}, {pairs}) AS (type, expenditure_mchf)
FROM (SELECT try_cast(jahr AS INT) AS year, {sums} FROM {spending} GROUP BY try_cast(jahr AS INT))"""
        out["rq2_spending_change_yoy"] = f"""
SELECT year, total - LAG(total) OVER (ORDER BY year ASC NULLS FIRST) AS expenditure_change
FROM (SELECT try_cast(jahr AS INT) AS year, CAST({_sum()} AS DOUBLE) AS total FROM {spending} GROUP BY try_cast(jahr AS INT))"""
    if votes:
        out["rq2_decisions_per_year"] = f"""
SELECT try_cast(year AS INT) AS year, COUNT(1) AS number_of_decisions FROM {votes} GROUP BY try_cast(year AS INT)"""
    if spending and votes:
        out["rq2_spending_vs_decisions"] = f"""
SELECT c.year, c.expenditure_change, d.number_of_decisions
FROM {v("rq2_spending_change_yoy")} c LEFT JOIN {v("rq2_decisions_per_year")} d ON c.year = d.year"""
    if spending and institutions:
        by_department = f"""
FROM (SELECT institution, impact_category, {_sum()} AS amount FROM {v("sachkonto2stellig_enriched")} GROUP BY institution, impact_category) s
LEFT JOIN (SELECT key, MIN(`departement.bezeichnung`) AS department FROM {institutions} GROUP BY key) i ON s.institution = i.key"""
        out["rq3_impact_by_department"] = f"""
SELECT department, impact_category, CAST(SUM(amount) AS DOUBLE) AS spend_chf {by_department}
GROUP BY department, impact_category"""
        out["rq3_citizen_impact_share_by_department"] = f"""
SELECT department, CAST(SUM(CASE WHEN impact_category = {_text(CITIZEN_IMPACT)} THEN amount ELSE 0 END) AS DOUBLE)
       / NULLIF(CAST(SUM(amount) AS DOUBLE), 0) AS citizen_impact_share {by_department}
GROUP BY department"""
    if survey:
        scores = [f"{_score(src, kind)} AS {_name(name)}" for src, whole, double in SCORE_COLUMNS
                  for name, kind in ((whole, "INT"), (double, "DOUBLE")) if name]
        out["survey_scored"] = f"\nSELECT *, {', '.join(scores)} FROM {survey}"
        out["rq4_satisfaction_by_year"] = f"""
SELECT try_cast(Jahr AS INT) AS year, AVG(float_quality_of_life) AS avg_quality_of_life,
       AVG(float_beliebtheit_zh) AS avg_beliebtheit_zh FROM {v("survey_scored")} GROUP BY try_cast(Jahr AS INT)"""
    return out


def publish_views(spark: SparkSession, *, spending: str | None = None, votes: str | None = None,
                  institutions: str | None = None, survey: str | None = None, prefix: str = "v_") -> dict[str, str]:
    """Create or replace the views over catalogue tables (given by name);
    returns view name -> name in the catalogue.  Publishing again replaces the
    definitions; a table that is written again is seen by the next reader."""
    names = {}
    for name, query in definitions(spending, votes, institutions, survey, prefix).items():
        spark.sql(f"CREATE OR REPLACE VIEW {_name(prefix + name)} AS {query}")
        names[name] = prefix + name
    return names
