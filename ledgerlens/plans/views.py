"""The analytical views (RQ1-RQ4) as DataFrame functions.

Plan shape, chosen for a fact table of many billions of rows:

* Every view aggregates the fact table first (hash aggregate with map-side
  partial aggregation), so what crosses the network is one row per group per
  task, never the facts themselves.  A key holding a third of all rows costs
  nothing extra: its rows are combined before the shuffle.
* The department views aggregate spending by institution *before* joining
  the institution dimension, so the join sees (#institutions x 2) rows
  instead of the facts; the planner broadcasts the dimension only when its
  size statistics are under the broadcast threshold, and AQE re-plans at run
  time from the real sizes otherwise.
* The three measure branches of RQ1 are one aggregation plus an unpivot: one
  scan and one exchange instead of three.
* Window functions without a partition (LAG over years) run only on the
  per-year aggregate (tens of rows).
* Money is summed exactly (``DECIMAL(38,10)`` per row, exact sum: parts of a
  cent count, and amounts up to 1e27) and reported
  as DOUBLE, so results do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scoring import float_score, impact_category, score
from ..operators.mapping import quote
from ..schemas import CITIZEN_IMPACT, SCORE_COLUMNS, TREND_TYPES

MONEY = "decimal(38,10)"


def money(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


def money_sum(c: str | Column) -> Column:
    """Exact sum of an amount column, returned as DOUBLE."""
    return F.sum(money(c)).cast("double")


def _int_year(c: str) -> Column:
    return F.col(c).try_cast("int")


# --------------------------------------------------------------------- V1

def enrich_spending(spending: DataFrame) -> DataFrame:
    """Spending rows + impact category + one measure column per amount type."""
    t = F.col("betragstyp")
    return spending.select(
        "*",
        impact_category("sachkonto").alias("impact_category"),
        F.when(t == "RECHNUNG", F.col("betrag")).alias("accounts_amount"),
        F.when(t == "GEMEINDERAT_BESCHLUSS", F.col("betrag")).alias("budget_amount"),
        F.when(t == "STADTRAT_ANTRAG", F.col("betrag")).alias("supplementary_credits_amount"),
    )


# --------------------------------------------------------------------- V2

def expenditure_trends(spending: DataFrame, min_year: int | None = None) -> DataFrame:
    """RQ1: ``(year, type, expenditure_mchf)``; a year without an amount type
    reports 0 for it.  Values are not scaled (the name is historical)."""
    df = spending
    if min_year is not None:
        df = df.filter(F.col("jahr") >= min_year)
    t = F.col("betragstyp")
    measures = [
        F.coalesce(F.sum(F.when(t == code, money("betrag"))), F.lit(0).cast(MONEY))
         .cast("double").alias(label)
        for label, code in TREND_TYPES
    ]
    per_year = df.groupBy(_int_year("jahr").alias("year")).agg(*measures)
    return per_year.unpivot("year", [label for label, _ in TREND_TYPES],
                            "type", "expenditure_mchf")


# --------------------------------------------------------------------- V3

def yearly_totals(spending: DataFrame, amount_type: str | None = None) -> DataFrame:
    df = spending if amount_type is None else spending.filter(F.col("betragstyp") == amount_type)
    return df.groupBy(_int_year("jahr").alias("year")).agg(money_sum("betrag").alias("total_expenditure"))


def spending_change(spending: DataFrame, amount_type: str | None = None) -> DataFrame:
    """RQ2.1: ``(year, expenditure_change)`` = total minus the previous
    *present* year's total; null for the first year."""
    yearly = yearly_totals(spending, amount_type)
    w = Window.orderBy(F.col("year").asc_nulls_first())
    return yearly.select("year", (F.col("total_expenditure") - F.lag("total_expenditure").over(w))
                         .alias("expenditure_change"))


# --------------------------------------------------------------------- V4

def decisions_per_year(votes: DataFrame) -> DataFrame:
    """RQ2.2: ``(year, number_of_decisions)``; a null year is its own group."""
    return votes.groupBy(_int_year("year").alias("year")).agg(
        F.count(F.lit(1)).alias("number_of_decisions"))


# --------------------------------------------------------------------- V5

def spending_vs_decisions(change: DataFrame, decisions: DataFrame) -> DataFrame:
    """RQ2: spending delta next to the number of decisions of the same year."""
    return change.join(decisions, "year", "left").select(
        "year", "expenditure_change", "number_of_decisions")


# ------------------------------------------------------------------ V6/V7

def _department_dim(institutions: DataFrame) -> DataFrame:
    # one row a key: a repeated key must not multiply the money
    return institutions.groupBy(F.col("key").alias("_inst_key")).agg(
        F.min(F.col(quote("departement.bezeichnung"))).alias("department"))


def repeated_institutions(institutions: DataFrame) -> DataFrame:
    """``(key, n)`` of institution keys that stand in more than one row; the
    views take the department that sorts first."""
    return institutions.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def _by_institution(enriched: DataFrame) -> DataFrame:
    # Pre-aggregate the facts to (institution, category) before the join.
    return enriched.groupBy("institution", "impact_category").agg(
        F.sum(money("betrag")).alias("_amount"))


def with_department(per_inst: DataFrame, institutions: DataFrame) -> DataFrame:
    dim = _department_dim(institutions)
    return per_inst.join(dim, per_inst["institution"] == dim["_inst_key"], "left")


def impact_by_department(enriched: DataFrame, institutions: DataFrame) -> DataFrame:
    """RQ3: ``(department, impact_category, spend_chf)``."""
    j = with_department(_by_institution(enriched), institutions)
    return j.groupBy("department", "impact_category").agg(
        F.sum("_amount").cast("double").alias("spend_chf"))


def citizen_impact_share(enriched: DataFrame, institutions: DataFrame) -> DataFrame:
    """RQ3: ``(department, citizen_impact_share)``; null when the total is 0."""
    j = with_department(_by_institution(enriched), institutions)
    citizen = F.sum(F.when(F.col("impact_category") == CITIZEN_IMPACT, F.col("_amount"))
                    .otherwise(F.lit(0).cast(MONEY))).cast("double")
    total = F.sum("_amount").cast("double")
    return j.groupBy("department").agg(
        (citizen * F.lit(1.0) / F.nullif(total, F.lit(0.0))).alias("citizen_impact_share"))


# ------------------------------------------------------------------ V8/V9

def score_survey(survey: DataFrame, columns=SCORE_COLUMNS) -> DataFrame:
    """Survey rows + numeric scores for the given answer columns.

    ``columns`` is a list of ``(answer column, int score name or None,
    double score name or None)``; the same label mapping serves every column.
    """
    extra = []
    for src, int_name, dbl_name in columns:
        if int_name:
            extra.append(score(F.col(quote(src))).alias(int_name))
        if dbl_name:
            extra.append(float_score(F.col(quote(src))).alias(dbl_name))
    return survey.select("*", *extra)


def satisfaction_by_year(scored: DataFrame) -> DataFrame:
    """RQ4: ``(year, avg_quality_of_life, avg_beliebtheit_zh)``, nulls ignored."""
    return scored.groupBy(_int_year("Jahr").alias("year")).agg(
        F.avg("float_quality_of_life").alias("avg_quality_of_life"),
        F.avg("float_beliebtheit_zh").alias("avg_beliebtheit_zh"))


# --------------------------------------------------------------------- X1

def satisfaction_link(change: DataFrame, satisfaction: DataFrame, year_offset: int = 0) -> DataFrame:
    """Extension of RQ4: spending change next to satisfaction in the same and
    in the following year.  ``year_offset`` is added to the survey years
    before matching (for aligning differently dated sources).

    The satisfaction aggregate is computed once: each survey year is emitted
    twice, as (year, same) and (year - 1, next), folded back to one row per
    year, and joined to the spending change once.
    """
    y = F.col("year") + F.lit(year_offset)
    q, b = F.col("avg_quality_of_life"), F.col("avg_beliebtheit_zh")
    twice = satisfaction.select(F.explode(F.array(
        F.struct(y.alias("year"), F.lit(True).alias("same"), q.alias("q"), b.alias("b")),
        F.struct((y - 1).alias("year"), F.lit(False).alias("same"), q.alias("q"), b.alias("b")),
    )).alias("s")).select("s.*")
    same, nxt = F.col("same"), ~F.col("same")
    wide = twice.groupBy("year").agg(
        F.max(F.when(same, F.col("q"))).alias("quality_same_year"),
        F.max(F.when(nxt, F.col("q"))).alias("quality_next_year"),
        F.max(F.when(same, F.col("b"))).alias("beliebtheit_same_year"),
        F.max(F.when(nxt, F.col("b"))).alias("beliebtheit_next_year"))
    return (change.join(wide, "year", "left")
            .select("year", "expenditure_change", "quality_same_year", "quality_next_year",
                    "beliebtheit_same_year", "beliebtheit_next_year"))


# --------------------------------------------------------------------- O1

def for_reader(df: DataFrame, *cols: str) -> DataFrame:
    """Sort at the reader-facing edge only (never inside a view): ascending,
    nulls last.  On a large result this is a range-partitioned sort."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in (cols or ("year",))])


# --------------------------------------------------------------------- K8

def register_views(spark: SparkSession, *, spending: DataFrame | None = None,
                   votes: DataFrame | None = None, institutions: DataFrame | None = None,
                   survey: DataFrame | None = None, prefix: str = "v_") -> list[str]:
    """Publish the views as temporary views; returns the registered names."""
    names = []

    def reg(name, df):
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)

    if spending is not None:
        enriched = enrich_spending(spending)
        reg("sachkonto2stellig_enriched", enriched)
        reg("rq1_expenditure_trends", expenditure_trends(spending))
        change = spending_change(spending)
        reg("rq2_spending_change_yoy", change)
        if votes is not None:
            reg("rq2_spending_vs_decisions", spending_vs_decisions(change, decisions_per_year(votes)))
        if institutions is not None:
            reg("rq3_impact_by_department", impact_by_department(enriched, institutions))
            reg("rq3_citizen_impact_share_by_department", citizen_impact_share(enriched, institutions))
    if votes is not None:
        reg("rq2_decisions_per_year", decisions_per_year(votes))
    if survey is not None:
        scored = score_survey(survey)
        reg("survey_scored", scored)
        reg("rq4_satisfaction_by_year", satisfaction_by_year(scored))
    return names
