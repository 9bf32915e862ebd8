"""The six clean jobs as DataFrame -> DataFrame functions.

Order inside each job follows the source pipeline: map -> derive year ->
non-empty filter -> (quality check on the filtered rows).  Every step is a
narrow projection or filter, so a clean job is one scan and one write with no
shuffle; the optional quality report adds one aggregate pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..functions.text import leading_year, list_to_text
from ..schemas import (
    ACCOUNT_MAPPING,
    BUSINESS_MAPPING,
    INSTITUTION_MAPPING,
    SPENDING_MAPPING,
    VOTE_MAPPING,
    survey_mapping,
)
from . import quality
from .mapping import apply_mapping, derive, flatten, keep_non_empty


def clean_votes(raw: DataFrame) -> DataFrame:
    """Vote protocol records -> ``vote`` table (year from the business number)."""
    df = apply_mapping(raw, VOTE_MAPPING)
    df = derive(df, "year", leading_year("geschaeftsnummer"))
    return keep_non_empty(df, "geschaeftsnummer")


def _as_text(df: DataFrame, name: str, render) -> DataFrame:
    """Replace an array column by ``render(column, type)``; other types stay."""
    actual = {c.lower(): c for c in df.columns}.get(name.lower())
    if actual is None or not isinstance(df.schema[actual].dataType, ArrayType):
        return df
    return df.withColumn(actual, render(F.col(actual), df.schema[actual].dataType))


def clean_businesses(raw: DataFrame) -> DataFrame:
    """Business items -> ``business`` table.

    ``geschaeftsart`` (a list of types) becomes ``"A, B"``; ``pdf_files`` (a list
    of ``{titel, file_id}``) becomes its JSON text.
    """
    df = _as_text(raw, "geschaeftsart",
                  lambda c, t: list_to_text(c) if not isinstance(t.elementType, StructType)
                  else F.to_json(c))
    df = _as_text(df, "pdf_files", lambda c, t: F.to_json(c))
    df = apply_mapping(df, BUSINESS_MAPPING)
    df = derive(df, "year", leading_year("grnr"))
    return keep_non_empty(df, "grnr")


def clean_institutions(raw: DataFrame) -> DataFrame:
    """Institution records (nested department) -> flat ``institution`` table."""
    return apply_mapping(flatten(raw), INSTITUTION_MAPPING)


def clean_accounts(raw: DataFrame) -> DataFrame:
    """Account records (institution -> department nested twice) -> ``account``.

    The department columns are re-rooted: ``institution.departement.key``
    becomes ``departement.key``.
    """
    return apply_mapping(flatten(raw), ACCOUNT_MAPPING)


def clean_spending(raw: DataFrame) -> DataFrame:
    """Spending records -> ``spending``; malformed amounts become null."""
    return apply_mapping(raw, SPENDING_MAPPING)


def clean_survey(raw: DataFrame) -> DataFrame:
    """Survey answers -> the 402 mapped string columns, in one projection."""
    return apply_mapping(raw, survey_mapping())


CLEAN_JOBS = {
    "votes": (clean_votes, quality.VOTE_RULES),
    "businesses": (clean_businesses, quality.BUSINESS_RULES),
    "institutions": (clean_institutions, quality.INSTITUTION_RULES),
    "accounts": (clean_accounts, quality.ACCOUNT_RULES),
    "spending": (clean_spending, quality.SPENDING_RULES),
    "survey": (clean_survey, quality.SURVEY_RULES),
}


def clean_and_check(name: str, raw: DataFrame, *, on_fail: str = "report",
                    approx: bool = False) -> tuple[DataFrame, DataFrame]:
    """Run a clean job and its rule set; returns ``(clean, report)``.

    The clean rows pass through unchanged whatever the outcome, unless
    ``on_fail="error"``.
    """
    fn, rules = CLEAN_JOBS[name]
    clean = fn(raw)
    return clean, quality.evaluate(clean, rules, on_fail=on_fail, approx=approx)


def run_clean_job(name: str, raw: DataFrame, path: str, *, table: str | None = None,
                  partition_by=(), on_fail: str = "report", results_path: str | None = None,
                  run_id: str = "manual", sketches_path: str | None = None) -> DataFrame:
    """A complete clean job: clean -> quality check -> write; returns the report.

    The job may run again and again on the same ``path``. With ``partition_by``
    a run replaces the partitions it has rows of and leaves all others; without,
    it replaces the table. All metrics are about the run's own rows.

    ``on_fail="report"``: one pass; the non-distinct metrics and the partitions
    touched are observed by the write itself, distinct counts then read the key
    column of those partitions only.  ``on_fail="error"``: the rows are staged in
    the shared scratch folder and checked there; nothing is committed when a
    rule fails, else the stage is what is written (the raw data is parsed once).

    ``results_path``: the table of reports, keyed by job and ``run_id`` (a run
    with the same id replaces its rows).  ``sketches_path``: the table of
    distinct-count sketches, keyed by the partitions (:mod:`.sketches`).
    """
    from ..session import scratch_path
    from ..sources.writers import rebalanced, write_clean

    fn, rules = CLEAN_JOBS[name]
    spark = raw.sparkSession
    clean = fn(raw)
    if on_fail not in ("report", "error"):
        raise ValueError("on_fail must be 'report' or 'error'")
    staged = on_fail == "error"
    keys = list(partition_by)
    observed, obs, deferred = quality.observe_rules(clean if staged else rebalanced(clean, keys), rules, name=f"dq_{name}",
                                                    partitions=() if staged else keys)
    if staged:
        stage = scratch_path(spark, f"stage-{name}")
        observed.write.parquet(stage)
        run_rows = spark.read.schema(clean.schema).parquet(stage)
    else:
        write_clean(observed, path, partition_by=keys, table=table, rebalance=False)
        run_rows = quality.restrict(spark.read.schema(clean.schema).parquet(path), keys, obs)
    report = quality.report_from_observation(spark, clean.columns, rules, obs)
    if deferred:
        full = quality._flat(rules)
        extra = quality.evaluate(run_rows, deferred)
        numbers = {r.describe(): full.index(r) + 1 for r in deferred}
        mapping = F.create_map(*[x for k, v in numbers.items() for x in (F.lit(k), F.lit(v))])
        report = report.unionByName(extra.withColumn("rule_no", mapping[F.col("rule")]))
    # one row a rule: fixed here, so that a later run on the path changes nothing in it
    report = spark.createDataFrame(report.collect(), report.schema)
    if results_path:
        quality.publish_report(report, results_path, context=name, run_id=run_id)
    if staged:
        quality.raise_failed(report)
        write_clean(run_rows, path, partition_by=keys, table=table)
    if sketches_path:
        from .sketches import write_sketches
        columns = [r.column for r in deferred if r.column in clean.columns]
        write_sketches(run_rows, sketches_path, columns, keys)
    return report
