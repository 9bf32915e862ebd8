"""One-pass data-quality evaluation.

Rules are typed objects.  :func:`evaluate` turns every rule into aggregate
expressions, computes all of them in a single ``agg`` (one scan, map-side
partial aggregation, one tiny shuffle), and unpivots the single result row
into one report row per rule with ``stack``.  The report is a DataFrame; it
is only pulled to the driver when ``on_fail="error"`` (one row per rule).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import YEAR_MIN, YEAR_MAX
from .mapping import quote


class DataQualityError(RuntimeError):
    pass


def _c(name: str) -> Column:
    return F.col(quote(name))


@dataclass(frozen=True)
class RowCount:
    gt: float = 0

    def describe(self):
        return f"RowCount > {self.gt:g}"

    def metric(self, df, approx):
        return F.count(F.lit(1)).cast("double")

    def passed(self, m):
        return m > F.lit(float(self.gt))

    threshold = property(lambda self: float(self.gt))
    column = None


@dataclass(frozen=True)
class ColumnCount:
    gt: float = 0

    def describe(self):
        return f"ColumnCount > {self.gt:g}"

    def metric(self, df, approx):
        return F.lit(float(len(df.columns)))

    def passed(self, m):
        return m > F.lit(float(self.gt))

    threshold = property(lambda self: float(self.gt))
    column = None


@dataclass(frozen=True)
class Completeness:
    column: str
    min: float

    def describe(self):
        return f'Completeness "{self.column}" >= {self.min:g}'

    def metric(self, df, approx):
        # Share of non-null values; null (and so failed) on an empty input.
        return F.count(_c(self.column)) / F.nullif(F.count(F.lit(1)), F.lit(0))

    def passed(self, m):
        return m >= F.lit(float(self.min))

    threshold = property(lambda self: float(self.min))


@dataclass(frozen=True)
class DistinctCount:
    column: str
    gt: float = 0

    def describe(self):
        return f'DistinctValuesCount "{self.column}" > {self.gt:g}'

    def metric(self, df, approx):
        if approx:
            return F.approx_count_distinct(_c(self.column)).cast("double")
        return F.count_distinct(_c(self.column)).cast("double")

    def passed(self, m):
        return m > F.lit(float(self.gt))

    threshold = property(lambda self: float(self.gt))


@dataclass(frozen=True)
class MinValue:
    """``ColumnValues c >= lo``; nulls are ignored, an all-null column passes."""
    column: str
    lo: float

    def describe(self):
        return f'ColumnValues "{self.column}" >= {self.lo:g}'

    def metric(self, df, approx):
        return F.min(_c(self.column)).cast("double")

    def passed(self, m):
        return m.isNull() | (m >= F.lit(float(self.lo)))

    threshold = property(lambda self: float(self.lo))


@dataclass(frozen=True)
class MaxValue:
    """``ColumnValues c <= hi``; nulls are ignored, an all-null column passes."""
    column: str
    hi: float

    def describe(self):
        return f'ColumnValues "{self.column}" <= {self.hi:g}'

    def metric(self, df, approx):
        return F.max(_c(self.column)).cast("double")

    def passed(self, m):
        return m.isNull() | (m <= F.lit(float(self.hi)))

    threshold = property(lambda self: float(self.hi))


def ValueRange(column: str, lo: float, hi: float):
    return [MinValue(column, lo), MaxValue(column, hi)]


def _flat(rules):
    out = []
    for r in rules:
        out.extend(r if isinstance(r, list) else [r])
    return out


def evaluate(df: DataFrame, rules, *, on_fail: str = "report", approx: bool = False) -> DataFrame:
    """Report ``(rule_no, rule, column, metric, threshold, outcome)``, one row per rule.

    ``on_fail="error"`` raises :class:`DataQualityError` when any rule fails;
    the default only reports, so a failed check never blocks the data.
    """
    rules = _flat(rules)
    present = {c.lower() for c in df.columns}

    def metric(r):
        # A rule on a column the data does not have reports no metric and fails.
        col = getattr(r, "column", None)
        if col is not None and col.lower() not in present:
            return F.lit(None).cast("double")
        return r.metric(df, approx)

    aggs = [metric(r).alias(f"m{i}") for i, r in enumerate(rules)]
    metrics = df.agg(*aggs)
    rows = []
    for i, r in enumerate(rules):
        m = F.col(f"m{i}").cast("double")
        rows.append(F.struct(
            F.lit(i + 1).alias("rule_no"),
            F.lit(r.describe()).alias("rule"),
            F.lit(getattr(r, "column", None)).cast("string").alias("column"),
            m.alias("metric"),
            F.lit(r.threshold).alias("threshold"),
            F.when(F.coalesce(r.passed(m), F.lit(False)), F.lit("Passed"))
             .otherwise(F.lit("Failed")).alias("outcome"),
        ))
    report = metrics.select(F.inline(F.array(*rows)))
    if on_fail == "error":
        raise_failed(report)
    elif on_fail != "report":
        raise ValueError("on_fail must be 'report' or 'error'")
    return report


def raise_failed(report: DataFrame) -> None:
    failed = [row["rule"] for row in report.filter("outcome = 'Failed'").collect()]
    if failed:
        raise DataQualityError("data-quality rules failed: " + "; ".join(failed))


def restrict(df: DataFrame, keys, observation) -> DataFrame:
    """The rows of ``df`` in the partitions that the observed run touched (their
    values are bounded by the directories written; partition filters, so other
    partitions are not read)."""
    if not keys:
        return df
    touched = (observation.get["touched"] if observation is not None else None) or ""
    return df.filter(_partition(keys).isin(touched.split("\n")))


def _partition(keys) -> Column:
    """The partition that a row is written to, as text (an empty text is written as null)."""
    return F.to_json(F.struct(*[F.nullif(_c(k).cast("string"), F.lit("")).alias(f"k{i}") for i, k in enumerate(keys)]))


def observe_rules(df: DataFrame, rules, name: str = "dq", partitions=()):
    """Attach the non-distinct rule metrics to ``df`` as an observation, and with
    ``partitions`` the distinct values of these columns.

    The metrics are then computed by whatever action runs next (typically the
    write of the clean table) in the same pass over the data, instead of a
    second scan.  Returns ``(observed_df, observation, deferred_rules)``;
    distinct-count rules cannot be observed and are returned as deferred.
    Where nothing is observed the observation is None.
    """
    from pyspark.sql import Observation

    rules = _flat(rules)
    present = {c.lower() for c in df.columns}
    obs = Observation(name)
    aggs, deferred = [], []
    for i, r in enumerate(rules):
        col = getattr(r, "column", None)
        if isinstance(r, DistinctCount):
            deferred.append(r)
        elif isinstance(r, ColumnCount):
            continue
        elif col is not None and col.lower() not in present:
            continue
        else:
            aggs.append(r.metric(df, False).alias(f"m{i}"))
    if partitions:
        # as one text (JSON has no raw line breaks): an observation has no arrays
        aggs.append(F.array_join(F.collect_set(_partition(partitions)), "\n").alias("touched"))
    if not aggs:
        return df, None, deferred
    return df.observe(obs, *aggs), obs, deferred


def report_from_observation(spark, df_columns: list[str], rules, observation) -> DataFrame:
    """Report rows (same shape as :func:`evaluate`) from an observation that
    has been filled by an action (None: nothing was observed); distinct-count
    rows are left out."""
    rules = _flat(rules)
    values = observation.get if observation is not None else {}
    rows = []
    for i, r in enumerate(rules):
        if isinstance(r, DistinctCount):
            continue
        if isinstance(r, ColumnCount):
            m = float(len(df_columns))
        else:
            v = values.get(f"m{i}")
            m = None if v is None else float(v)
        rows.append((i + 1, r.describe(), getattr(r, "column", None), m, r.threshold))
    schema = "rule_no int, rule string, column string, metric double, threshold double"
    base = spark.createDataFrame(rows, schema)
    passed = F.lit(False)
    for i, r in enumerate(rules):
        if not isinstance(r, DistinctCount):
            passed = passed | ((F.col("rule_no") == i + 1) & F.coalesce(r.passed(F.col("metric")), F.lit(False)))
    return base.withColumn("outcome", F.when(passed, "Passed").otherwise("Failed"))


def publish_report(report: DataFrame, path: str, *, context: str, run_id: str) -> bool:
    """Put a report into the shared results table, which is keyed by ``context``
    and ``run_id``: publishing a run again replaces its rows, other runs stay.
    Best effort: a failure is logged and never fails the job. True when written."""
    try:
        (report.withColumn("context", F.lit(context)).withColumn("run_id", F.lit(run_id))
               .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("context", "run_id").parquet(path))
        return True
    except Exception as e:  # noqa: BLE001 - publishing must not break the job
        import logging
        logging.getLogger(__name__).warning("could not publish data-quality results: %s", e)
        return False


def read_results(spark, path: str) -> DataFrame:
    """The results table: ``(rule_no, rule, column, metric, threshold, outcome, context, run_id)``."""
    schema = ("rule_no int, rule string, column string, metric double, threshold double, outcome string, "
              "context string, run_id string")
    return spark.read.schema(schema).parquet(path)


# ---------------------------------------------------------------------------
# Rule sets of the six clean tables.
# ---------------------------------------------------------------------------

def _base():
    return [ColumnCount(0), RowCount(0)]


VOTE_RULES = _base() + [
    Completeness("geschaeftsnummer", 0.99), DistinctCount("geschaeftsnummer", 0),
    Completeness("stimm_datum", 0.60),
    Completeness("year", 0.95), MinValue("year", YEAR_MIN), MaxValue("year", YEAR_MAX),
    MinValue("ja", 0), MinValue("nein", 0), MinValue("enthalten", 0),
    MinValue("nicht_praesent", 0), MinValue("total_stimmen", 0),
]

BUSINESS_RULES = _base() + [
    Completeness("grnr", 0.98), DistinctCount("grnr", 0),
    Completeness("geschaeftsart", 0.90),
    Completeness("year", 0.95), MinValue("year", YEAR_MIN), MaxValue("year", YEAR_MAX),
]

INSTITUTION_RULES = _base() + [
    Completeness("key", 0.99), DistinctCount("key", 0),
    Completeness("bezeichnung", 0.95),
    Completeness("departement.key", 0.90), Completeness("departement.bezeichnung", 0.90),
]

ACCOUNT_RULES = _base() + [
    Completeness("id", 0.99), MinValue("id", 0),
    Completeness("kontoNr", 0.99), DistinctCount("kontoNr", 0),
    Completeness("institution.key", 0.95), Completeness("departement.key", 0.90),
]

SPENDING_RULES = _base() + [
    Completeness("jahr", 0.99), MinValue("jahr", YEAR_MIN), MaxValue("jahr", YEAR_MAX),
    Completeness("sachkonto", 0.99), DistinctCount("sachkonto", 0),
    Completeness("institution", 0.90), Completeness("betragstyp", 0.90),
    Completeness("betrag", 0.95),
]

SURVEY_RULES = _base() + [
    Completeness("Jahr", 0.90), Completeness("sgewicht", 0.60), Completeness("pgewicht", 0.60),
]
