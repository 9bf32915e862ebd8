"""Bounded samples of rows for fitting, drawn by hashed id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm._spark import fold, written


def training_ids(labels: DataFrame, label: str, at_most: int, doc_id: str = "doc_id", hold_out: int = 0, folds: int = 5) -> DataFrame:
    """(__id, label) of at most so many labelled ids outside the held-out fold.
    Of several labels of one id the highest counts; null labels and ids don't."""
    one = (labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & (fold(doc_id, folds) != hold_out))
           .groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).cast("int").alias("label")))
    return written(by_hash(one, F.col("__id"), at_most), "training-ids")


def by_hash(rows: DataFrame, key: Column, at_most: int) -> DataFrame:
    """At most so many rows, those of the smallest hashes."""
    return rows.orderBy(F.xxhash64(F.lit("sample"), key)).limit(at_most)


def one_text(rows: DataFrame, *keep: str) -> DataFrame:
    """One row of each ``__id``, that of the smallest text hash (combined in each
    task first): a sample of ids is then bounded in rows too."""
    return rows.groupBy("__id", *keep).agg(F.min_by("text", F.xxhash64("text")).alias("text")).drop("__id")
