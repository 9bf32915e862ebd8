"""Distinct counts that can be merged: a stored sketch for each partition.

An exact distinct count must see every key again; a HyperLogLog sketch of a
partition is a few KB (``2 ** lg_k`` bytes at most), is replaced with its
partition, and the sketches of all partitions unite into the count of the
table.  A daily run therefore reads its own rows and some KB for each older
partition.  The count differs from the exact one by a relative standard error
of about ``0.83 / sqrt(2 ** lg_k)`` (:func:`error`).  The exact mode
(:class:`.quality.DistinctCount`) stays as it is.

A null value counts nowhere.  The sketch of a partition without rows is not
stored; a table without sketches has no row in :func:`distinct_counts`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, BinaryType

from .mapping import quote

LG_K = 12


def error(lg_k: int = LG_K, deviations: float = 4.0) -> float:
    """The relative error that an estimate stays within (so many standard deviations)."""
    return deviations * 0.83 / math.sqrt(2 ** lg_k)


def sketches(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """``(keys..., column, n_rows, sketch)``: one row for each partition and
    column.  One pass; every task sketches its rows first, so what is shuffled
    is a sketch for each task, partition and column, whatever the rows."""
    aggs = [F.hll_sketch_agg(F.col(quote(c)).cast("string"), F.lit(lg_k)).alias(f"s{i}") for i, c in enumerate(columns)]
    per = df.groupBy(*[F.col(quote(k)) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)])
    return per.select(*[F.col(quote(k)) for k in keys], "n_rows", F.inline(rows)).filter("n_rows > 0")


def write_sketches(df: DataFrame, path: str, columns: Sequence[str], keys: Sequence[str] = (), lg_k: int = LG_K) -> None:
    """Store the sketches of the partitions that ``df`` has rows of; those of
    other partitions stay."""
    if not columns:
        return
    keys = list(keys)
    w = sketches(df, columns, keys, lg_k).coalesce(1).write.mode("overwrite")
    if keys:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*keys)
    w.parquet(path)


def read_sketches(spark: SparkSession, path: str, keys: Sequence[str] = ()) -> DataFrame:
    """The stored sketches; partition keys as text."""
    return spark.read.schema(StructType([
        StructField("n_rows", LongType()), StructField("column", StringType()), StructField("sketch", BinaryType()),
        *(StructField(k, StringType()) for k in keys)])).parquet(path)


def distinct_counts(stored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., column, n_rows, distinct_values)``: the union of the sketches
    (all of them, or for each value of some of their keys)."""
    return stored.groupBy(*by, "column").agg(
        F.sum("n_rows").alias("n_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"))
