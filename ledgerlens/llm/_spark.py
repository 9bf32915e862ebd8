"""Spark helpers of the operators: scratch tables, folds, row identity."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import scratch_path


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers (once an application), for
    clusters and sessions whose workers don't have it on their path."""
    import ledgerlens

    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(ledgerlens.__file__))
    to = os.path.join(tempfile.mkdtemp(prefix="ledgerlens-"), "ledgerlens.zip")
    with zipfile.ZipFile(to, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(to)
    _shipped.add(sc.applicationId)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the cluster's shared folder, read again: its
    lineage is cut there, so a lost executor costs no more than re-reading."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(id_col: str, k: int) -> Column:
    """crc32 of the id's text, modulo k (a null id counts as the text 'null')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).cast("binary")) % k


def text_key(text_col: str) -> Column:
    """Tells rows of one id but different texts apart; rows equal in both are one document."""
    return F.xxhash64(F.col(text_col))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
