"""Spark session defaults and the shared scratch location.

The engine never picks a machine-local folder on its own: intermediate
tables and streaming checkpoints live below ``spark.checkpoint.dir``, the
shared folder the cluster names.  Only in local mode, where one machine is
all there is, a missing setting falls back to a directory below the warehouse;
on a cluster it is an error.  Each application has a folder of its own there,
which :func:`clear_scratch` removes once its results are written.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Session settings the library relies on.  They are applied only where the
# cluster has not set them already.
DEFAULT_CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # ones, turn shuffle joins into broadcast joins when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Raw JSON keys are capitalised, the mappings are not.
    "spark.sql.caseSensitive": "false",
    # Path keys such as institution=0010 must stay strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Re-running a partitioned write replaces only the partitions it writes.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "ledgerlens",
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the SQL options of :data:`DEFAULT_CONF` that the session or the
    cluster has not set; what is set stays."""
    there = spark.conf.getAll
    for k, v in DEFAULT_CONF.items():
        if k not in there and not k.startswith("spark.ui"):
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and stream checkpoints."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
        d = warehouse.rstrip("/") + "/_ledgerlens_checkpoints"
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/ledgerlens/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> bool:
    """Remove this application's intermediate tables. For the caller, when the
    results are written: DataFrames of the library may still read them before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
