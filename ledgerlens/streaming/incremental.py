"""Incremental loading: process only files that arrived since the last run.

A Structured Streaming file source remembers the files it has processed in
its checkpoint, so each run (``trigger(availableNow=True)``: everything new,
then stop) reads only new files.  Each micro-batch is cleaned by the same
function as the batch job and becomes one partition of the sink, named by the
checkpoint's own id and the batch id: if an executor or the driver dies
mid-batch, the restarted query replays that batch id and replaces its
partition instead of appending a second copy, and a new checkpoint over a kept
sink (which counts its batches from 0 again) replaces nothing.  Nothing is cached on a machine-local disk; the
checkpoint lives below the shared ``spark.checkpoint.dir``.

The names of a batch's partition are known before it is written, so it is
written as a plain table beside its place and moved there when it is whole.
``partitionBy`` would take the two names from each row instead, and copy all
other columns of the row into a new one to be rid of them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BATCH_COLUMN = "batch_id"
RUN_COLUMN = "load_id"


def stream_files(spark: SparkSession, source_dir: str, schema: StructType, *, fmt: str = "parquet",
                 glob: str | None = None, max_files_per_trigger: int | None = None,
                 options: dict | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(source_dir)


def _replace(spark: SparkSession, staged: str, path: str) -> None:
    """Move the folder ``staged`` to ``path``, in place of what is there."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path))
    fs = new.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(new, True)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"{staged} cannot be moved to {path}")


def run_incremental(spark: SparkSession, source_dir: str, schema: StructType,
                    clean_fn: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, *,
                    fmt: str = "parquet", glob: str | None = None, sink_format: str = "parquet",
                    dedup_keys: Sequence[str] | None = None,
                    dedup_within: tuple[str, str] | None = None,
                    max_files_per_trigger: int | None = None, tasks: int | None = None) -> int:
    """Clean all new files of ``source_dir`` into ``sink``; returns the number of
    rows this run handed to ``clean_fn``, over all its batches (0 when nothing
    new arrived).

    ``dedup_keys`` additionally drops rows whose keys were already seen in
    earlier batches. Their keys stay in the streaming state store: all of them,
    or with ``dedup_within`` = (time column, delay) those of the last ``delay``
    of event time, which bounds the state: a repeat within ``delay`` is dropped,
    also by a later run; a row older than the newest one by more than ``delay``
    when its run begins is late and is dropped, repeated or not.

    ``tasks``: deal the rows of every batch to so many tasks before ``clean_fn``
    (a wide projection over few large files). Off by default: files that land
    in numbers are tasks enough.
    """
    stream = stream_files(spark, source_dir, schema, fmt=fmt, glob=glob,
                          max_files_per_trigger=max_files_per_trigger)
    if dedup_keys and dedup_within:
        stream = stream.withWatermark(*dedup_within).dropDuplicatesWithinWatermark(list(dedup_keys))
    elif dedup_keys:
        stream = stream.dropDuplicates(list(dedup_keys))
    rows: dict[int, int] = {}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # The batch is an ordinary DataFrame: the batch job's clean function
        # applies unchanged.
        seen = Observation()
        if tasks:
            batch = batch.repartition(tasks)
        load = json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        staged = f"{sink}/.staging-{load}-{batch_id}"  # hidden from readers; a replay writes it anew
        (clean_fn(batch.observe(seen, F.count(F.lit(1)).alias("n"))).drop(RUN_COLUMN, BATCH_COLUMN)
             .write.mode("overwrite").format(sink_format).save(staged))
        _replace(batch.sparkSession, staged, f"{sink}/{RUN_COLUMN}={load}/{BATCH_COLUMN}={batch_id}")
        rows[batch_id] = seen.get["n"]

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(rows.values())


def read_sink(spark: SparkSession, sink: str, schema: StructType | None = None,
              sink_format: str = "parquet") -> DataFrame:
    """The accumulated sink without the bookkeeping columns.

    Each batch's folder is read as a table of its own right: over the whole tree
    the scan would return the two columns, and a projection that drops them
    copies all others."""
    r = spark.read.format(sink_format)
    if schema is not None:
        r = r.schema(schema)
    return r.load(f"{sink}/{RUN_COLUMN}=*/{BATCH_COLUMN}=*")
