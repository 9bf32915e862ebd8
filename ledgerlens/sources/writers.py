"""Sinks: clean-zone Parquet (optionally partitioned and catalogued), JSON
Lines and CSV result files, and view publication.

Writes default to ``overwrite``; partitioned writes replace only the
partitions present in the data (dynamic overwrite, set on the write itself, so
that no session setting can turn it into a loss of the others), so re-running a
day or a work item is idempotent.  Before a partitioned write the rows are
*rebalanced* on the partition keys: AQE then splits a partition value that
holds a large share of the rows over several tasks and files instead of
sending it to one task, and coalesces the many small ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def rebalanced(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` dealt out for a write partitioned by ``keys``."""
    return df.hint("rebalance", *keys) if keys else df


def write_clean(df: DataFrame, path: str, *, partition_by: Sequence[str] = (),
                table: str | None = None, mode: str = "overwrite",
                compression: str = "snappy", rebalance: bool = True) -> None:
    """Parquet in the clean zone; with ``table`` also registered in the catalog.

    With ``partition_by`` an overwrite replaces only the partitions that ``df``
    has rows of, whatever the session's overwrite mode: Spark stages them and
    moves them in when the job commits, and older partitions stay.  The table
    is then one over ``path`` (a ``saveAsTable`` would replace it whole); its
    new partitions are added to the catalog.  ``rebalance=False``: ``df`` is
    :func:`rebalanced` already (an observation must stand above it: planning at
    run time drops one below an empty shuffle).
    """
    w = (rebalanced(df, partition_by) if rebalance else df).write.mode(mode).option("compression", compression)
    if not partition_by:
        if table:
            w.format("parquet").option("path", path).saveAsTable(table)
        else:
            w.parquet(path)
        return
    w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    if table:
        catalog = df.sparkSession.catalog
        if not catalog.tableExists(table):
            columns = [c for c in df.schema.fields if c.name not in partition_by]
            columns += [df.schema[k] for k in partition_by]
            ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
            keys = ", ".join(f"`{k}`" for k in partition_by)
            df.sparkSession.sql(f"CREATE TABLE {table} ({ddl}) USING parquet PARTITIONED BY ({keys}) "
                                f"LOCATION '{path}'")
        catalog.recoverPartitions(table)
        catalog.refreshTable(table)


def write_json(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """JSON Lines, one file per task (never one list in one process)."""
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite", header: bool = True) -> None:
    """CSV with header; quotes and embedded newlines are escaped by doubling,
    blanks at the ends of a value stay.  CSV readers take empty text as null."""
    (df.write.mode(mode).option("header", header).option("quote", '"').option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str], *, fmt: str = "json") -> None:
    """Partition-keyed write (``key=value`` directories), dynamic overwrite.

    Empty partitions are never written: only key values present in the data
    produce directories.
    """
    w = (rebalanced(df, keys).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*keys))
    w.format(fmt).save(path)


def append_pending(work: DataFrame, done: DataFrame, keys: Sequence[str], path: str,
                   fmt: str = "parquet") -> None:
    """Idempotent keyed append: write only the work items not yet in ``done``
    (which may be what ``path`` held when it was read)."""
    from ..operators.worklist import pending
    pending(work, done, keys).write.mode("append").format(fmt).save(path)
