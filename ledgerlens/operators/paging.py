"""A sorted result, numbered and cut into pages, without sorting it in one task (O2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

PAGE_SIZE = 100  # hits of one page of a search result


def result_pages(df: DataFrame, by: Sequence[str], *, group: Sequence[str] = (), size: int = PAGE_SIZE) -> DataFrame:
    """``df`` with ``position`` (from 1, in ascending order of ``by``, nulls last)
    and ``page`` (from 1, ``size`` rows each), both within ``group`` (of null, too).

    Rows are dealt out by ranges of (group, by) and numbered inside their task; a
    position is that number plus the rows of the same group in earlier tasks. So a
    group that holds most rows is spread over many tasks, and only a count for
    each task and group is summed up. Rows with equal ``by`` have no order among
    themselves: name a unique column last. Positions stay as they are when tasks
    run again, for the numbered rows are written once. An empty ``df`` gives none.
    """
    taken = {"position", "page"} & set(df.columns)
    if taken or not by or size < 1:
        raise ValueError(f"needs columns to sort by, a positive size, and no columns named {sorted(taken)}")
    keys = [F.col(c).asc_nulls_last() for c in (*group, *by)]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    of = F.struct(*[F.col(c) for c in group]) if group else F.struct(F.lit(0).alias("all"))
    path = scratch_path(df.sparkSession, "pages")
    dealt.select(F.struct("*").alias("row"), of.alias("of"), F.monotonically_increasing_id().alias("at")) \
         .withColumn("task", F.shiftright("at", 33)).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    parts = rows.groupBy("of", "task").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("of").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("of").alias("p_of"), F.col("task").alias("p_task"), "first",
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    at = rows.join(parts, F.col("of").eqNullSafe(F.col("p_of")) & (F.col("task") == F.col("p_task")))
    at = at.withColumn("position", F.col("at") - F.col("first") + F.col("earlier") + 1)
    return at.select("row.*", "position", F.expr(f"(position - 1) div {size} + 1").alias("page"))
