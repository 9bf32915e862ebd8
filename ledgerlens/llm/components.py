"""Connected components of a graph held in two columns, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm._spark import written


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(v, label): the smallest vertex of each vertex's component, from edges (a, b).

    Each round takes the smallest label among the neighbours (a map-side
    minimum, so a vertex with many edges is no hot group) and then the label of
    that label, which halves the distance to go. Rounds are written tables; the
    loop ends with the first that changes nothing. Null ends are ignored."""
    e = edges.select("a", "b").filter("a is not null and b is not null")
    both = written(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    now = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
                  .select(F.col("a").alias("v"), "label"), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        near = both.join(now.select(F.col("v").alias("b"), "label"), "b").groupBy(F.col("a").alias("v")).agg(
            F.min("label").alias("near"))
        step = now.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = now.select(F.col("v").alias("label"), F.col("label").alias("far"))
        step = step.join(jump, "label").select("v", "old", F.least("label", "far").alias("label"))
        new = written(step, f"{name}-{turn}")
        changed = new.filter("old <> label").limit(1).count()
        now = new.select("v", "label")
        if not changed:
            return now
