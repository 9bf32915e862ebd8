"""Line dedup by overlapping three-line windows, in DataFrame operations only.

A document's lines are its ``\\n``-split pieces; blank lines (spaces, tabs and
carriage returns alone) take no part. Every three consecutive lines, trimmed,
are a window; windows are known by 96 hash bits. The first occurrence of a
window is the one with the smallest (id, text key, position), a null id first.
Lines covered by any later occurrence are removed: overlapping windows merge
into intervals, and the text is rebuilt from what lies between them. By
induction over that order every line removed still stands at an earlier place.

Documents of fewer than three lines have no window and stay whole. Null text:
null, with 0 lines. A document may lose all its lines; it is then empty.
Repeated rows (same id and text) are one document and get the same result.
Columns of the input other than the text are passed through; result columns
of the same names are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm._spark import text_key

WINDOW = 3
BLANKS = " \t\r"


def line_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, key, at, i0, i1, i2, w1, w2): a row for each window; i: line numbers."""
    lines = docs.select(
        F.col(doc_id).alias("doc"), text_key(text).alias("key"),
        F.filter(F.transform(F.split(F.col(text), "\n"),
                             lambda x, i: F.struct(i.alias("i"), F.btrim(x, F.lit(BLANKS)).alias("l"))),
                 lambda s: s["l"] != "").alias("s"))
    # hash each line once; the generator keeps the array from being computed again below
    lines = lines.filter(F.size("s") >= WINDOW).select("doc", "key", F.explode(F.array(
        F.transform("s", lambda x: F.struct(x["i"].alias("i"), F.xxhash64(x["l"]).alias("a"),
                                            F.hash(x["l"]).alias("b"))))).alias("s"))
    n = F.size("s")
    rows = lines.select("doc", "key", F.posexplode(F.arrays_zip(
        F.slice("s", F.lit(1), n - 2).alias("x"), F.slice("s", F.lit(2), n - 2).alias("y"),
        F.slice("s", F.lit(3), n - 2).alias("z"))).alias("at", "w"))
    return rows.select("doc", "key", "at", *[F.col(f"w.{c}.i").alias(f"i{k}") for k, c in enumerate("xyz")],
                       F.xxhash64("w.x.a", "w.y.a", "w.z.a").alias("w1"), F.hash("w.x.b", "w.y.b", "w.z.b").alias("w2"))


def later_occurrences(windows: DataFrame) -> DataFrame:
    """The windows that have occurred before, anywhere. The first place of each
    repeated window is a map-side minimum; a frequent window splits in the join."""
    place = F.struct("doc", "key", "at")
    first = (windows.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select("w1", "w2", "first"))
    return windows.join(first, ["w1", "w2"]).filter(~place.eqNullSafe(F.col("first")))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The input's columns, the text without repeated windows, n_lines, n_removed."""
    through = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    covered = (later_occurrences(line_windows(docs, doc_id, text))
               .select("doc", "key", F.explode(F.array("i0", "i1", "i2")).alias("i"))
               .groupBy("doc", "key").agg(F.sort_array(F.collect_set("i")).alias("c")))
    after = F.transform("c", lambda i: i + 1)
    cut = covered.select(F.col("doc").alias("__doc"), F.col("key").alias("__key"), F.size("c").alias("__cut"),
                         F.array_except("c", after).alias("__from"), F.array_except(after, F.col("c")).alias("__to"))
    d = docs.select(*[F.col(c) for c in through], text_key(text).alias("__k"))
    d = d.join(cut, (F.col("__k") == F.col("__key")) & F.col(doc_id).eqNullSafe(F.col("__doc")), "left")
    d = d.withColumn("__lines", F.explode_outer(F.array(F.split(F.col(text), "\n"))))
    n = F.size("__lines")
    kept = F.zip_with(F.concat(F.array(F.lit(0)), F.col("__to")), F.concat(F.col("__from"), F.array(n)),
                      lambda a, b: F.slice(F.col("__lines"), a + 1, b - a))
    new = F.when(F.col("__cut").isNull(), F.col(text)).otherwise(F.array_join(F.flatten(kept), "\n"))
    return d.select(*[new.alias(c) if c == text else F.col(c) for c in through],
                    F.when(F.col(text).isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
                    F.coalesce("__cut", F.lit(0)).cast("long").alias("n_removed"))
