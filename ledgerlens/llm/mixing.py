"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

A source with n of N documents and target weight w (weights are normalised
over the sources present) has the mean repetition rate ``w * N * epochs / n``.
Each document draws its number of copies by inverting the Poisson distribution
of that rate at a uniform number hashed from the seed and the document, so the
draw is the same on any cluster and after any loss of executors. Documents are
exploded by their count; every copy has a hashed position, and copies are
dealt to partitions and ordered in them by it: a global shuffle.

A rate above ``PIECE`` is the sum of independent draws of equal smaller rates,
which keeps exp(-rate) far from underflow and every table of sums short. A
document of over ``CHUNK`` pieces (a small source with a large weight) is dealt
out before it is copied: a row for each so many pieces, whose copies are
numbered on from the sums of the rows before, so that no row, array or task
holds all copies of a hot document.

``weights``: source -> weight; None: equal weights. A source missing from it
has weight 0 and is left out. A null source is a source of its own (key None).
Identity is the id, or the text where the id is null: repeated rows draw the
same count. Null and empty texts are mixed like others. An empty table gives
an empty result. Columns copy and position replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm._spark import written

PIECE = 50.0  # the largest rate that is inverted at once
CHUNK = 1000  # pieces drawn in one row: about 50,000 copies
TERMS = 150  # sums kept of it: the tail beyond is under 1e-27


def uniform(*parts: Column) -> Column:
    """A number in (0, 1), from 52 bits of an md5."""
    h = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def rates(docs: DataFrame, weights: dict | None, epochs: float = 1.0, source: str = "source") -> DataFrame:
    """(s, n_source, rate, pieces, sums): a row for each source; sums: the
    distribution function of one piece at 0, 1, 2, ... up to TERMS."""
    n = docs.groupBy(F.col(source).alias("s")).agg(F.count("*").alias("n_source"))
    if weights is None:
        w = F.lit(1.0)
    else:
        w = F.lit(0.0)
        for k, v in weights.items():
            w = F.when(F.col("s").eqNullSafe(F.lit(k)), float(v)).otherwise(w)
    n = n.withColumn("w", w).filter("w > 0")
    n = n.withColumn("rate", F.col("w") / n.agg(F.sum("w")).scalar() * docs.agg(F.count("*")).scalar()
                     * float(epochs) / F.col("n_source"))
    n = n.withColumn("pieces", F.greatest(F.lit(1), F.ceil(F.col("rate") / PIECE)).cast("int"))
    n = n.withColumn("m", F.col("rate") / F.col("pieces"))
    terms = n.select("*", F.explode(F.sequence(F.lit(0), F.lit(TERMS))).alias("k"))
    p = terms.withColumn("p", F.exp(F.col("k") * F.log("m") - F.col("m") - F.expr(
        "aggregate(sequence(1, greatest(k, 1)), 0D, (a, i) -> a + ln(i))")))
    sums = p.groupBy("s", "n_source", "rate", "pieces").agg(F.sort_array(F.collect_list(F.struct("k", "p"))).alias("p"))
    # written: the planner then knows its size, and sends it to every task only if it is small
    return written(sums.select("s", "n_source", "rate", "pieces", F.expr(
        "transform(p, x -> aggregate(slice(p, 1, x.k + 1), 0D, (a, y) -> a + y.p))").alias("sums")), "mixing-rates")


def _draw(rows: DataFrame, seed: str) -> DataFrame:
    """``rows`` with __n: the copies drawn by the pieces of its chunk."""
    first = F.col("__chunk") * CHUNK + 1
    pieces = F.sequence(first, F.least(first + CHUNK - 1, F.col("__pieces")))
    at = F.transform(pieces, lambda i: uniform(F.lit(seed), i.cast("string"), F.col("__who")))  # once a piece
    draws = F.transform(at, lambda u: F.size(F.filter("__sums", lambda c: c < u)))
    return rows.withColumn("__n", F.aggregate(draws, F.lit(0), lambda a, x: a + x))


def mix(docs: DataFrame, weights: dict | None = None, epochs: float = 1.0, seed: str = "mix",
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The input's columns, copy (from 1) and position (hex; the order of the mix)."""
    through = [c for c in docs.columns if c not in ("copy", "position")]
    who = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    d = docs.select(*[F.col(c) for c in through], who.alias("__who"))
    r = rates(docs, weights, epochs, source).select(*[F.col(c).alias(f"__{c}") for c in ("s", "pieces", "sums")])
    d = d.join(r, F.col(source).eqNullSafe(F.col("__s")))
    hot = r.filter(F.col("__pieces") > CHUNK).limit(1).count() > 0
    rows = _draw(d.filter(F.col("__pieces") <= CHUNK).withColumn("__chunk", F.lit(0)), seed).withColumn("__before", F.lit(0).cast("long"))
    if hot:
        chunks = F.sequence(F.lit(0), F.floor((F.col("__pieces") - 1) / CHUNK).cast("int"))
        parts = d.filter(F.col("__pieces") > CHUNK).withColumn("__chunk", F.explode(chunks)).repartition("__who", "__chunk")
        parts = _draw(parts, seed).withColumn("__at", F.xxhash64("__who", F.md5(F.concat(F.lit("s"), F.col(source)))))
        drawn = parts.select("__at", "__chunk", "__n").distinct()
        before = F.sum("__n").over(Window.partitionBy("__at").orderBy("__chunk")) - F.col("__n")
        parts = parts.join(drawn.select("__at", "__chunk", before.alias("__before")), ["__at", "__chunk"]).drop("__at")
        rows = rows.unionByName(parts.select(*rows.columns))
    copies = F.explode(F.transform(F.sequence(F.lit(1), F.col("__n")), lambda k: k + F.col("__before")))
    d = rows.filter("__n > 0").select(*through, "__who", copies.alias("copy"))
    d = d.withColumn("position", F.md5(F.concat_ws(":", F.lit(seed), F.lit("at"), F.col("copy").cast("string"),
                                                   "__who").cast("binary")))
    return d.drop("__who").repartition("position").sortWithinPartitions("position")
