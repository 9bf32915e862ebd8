"""Importance resampling to a target distribution, over hashed word n-grams.

A text is lower-cased (A-Z only) and its separators collapse to single spaces;
one scan with overlapping matches, held to word borders by lookarounds, then
emits at each word the spans of its n-grams, whose CRC-32 modulo the number of
buckets is counted. A bucket's gain is the log ratio of its smoothed share in
the target and in the corpus, in whole thousandths; a document's weight is the
floored mean of the gains of its features. Weight plus a Gumbel number hashed
from seed and id is the score; the largest scores among documents of enough
words are drawn (sampling without replacement in proportion to exp(weight)).

Only bucket totals (a fixed number) reach the driver. Ranks come from counts of
documents by score, whose values lie in a range fixed by double arithmetic, and
from an order within equal scores only.

Nulls, empty texts and texts without a word have no feature, weight 0, and are
never drawn. Repeated rows count and are drawn each; of rows equal in score and
id, the smaller text key goes first. An empty table gives an empty result; an
empty target has only smoothed shares. A null id is hashed as the text 'null' and comes
before others. Other columns are not carried along.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm._spark import text_key, written
from ledgerlens.llm._text import ALNUM, chunks, column

BUCKETS, NGRAM, LEAST_WORDS, PERCENT, SEED = 10_000, 2, 20, 25, 7

#: Lower case of A-Z; every byte that is no part of a word becomes a space.
_CLEAN = bytes((c | 0x20 if 0x41 <= c <= 0x5A else c) if ALNUM[c] else 0x20 for c in range(256))


def scanner(n: int):
    """Matches at every word border, also within the last match. Group n is the
    word there, each outer group has one word more, as far as there are words."""
    spans = "([^ ]++)"
    for _ in range(n - 1):
        spans = f"({spans}(?: [^ ]++)?+)"
    return regex.compile(f"(?<![^ ]){spans}(?![^ ])".encode())


def features(text: bytes, scan, n: int = NGRAM) -> tuple[int, np.ndarray]:
    """(number of words, CRC-32 of every run of 1 to n words)."""
    clean = b" ".join(text.translate(_CLEAN).split())
    groups = range(1, n + 1)
    found = np.fromiter((crc32(x) for m in scan.finditer(clean, overlapped=True) for x in m.groups()),
                        np.uint32).reshape(-1, n)
    words = len(found)
    # a run of k words starts at all but the last k - 1
    return words, np.concatenate([found[:max(words - k + 1, 0), n - k] for k in groups])


def count(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """(doc, key, n_words, n_features, at, times): a row for each row; at and
    times are the buckets it touches and how often."""
    schema = T.StructType([T.StructField("doc", docs.schema[doc_id].dataType), T.StructField("key", T.LongType()),
                           T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()),
                           T.StructField("at", T.ArrayType(T.ShortType() if buckets <= 1 << 15 else T.IntegerType())),
                           T.StructField("times", T.ArrayType(T.IntegerType()))])
    kind = np.int16 if buckets <= 1 << 15 else np.int32

    def one(raw: bytes, scan):
        words, crc = features(raw, scan, n)
        b = crc % np.uint32(buckets)
        if len(b) > buckets:
            held = np.bincount(b, minlength=buckets)
            at = np.flatnonzero(held)
            return words, len(b), at, held[at]
        return words, len(b), *np.unique(b, return_counts=True)

    def run(batches):
        scan = scanner(n)
        for batch, data, off in chunks(batches):
            raw = data.tobytes()
            got = [one(raw[a:b], scan) for a, b in zip(off[:-1], off[1:])]
            ends = pa.array(np.append(0, np.cumsum([len(g[2]) for g in got])).astype(np.int32))
            at, times = (np.concatenate([g[k] for g in got]) for k in (2, 3))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc"), column(batch, "key"), pa.array([g[0] for g in got], pa.int64()),
                 pa.array([g[1] for g in got], pa.int64()), pa.ListArray.from_arrays(ends, pa.array(at.astype(kind))),
                 pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32)))], names=schema.names)

    part = docs.select(F.col(doc_id).alias("doc"), text_key(text).alias("key"), F.col(text).alias("text"))
    return part.mapInArrow(run, schema)


def totals(counted: DataFrame, buckets: int) -> DataFrame:
    """(bucket, held): features of all rows by bucket, summed in each task before the shuffle."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            at, times = (column(batch, c).flatten().to_numpy() for c in ("at", "times"))
            np.add.at(total, at, times)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "held"])

    return counted.select("at", "times").mapInArrow(run, "bucket int, held long").groupBy("bucket").agg(F.sum("held").alias("held"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, from the bucket totals of both; at most ``buckets`` rows come back."""
    both = (corpus.join(target.withColumnRenamed("held", "wanted"), "bucket", "full")
            .select("bucket", F.coalesce("held", F.lit(0)).alias("s"), F.coalesce("wanted", F.lit(0)).alias("t"))).toPandas()
    s, t = np.zeros(buckets), np.zeros(buckets)
    s[both["bucket"]], t[both["bucket"]] = both["s"], both["t"]
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(counted: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc, key, n_words, n_features, weight)."""
    schema = T.StructType([*counted.schema.fields[:4], T.StructField("weight", T.LongType())])

    def run(batches):
        for batch in batches:
            at, times = (column(batch, c) for c in ("at", "times"))
            ends = np.append(0, np.cumsum(at.value_lengths().fill_null(0).to_numpy()))
            total = np.append(0, np.cumsum(gain[at.flatten().to_numpy()] * times.flatten().to_numpy()))
            n = column(batch, "n_features").to_numpy()
            weight = np.where(n > 0, (total[ends[1:]] - total[ends[:-1]]) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(weight)], names=schema.names)

    return counted.mapInArrow(run, schema)


def gumbel(doc: Column, seed: int) -> Column:
    """Whole thousandths of a Gumbel number hashed from seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``scored`` (doc, key, n_words, score) with rank: the place among the rows
    drawn, the largest scores first; null where not drawn. ``scored`` is read
    three times, so it should be a written table."""
    fit = F.col("n_words") >= least_words
    # one row a distinct score: a range that doesn't grow with the data
    held = written(scored.filter(fit).groupBy("score").agg(F.count("*").alias("held")), "resample-scores")
    quota = (held.agg(F.sum("held")).first()[0] or 0) * percent // 100
    before = held.select("score", (F.sum("held").over(Window.orderBy(F.desc("score"))) - F.col("held")).alias("before"))
    before = written(before.filter(F.col("before") < quota), "resample-places")
    last = before.agg(F.min("score")).first()[0]
    if last is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    # only rows that may be drawn are ordered
    some = fit & (F.col("score") >= last)
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc").asc_nulls_first(), "key"))
    top = scored.filter(some).join(before, "score")
    rank = F.col("before") + place
    top = top.withColumn("rank", F.when(rank <= quota, rank).cast("long")).select(*scored.columns, "rank")
    return top.unionByName(scored.filter(~some).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = NGRAM,
             buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
             target_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) per row of ``docs``;
    rank null where it is not drawn."""
    counted = written(count(docs, doc_id, text, n, buckets), "resample-counts")
    wanted = count(target.select(F.lit(0).alias("id"), F.col(target_text).alias("text")), "id", "text", n, buckets)
    gain = gains(totals(counted, buckets), totals(wanted, buckets), buckets)
    scored = weigh(counted, gain).withColumn("score", (F.col("weight") + gumbel(F.col("doc"), seed)).cast("long"))
    out = ranked(written(scored, "resample-scored"), percent, least_words)
    return out.select(F.col("doc").alias(doc_id), "n_words", "n_features", "weight", "score", "rank")
