"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learned: words with the highest log odds of standing in toxic
training documents. Features: densities of lexicon words, of lexicon words near
a second person, of disguised ones (digits or signs for letters), capitals,
punctuation and further obfuscation rates. Trees fit the logistic loss on
histogram bins; the calibration is a pool-adjacent-violators fit on rows the
trees have not seen.

The fit reads at most ``sample`` labelled documents outside the held-out fold
(those of the smallest id hashes); scores cover every row and whole texts. Null
and empty texts are scored as texts without words. Without labelled rows of
both classes the score is the share of toxic ones (0 without any). Repeated rows
each get a score; a repeated id is learned from once, by its text of the smallest
hash. Of an empty table the result is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm._features import TOXIC_FEATURES, toxic_features
from ledgerlens.llm._spark import fold, written
from ledgerlens.llm._text import ALNUM, chunks, column, word_hashes, words
from ledgerlens.llm._train import one_text, training_ids

SAMPLE = 12_000
LEXICON, STRONG, LEAST_DOCS = 400, 3.0, 4
TREES, DEPTH, RATE, BINS = 80, 3, 0.15, 32
CHUNK = 1 << 20  # text bytes worked on at once: the features hold some 40 bytes for each


def features(batches, lexicon: np.ndarray, odds: np.ndarray):
    """(slice of a record batch, features of its rows)"""
    for batch, data, off in chunks(batches, limit=CHUNK):
        yield batch, toxic_features(data, off, lexicon, odds, STRONG)


def lexicon_of(rows: DataFrame, size: int = LEXICON, least: int = LEAST_DOCS):
    """(sorted word hashes, log odds) of the words most typical of label 1; rows: (text, label)."""
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}

    def count(batches):
        for batch, data, off in chunks(batches, limit=CHUNK):
            starts, ends, b = words(data, off, ALNUM)
            h = word_hashes(data, starts, ends).view(np.int64)
            row = np.repeat(np.arange(len(b) - 1), np.diff(b))
            order = np.lexsort((row, h))
            h, row = h[order], row[order]
            new = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])) if len(h) else np.zeros(0, bool)
            h, bad = h[new], np.asarray(column(batch, "label"))[row[new]] == 1
            cut = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[cut]), pa.array(np.add.reduceat(bad.astype(np.int64), cut) if len(h) else cut),
                 pa.array(np.diff(np.append(cut, len(h))))], names=["term", "bad", "all"])

    seen = rows.mapInArrow(count, "term long, bad long, all long").groupBy("term").agg(
        F.sum("bad").alias("bad"), F.sum("all").alias("all")).filter(F.col("bad") >= least)
    odds = F.log((F.col("bad") + 0.5) / (n.get(1, 0) + 1)) - F.log((F.col("all") - F.col("bad") + 0.5) / (n.get(0, 0) + 1))
    top = (seen.withColumn("odds", odds).filter("odds > 1").orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "term")
           .limit(size).toPandas().sort_values("term", key=lambda s: s.to_numpy().view(np.uint64)))
    return top["term"].to_numpy(np.int64).view(np.uint64), top["odds"].to_numpy(float)


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE):
    """(edges, base, trees): each tree is complete, as arrays (feature, bin, leaf value)."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    b = _bins(x, edges)
    p = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    base = float(np.log(p / (1 - p)))
    f, out = np.full(len(y), base), []
    for _ in range(trees):
        q = 1 / (1 + np.exp(-f))
        g, h = y - q, q * (1 - q)
        node = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, BINS, np.int64)
        for d in range(depth):
            width, first = 2 ** d, 2 ** d - 1
            gain, best = np.zeros(width), [(0, BINS)] * width
            for j in range(x.shape[1]):
                cell = node * (BINS + 1) + b[:, j]
                gs = np.bincount(cell, g, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                hs = np.bincount(cell, h, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                up = gl ** 2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt ** 2 / (ht + 1)
                k = up.argmax(1)
                for i in range(width):
                    if up[i, k[i]] > gain[i] + 1e-9:
                        gain[i], best[i] = up[i, k[i]], (j, int(k[i]))
            for i, (j, k) in enumerate(best):
                feature[first + i], cut[first + i] = j, k
            node = node * 2 + (b[np.arange(len(y)), feature[first + node]] > cut[first + node])
        value = rate * np.bincount(node, g, 2 ** depth) / (np.bincount(node, h, 2 ** depth) + 1)
        out.append((feature, cut, value))
        f += value[node]
    return edges, base, out


def margin(model, x: np.ndarray) -> np.ndarray:
    edges, base, trees = model
    b, f, row = _bins(x, edges), np.full(len(x), base), np.arange(len(x))
    for feature, cut, value in trees:
        node = np.zeros(len(x), np.int64)
        depth = int(np.log2(len(value)))
        for d in range(depth):
            at = 2 ** d - 1 + node
            node = node * 2 + (b[row, feature[at]] > cut[at])
        f += value[node]
    return f


def isotonic(x: np.ndarray, y: np.ndarray):
    """Pool adjacent violators: (x, fitted y), to interpolate between."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum of y, n, sum of x
    for a, v in zip(x[order], y[order]):
        blocks.append([v, 1, a])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, n, t = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2] + t]
    s, n, t = (np.array(c) for c in zip(*blocks))
    return t / n, s / n


class Model:
    def __init__(self, lexicon, odds, trees, curve, prior):
        self.lexicon, self.odds, self.trees, self.curve, self.prior = lexicon, odds, trees, curve, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.prior)
        m = margin(self.trees, x)
        raw = 1 / (1 + np.exp(-m))
        # the calibrated step, with a little of the raw score so that ties are ordered
        return np.clip(0.98 * np.interp(m, *self.curve) + 0.02 * raw, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
        sample: int = SAMPLE, seed: int = 5) -> Model:
    ids = training_ids(labels, label, sample, doc_id)
    rows = one_text(docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text")).join(ids, "__id"), "label").select("text", "label")
    rows = written(rows, "toxicity-sample")
    lexicon, odds = lexicon_of(rows)

    def run(batches):
        for batch, x in features(batches, lexicon, odds):
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T), column(batch, "label")], names=[*TOXIC_FEATURES, "label"])

    got = rows.mapInArrow(run, ", ".join(f"{c} double" for c in TOXIC_FEATURES) + ", label int").toPandas()
    x, y = got[TOXIC_FEATURES].to_numpy(float), got["label"].to_numpy(float)
    if len(set(y)) < 2:
        return Model(lexicon, odds, None, None, float(y.mean()) if len(y) else 0.0)
    order = np.lexsort((y, *x.T))  # the rows come in any order; the split must not depend on it
    x, y = x[order], y[order]
    held = np.random.default_rng(seed).random(len(y)) < 0.25
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    trees = boost(x[~held], y[~held])
    rest = held if held.any() else ~held
    return Model(lexicon, odds, trees, isotonic(margin(trees, x[rest]), y[rest]), float(y.mean()))


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted)"""
    part = docs.select(F.col(doc_id).alias("id"), (fold(doc_id, 5) == 0).alias("held_out"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch, x in features(batches, m.lexicon, m.odds):
            s = m.score(x)
            yield pa.RecordBatch.from_arrays([column(batch, "id"), column(batch, "held_out"), pa.array(s),
                                              pa.array((s >= threshold).astype("int32"))], names=schema.names)

    return part.mapInArrow(run, schema)
