"""Quality by positive-unlabelled learning with the non-negative unbiased risk.

Trusted positives are documents labelled 1; everything else, labelled 0 or not
at all, is unlabelled web text, and no negative label is ever read. The class
prior is estimated from the two samples alone: with scores that tell positives
from unlabelled text, the share of unlabelled text above a threshold over the
share of positives above it is an upper bound of the prior; its minimum over
thresholds, each with its sampling error added, is the estimate. A network of
one hidden layer then minimises  prior * R+(P) + max(0, R-(U) - prior * R-(P)).

The fit reads at most ``positives`` and ``unlabelled`` documents outside the
held-out fold (those of the smallest hashes); scores cover every row and whole
texts. Null and empty texts are scored as texts without words. Without a
positive every score is 0; without unlabelled text every score is 1. Repeated
rows each get a score; a repeated id is learned from once, by its text of the
smallest hash. Of an empty table the result is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm._features import QUALITY_FEATURES, quality_features
from ledgerlens.llm._spark import fold, written
from ledgerlens.llm._text import chunks, column
from ledgerlens.llm._train import by_hash, one_text, training_ids

POSITIVES, UNLABELLED = 6_000, 12_000
HIDDEN, EPOCHS, BATCH, STEP = 24, 60, 512, 0.01


class Net:
    """Standardised features, one hidden layer of tanh units, one output."""

    def __init__(self, x: np.ndarray, rng):
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        self.w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        self.m, self.v, self.t = [0.0] * 4, [0.0] * 4, 0

    def scaled(self, x):
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def out(self, z):
        return np.tanh(z @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3][0]

    def learn(self, z, slope, step):
        """One Adam step against the slope of the loss in each output."""
        a = np.tanh(z @ self.w[0] + self.w[1])
        back = np.outer(slope, self.w[2]) * (1 - a * a)
        grads = [z.T @ back, back.sum(0), a.T @ slope, np.array([slope.sum()])]
        self.t += 1
        for i, g in enumerate(grads):
            g = g + 1e-4 * self.w[i]
            self.m[i] = 0.9 * self.m[i] + 0.1 * g
            self.v[i] = 0.999 * self.v[i] + 0.001 * g * g
            self.w[i] = self.w[i] - step * (self.m[i] / (1 - 0.9 ** self.t)) / (np.sqrt(self.v[i] / (1 - 0.999 ** self.t)) + 1e-8)


def _sigmoid(f):
    return 1 / (1 + np.exp(-np.clip(f, -30, 30)))


def train(p: np.ndarray, u: np.ndarray, prior: float | None, seed: int, epochs: int = EPOCHS) -> Net:
    """With a prior: the non-negative risk; without: plain positives against unlabelled text."""
    rng = np.random.default_rng(seed)
    net = Net(np.concatenate([p, u]), rng)
    zp, zu = net.scaled(p), net.scaled(u)
    for epoch in range(epochs):
        step = STEP * (0.5 if epoch > epochs * 0.6 else 1)
        ip, iu = rng.permutation(len(zp)), rng.permutation(len(zu))
        parts = max(1, len(zu) // BATCH)
        for a, b in zip(np.array_split(ip, parts), np.array_split(iu, parts)):
            if not len(a) or not len(b):
                continue
            sp, su = _sigmoid(net.out(zp[a])), _sigmoid(net.out(zu[b]))
            z = np.concatenate([zp[a], zu[b]])
            if prior is None:
                slope = np.concatenate([(sp - 1) / len(a), su / len(b)])
            else:
                # logistic losses: log(1 + e^-f) and log(1 + e^f)
                rest = np.mean(-np.log(1 - su + 1e-12)) - prior * np.mean(-np.log(1 - sp + 1e-12))
                if rest >= 0:
                    slope = np.concatenate([prior * (sp - 1) / len(a) - prior * sp / len(a), su / len(b)])
                else:  # the risk of negatives went below zero: step back from it
                    slope = np.concatenate([prior * sp / len(a), -su / len(b)])
            net.learn(z, slope, step)
    return net


def estimate_prior(p: np.ndarray, u: np.ndarray, seed: int) -> float:
    """Best-bin estimate on halves that the scoring network has not seen."""
    net = train(p[::2], u[::2], None, seed, epochs=20)
    sp, su = np.sort(net.out(net.scaled(p[1::2]))), np.sort(net.out(net.scaled(u[1::2])))
    if not len(sp) or not len(su):
        return 0.5
    at = np.quantile(sp, np.linspace(0, 0.95, 96))
    share_p = 1 - np.searchsorted(sp, at, "left") / len(sp)
    share_u = 1 - np.searchsorted(su, at, "left") / len(su)
    error = np.sqrt(np.log(40) / (2 * len(su))) + np.sqrt(np.log(40) / (2 * len(sp)))
    k = int(np.argmin((share_u + error) / np.maximum(share_p, 1e-9)))
    return float(np.clip(share_u[k] / max(share_p[k], 1e-9), 0.01, 0.99))


class Model:
    def __init__(self, net: Net | None, prior: float):
        self.net, self.prior = net, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.net.out(self.net.scaled(x))) if self.net else np.full(len(x), self.prior)


def _with_features(rows: DataFrame, keep: list[str]) -> DataFrame:
    schema = T.StructType([*(rows.schema[c] for c in keep), *(T.StructField(c, T.DoubleType()) for c in QUALITY_FEATURES)])

    def run(batches):
        for batch, data, off in chunks(batches):
            x = quality_features(data, off)
            yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in keep), *(pa.array(c) for c in x.T)], names=schema.names)

    return rows.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
        positives: int = POSITIVES, unlabelled: int = UNLABELLED, seed: int = 11) -> Model:
    trusted = labels.filter(F.col(label) == 1)
    ids = training_ids(trusted, label, positives, doc_id).select("__id").withColumn("p", F.lit(1))
    web = docs.select(F.col(doc_id).alias("__id")).filter(fold("__id", 5) != 0)
    some = written(by_hash(web.distinct(), F.col("__id"), unlabelled), "quality-web").withColumn("u", F.lit(1))
    chosen = written(ids.join(some, "__id", "full"), "quality-sample")
    rows = one_text(docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text")).join(chosen, "__id"), "p", "u")
    got = _with_features(rows, ["p", "u"]).toPandas()
    x = got[QUALITY_FEATURES].to_numpy(float)
    order = np.lexsort(x.T)  # the rows come in any order
    x, p, u = x[order], got["p"].to_numpy()[order] == 1, got["u"].to_numpy()[order] == 1
    if not p.any() or not u.any():
        return Model(None, float(p.any()))
    rng = np.random.default_rng(seed)
    xp, xu = x[p][rng.permutation(p.sum())], x[u][rng.permutation(u.sum())]
    prior = estimate_prior(xp, xu, seed)
    return Model(train(xp, xu, prior, seed + 1), prior)


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted)"""
    part = docs.select(F.col(doc_id).alias("id"), (fold(doc_id, 5) == 0).alias("held_out"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch, data, off in chunks(batches):
            s = m.score(quality_features(data, off))
            yield pa.RecordBatch.from_arrays([column(batch, "id"), column(batch, "held_out"), pa.array(s),
                                              pa.array((s >= threshold).astype("int32"))], names=schema.names)

    return part.mapInArrow(run, schema)
