"""Quality rules with a linear-chain conditional random field over lines.

Base rules count over whole texts, in words ``[^\\x20\\x09-\\x0D]+``: characters in
words, symbols, repeated lines, and words in three-word windows found twice or
more. On top, every line with a word is labelled content or boilerplate by
Viterbi decoding; a document is kept if the base rules pass and content lines
hold at least ``share`` of its words.

Training: no line labels exist, so lines of a bounded sample of documents are
seeded by rules of thumb (symbol-ridden, shouted, piped, repeated or
self-repeating lines are boilerplate, whole sentences are content) and all
others are hidden: the fit maximises the likelihood of the seeds with hidden
labels summed out. At most ``sample`` documents (smallest text hashes) of at
most ``long`` lines are read; scores cover every row and whole texts.

Null, empty and blank texts have no words, fail the base rules and are not kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm._features import DIGIT, HIGH, LOWER, PUNCT, SYMBOL, UPPER, per_word
from ledgerlens.llm._spark import written
from ledgerlens.llm._text import NON_SPACE, chunks, column, mix, sums, windows, word_hashes, words

SAMPLE, LONG = 2_500, 128
CONTENT_SHARE = 0.5
_RULE = np.zeros(256, bool)
_RULE[list(b"#*$%&|<>")] = True
_START = (np.arange(256) & 0xC0) != 0x80  # first bytes of code points
_LINE = np.arange(256) != 0x0A

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["bias", "symbols", "pipes", "capitals", "digits", "short", "log_words", "ended", "starts_upper", "again_in_text",
            "repeats_itself", "symbol_words", "first", "last"]


def _repeated(key: np.ndarray) -> np.ndarray:
    """Which entries have a value found more than once; and which had it earlier."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = k[1:] == k[:-1]
    later, any_ = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = same
    any_[order[1:]] |= same
    any_[order[:-1]] |= same
    return any_, later


def _of_row(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    return mix(h ^ mix(row.astype(np.uint64) + np.uint64(1)))


class Lines:
    """Words, base counts and line features of a chunk."""

    def __init__(self, data, off):
        rows = len(off) - 1
        starts, ends, b = words(data, off, NON_SPACE)
        h = word_hashes(data, starts, ends, lower=False)
        n = np.diff(b)
        row = np.repeat(np.arange(rows), n)
        # words in three-word windows found twice or more in the text
        w, first, wrow = windows(h, b, 3)
        twice, again = _repeated(_of_row(w, wrow))
        repeat, more = np.zeros(len(h), bool), np.zeros(len(h), bool)
        for d in range(3):
            repeat[first[twice] + d] = True
            more[first[again] + d] = True
        # lines with a word
        ls, le, lb = words(data, off, _LINE)
        line = np.searchsorted(ls, starts, "right") - 1  # of each word
        used = np.unique(line)
        words_in = np.bincount(line, minlength=len(ls))[used] if len(ls) else np.zeros(0, np.int64)
        ls, le = ls[used], le[used]
        lrow = np.searchsorted(off, ls, "right") - 1 if len(ls) else ls
        self.bounds = np.searchsorted(lrow, np.arange(rows + 1))
        lh = word_hashes(data, ls, le, lower=False)
        some, later = _repeated(_of_row(lh, lrow))
        self.base = np.stack([n, sums(per_word(_START[data], starts, ends), b), sums(_RULE[data], off),
                              sums(later, self.bounds), sums(repeat, b)], axis=1)
        self.words = words_in
        at = np.append(0, np.cumsum(words_in))
        rate = lambda mask, of: per_word(mask[data], ls, le) / np.maximum(of, 1)
        size = le - ls
        letters = per_word((UPPER | LOWER | HIGH)[data], ls, le)
        last_byte = np.zeros(len(ls), np.uint8)
        if len(ls):
            last_byte = data[ends[at[1:] - 1] - 1]  # of its last word
        begin = data[starts[at[:-1]]] if len(ls) else last_byte
        x = np.zeros((len(ls), len(FEATURES)))
        x[:, 0] = 1
        x[:, 1] = np.minimum(rate(SYMBOL, size) * 10, 3)
        x[:, 2] = np.minimum(rate(np.arange(256) == 0x7C, words_in) * 3, 3)
        x[:, 3] = rate(UPPER, letters)
        x[:, 4] = rate(DIGIT, size)
        x[:, 5] = words_in < 4
        x[:, 6] = np.log1p(words_in) / 3
        x[:, 7] = PUNCT[last_byte] & (last_byte != 0x2C)
        x[:, 8] = UPPER[begin] | HIGH[begin]
        x[:, 9] = some
        x[:, 10] = (np.add.reduceat(more.astype(float), at[:-1]) if len(ls) else 0) / np.maximum(words_in, 1)
        x[:, 11] = (np.add.reduceat((per_word(SYMBOL[data], starts, ends) > 0).astype(float), at[:-1]) if len(ls) else 0) / np.maximum(words_in, 1)
        lines = np.diff(self.bounds)
        here = lines > 0
        x[self.bounds[:-1][here], 12] = 1
        x[self.bounds[1:][here] - 1, 13] = 1
        self.x = x
        boiler = (x[:, 1] > 0.8) | (x[:, 2] > 0.6) | ((x[:, 3] > 0.6) & (words_in > 2)) | (x[:, 10] > 0.5) | (some & (words_in < 6))
        content = ~boiler & (words_in >= 5) & (x[:, 7] > 0) & (x[:, 1] < 0.2) & (x[:, 3] < 0.3)
        self.seed = np.where(boiler, 1, np.where(content, 0, -1))  # -1: hidden


def _padded(bounds):
    """Line numbers of documents with lines, the longest document first, filled up with -1."""
    n = np.diff(bounds)
    order = np.argsort(-n, kind="stable")[:int((n > 0).sum())]
    t = np.arange(int(n.max()))
    return np.where(t[None, :] < n[order, None], bounds[:-1][order, None] + t[None, :], -1)


def _forward_backward(emit, trans, at):
    """Log-partition of each document, label and transition marginals; emit:
    lines x 2; at: the line numbers of documents, the longest first, else -1."""
    n = (at >= 0).sum(1)
    live = [int((n > t).sum()) for t in range(at.shape[1])]
    lse = np.logaddexp
    fwd, bwd, pairs = emit.copy(), np.zeros_like(emit), np.zeros((2, 2))
    for t in range(1, at.shape[1]):
        now, before = at[:live[t], t], at[:live[t], t - 1]
        m = fwd[before][:, :, None] + trans[None]
        fwd[now] = lse(m[:, 0], m[:, 1]) + emit[now]
    last = at[np.arange(len(n)), n - 1]
    z = lse(fwd[last, 0], fwd[last, 1])
    for t in range(at.shape[1] - 1, 0, -1):
        now, before = at[:live[t], t], at[:live[t], t - 1]
        m = trans[None] + (emit[now] + bwd[now])[:, None, :]
        bwd[before] = lse(m[:, :, 0], m[:, :, 1])
        pairs += np.exp(fwd[before][:, :, None] + m - z[:live[t], None, None]).sum(0)
    of_line = np.zeros(len(emit))
    for t in range(at.shape[1]):
        of_line[at[:live[t], t]] = z[:live[t]]
    return z, np.exp(fwd + bwd - of_line[:, None]), pairs


class Model:
    """weights: 2 x features of (content, boilerplate); trans: 2 x 2 scores of label pairs."""

    def __init__(self, weights, trans):
        self.weights, self.trans = weights, trans

    def decode(self, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Viterbi labels of all lines (1: boilerplate), all documents in step."""
        emit = x @ self.weights.T
        n = np.diff(bounds)
        out = np.zeros(len(x), np.int8)
        order = np.argsort(-n, kind="stable")
        first, count = bounds[:-1][order], n[order]
        back = np.zeros((len(x), 2), np.int8)
        live = int((count > 0).sum())
        score, t = emit[first[:live]], 1
        final = np.zeros(len(n), np.int8)
        while live:
            more = int((count[:live] > t).sum())
            final[more:live] = score[more:live].argmax(1)
            if not more:
                break
            m = score[:more, :, None] + self.trans[None]
            back[first[:more] + t] = m.argmax(1)
            score = np.concatenate([m.max(1) + emit[first[:more] + t], score[more:live]])
            live, t = more, t + 1
        live = int((count > 0).sum())
        state = final.copy()
        for t in range(int(count[0]) - 1 if len(count) else -1, -1, -1):
            on = int(np.searchsorted(-count, -t, "left"))  # documents with a line t
            at = first[:on] + t
            out[at] = state[:on]
            state[:on] = back[at, state[:on]]
        return out


def train(x, bounds, seed, rounds: int = 60) -> Model:
    """Adam on the likelihood of seeded labels, hidden ones summed out."""
    at = _padded(bounds) if len(x) else None
    w, trans = np.zeros((2, x.shape[1])), np.zeros((2, 2))
    w[0, 0] = 0.5
    if at is None:
        return Model(w, trans)
    clamp = np.zeros((len(x), 2))
    clamp[seed == 0, 1] = clamp[seed == 1, 0] = -30
    m, v, theta = 0.0, 0.0, np.concatenate([w.ravel(), trans.ravel()])
    for t in range(1, rounds + 1):
        w, trans = theta[:w.size].reshape(w.shape), theta[w.size:].reshape(2, 2)
        emit = x @ w.T
        _, free, free_pairs = _forward_backward(emit, trans, at)
        _, held, held_pairs = _forward_backward(emit + clamp, trans, at)
        g = np.concatenate([((held - free).T @ x).ravel(), (held_pairs - free_pairs).ravel()]) / len(x) - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Model(theta[:w.size].reshape(w.shape), theta[w.size:].reshape(2, 2))


def sample_lines(docs: DataFrame, text: str = "text", sample: int = SAMPLE, long: int = LONG) -> DataFrame:
    """(h, line, seed, features) of the lines of the sampled texts of at most ``long`` lines."""
    rows = (docs.select(F.col(text).alias("text")).filter(F.length("text") > 0)
            .select("text", F.xxhash64("text").alias("h")))
    chosen = written(rows.select("h").distinct().orderBy("h").limit(sample), "linecrf-sample")
    rows = rows.join(chosen, "h", "left_semi").dropDuplicates(["h"])

    def run(batches):
        for batch, data, off in chunks(batches):
            c = Lines(data, off)
            row = np.repeat(np.arange(len(off) - 1), np.diff(c.bounds))
            on = np.flatnonzero((np.diff(c.bounds) <= long)[row])
            line = on - c.bounds[:-1][row[on]]
            h = np.asarray(column(batch, "h"))[row[on]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(line), pa.array(c.seed[on], pa.int32()),
                 *(pa.array(f) for f in c.x[on].T)], names=["h", "line", "seed", *FEATURES])

    return rows.mapInArrow(run, "h long, line long, seed int, " + ", ".join(f"{c} double" for c in FEATURES))


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE, long: int = LONG) -> Model:
    got = sample_lines(docs, text, sample, long).toPandas().sort_values(["h", "line"])
    h = got["h"].to_numpy()
    cut = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, int)
    return train(got[FEATURES].to_numpy(float), np.append(cut, len(h)), got["seed"].to_numpy())


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", share: float = CONTENT_SHARE) -> DataFrame:
    """(doc_id, the base counts, base_failed, kept, content_share, n_boilerplate_lines)"""
    part = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType), *(T.StructField(c, T.LongType()) for c in BASE),
                           T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
                           T.StructField("content_share", T.DoubleType()), T.StructField("n_boilerplate_lines", T.LongType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch, data, off in chunks(batches):
            c = Lines(data, off)
            boiler = m.decode(c.x, c.bounds) == 1
            n, repeat = c.base[:, 0], c.base[:, 4]
            good = sums(np.where(boiler, 0, c.words), c.bounds) / np.maximum(n, 1)
            failed = (n < 50) | (100 * repeat > 50 * n)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "id"), *(pa.array(v, pa.int64()) for v in c.base.T), pa.array(failed),
                 pa.array(~failed & (good >= share)), pa.array(good, pa.float64()),
                 pa.array(sums(boiler, c.bounds), pa.int64())], names=schema.names)

    return part.mapInArrow(run, schema)
