"""Language ID by multilingual mixture inference.

Each language has a smoothed distribution over hashed byte trigrams, counted
over all training rows. A word's likelihood under a language is the product
over its letters of their trigrams; a document is a mixture of languages over
its words. Expectation-maximisation estimates the proportions; of the nested
language sets (by proportion) the one with the highest penalised likelihood is
selected: log-likelihood less ``penalty * |set| * log(words)``. Larger sets are
tried only while a bound of the likelihood over all mixtures lets them win.

Null or empty text, or a text without a letter: ``und``, score 0, no languages.
Without any training row every document is ``und``. Equal likelihoods: the
language that sorts first. Repeated rows each get a row. Training rows need a
non-null language. Other columns are ignored unless passed through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm._text import chunks, column, string_at

BUCKETS = 1 << 16
LANGUAGES = 200  # of a model
SLICE = 1 << 20  # bytes of text worked on at once
NUMBERS = 1 << 21  # likelihoods worked on at once
HELD = 1 << 24  # likelihoods held between rounds
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x61:0x7B] = _CLASS[0x41:0x5B] = np.arange(1, 27)
_CLASS[0x80:] = np.arange(27, 155)
UND = "und"


def _grams(data: np.ndarray, off: np.ndarray):
    """Trigram buckets of all letters: (positions of letters, buckets)."""
    cls = _CLASS[data].astype(np.uint32)
    full = off[:-1] < off[1:]
    before = np.zeros_like(cls)
    before[1:] = cls[:-1]
    before[off[:-1][full]] = 0
    after = np.zeros_like(cls)
    after[:-1] = cls[1:]
    after[off[1:][full] - 1] = 0
    at = np.flatnonzero(cls)
    code = ((before << np.uint32(16)) | (cls << np.uint32(8)) | after)[at]
    return at, before[at] == 0, (code * np.uint32(2654435761)) >> np.uint32(16)


def languages(rows: DataFrame, lang: str = "lang", most: int = LANGUAGES) -> list[str]:
    """The ``most`` languages with the most rows (ties: those that sort first), sorted."""
    n = rows.filter(F.col(lang).isNotNull()).groupBy(F.col(lang).alias("lang")).count()
    return sorted(r["lang"] for r in n.orderBy(F.desc("count"), "lang").limit(most).collect())


def count_grams(rows: DataFrame, names: list[str], text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang: place in ``names``, bucket, n) over all rows of these languages; one
    pre-aggregated row a task, language and bucket reaches the shuffle."""
    rows = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter(F.col("lang").isin(names))

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch, data, off in chunks(batches, limit=SLICE):
            at, _, g = _grams(data, off)
            codes = column(batch, "lang").dictionary_encode()
            own = codes.indices.to_numpy(zero_copy_only=False)[np.searchsorted(off, at, "right") - 1]
            for i, name in enumerate(codes.dictionary.to_pylist()):
                total[name] = total.get(name, 0) + np.bincount(g[own == i], minlength=BUCKETS)
        for name, n in total.items():
            b = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(b), names.index(name)), pa.int32()), pa.array(b, pa.int32()), pa.array(n[b], pa.int64())],
                names=["lang", "bucket", "n"])

    return rows.mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Log-probabilities, one row a language; at most languages * 65,536 numbers."""

    def __init__(self, langs: list[str], logp: np.ndarray):
        self.langs, self.logp = langs, logp


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", alpha: float = 0.5, most: int = LANGUAGES) -> Model:
    """The model of the ``most`` languages with the most training rows: a bound of
    its size (256 KB a language), so that a dirty column can't fill the driver."""
    names = languages(rows, lang, most)
    n = np.zeros((len(names), BUCKETS))
    if names:
        got = count_grams(rows, names, text, lang).toArrow()
        n[got["lang"].to_numpy(), got["bucket"].to_numpy()] = got["n"].to_numpy()
    logp = np.empty(n.shape, np.float32)
    for i, row in enumerate(n):
        logp[i] = np.log((row + alpha) / (row.sum() + alpha * BUCKETS))
    return Model(names, logp)


def _cuts(data: np.ndarray, off: np.ndarray, limit: int):
    """Byte ranges of about ``limit`` bytes that split no word."""
    a = 0
    while a < len(data):
        b = a + limit
        if b < len(data):
            end = int(off[np.searchsorted(off, b)])  # the next row
            while b < end:
                gap = np.flatnonzero(_CLASS[data[b:min(b + 4096, end)]] == 0)
                if len(gap):
                    end = b + int(gap[0])
                b = min(b + 4096, end)
        else:
            b = len(data)
        yield a, b
        a = b


def _likelihoods(model: Model, data: np.ndarray, off: np.ndarray):
    """By slices of whole words, at most NUMBERS likelihoods each unless a word is
    longer: (log-likelihoods, languages x words; the rows with words here; where
    their words start)."""
    k = len(model.langs)
    for a, b in _cuts(data, off, min(SLICE, max(1 << 12, 2 * NUMBERS // k))):
        inside = off[np.searchsorted(off, a, "right"):np.searchsorted(off, b)]
        at, head, g = _grams(data[a:b], np.concatenate([[0], inside - a, [b - a]]))
        if not len(at):
            continue
        first = np.flatnonzero(head)  # words, by their first letter
        ll = np.stack([np.add.reduceat(model.logp[i][g], first, dtype=np.float64) for i in range(k)])
        rows, start = np.unique(np.searchsorted(off, at[first] + a, "right") - 1, return_index=True)
        yield ll, rows, start


class _Words:
    """Likelihoods of rows' words under each row's ``langs`` (set size x rows),
    relative to each word's best, whose log is ``top``; held if they are at most
    HELD (``n``: words a row), else found again each time they are read."""

    def __init__(self, model: Model, data: np.ndarray, off: np.ndarray, n: np.ndarray, langs: np.ndarray):
        some = np.unique(langs)
        self.source = Model([model.langs[i] for i in some], model.logp[some]), data, off
        self.langs, self.n = np.searchsorted(some, langs), n
        self.held = list(self._read()) if n.sum() * len(langs) <= HELD else None

    def _read(self):
        every = len(self.langs) == len(self.source[0].langs)
        for ll, rows, start in _likelihoods(*self.source):
            size = np.diff(np.append(start, ll.shape[1]))
            if not every:
                ll = ll[self.langs[:, np.repeat(rows, size)], np.arange(ll.shape[1])]
            top = ll.max(0)
            yield np.exp(ll - top), top, rows, start, size

    def em(self, rounds: int):
        """EM from equal shares: (proportions, log-likelihood, a bound of it over
        all proportions).

        With D the mean of a language's likelihood over the mixture's, a round
        multiplies its share by D, and by Jensen's inequality no proportions have a
        log-likelihood above the present one plus n * log(max D)."""
        share = np.full(self.langs.shape, 1 / len(self.langs))
        for last in [False] * rounds + [True]:
            ratio, total = np.zeros(share.shape), np.zeros(len(self.n))
            for like, top, rows, start, size in self._read() if self.held is None else self.held:
                if len(rows) == 1:
                    mixed = np.maximum(share[:, rows[0]] @ like, 1e-300)
                    ratio[:, rows[0]] += like @ (1 / mixed)
                else:
                    mixed = np.maximum((like * np.repeat(share[:, rows], size, axis=1)).sum(0), 1e-300)
                    ratio[:, rows] += np.add.reduceat(like / mixed, start, axis=1)
                if last:
                    total[rows] += np.add.reduceat(np.log(mixed) + top, start)
            ratio /= self.n
            if last:
                return share, total, total + self.n * np.log(np.maximum(ratio.max(0), 1))
            share = share * ratio


def _mixtures(model: Model, data, off, n, value, penalty: float, rounds: int):
    """(better value or the same, proportions or zeros) of rows with words."""
    k, rows = len(model.langs), len(n)
    chosen = np.zeros((k, rows))
    full, _, most = _Words(model, data, off, n, np.repeat(np.arange(k)[:, None], rows, axis=1)).em(rounds)
    order = np.argsort(-full, axis=0, kind="stable")
    left = np.arange(rows)  # rows whose larger sets may yet be better
    for size in range(2, k + 1):
        left = left[most[left] + 1e-6 - size * penalty * np.log(n[left] + 1) > value[left]]
        if not len(left):
            break
        pick = np.sort(order[:size, left], axis=0)
        share, total, _ = _Words(model, *_some_rows(data, off, left), n[left], pick).em(rounds)
        worth = total - size * penalty * np.log(n[left] + 1)
        won = worth > value[left]
        value[left[won]] = worth[won]
        chosen[:, left[won]] = 0
        chosen[pick[:, won], left[won]] = share[:, won]
    return value, chosen


def _some_rows(data, off, rows):
    parts = [data[off[r]:off[r + 1]] for r in rows]
    return np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))


def infer(model: Model, data: np.ndarray, off: np.ndarray, penalty: float = 1.0, rounds: int = 10):
    """Per row: (index of the language or -1, score, proportions of the selected set).

    Words are read in slices; besides the slice, memory holds languages x rows
    numbers and, for mixtures, at most HELD likelihoods."""
    rows, k = len(off) - 1, len(model.langs)
    lang, score, shares = np.full(rows, -1), np.zeros(rows), np.zeros((k, rows))
    if not k or not len(data):
        return lang, score, shares
    one, top, n = np.zeros((k, rows)), np.zeros(rows), np.zeros(rows, np.int64)
    for ll, r, start in _likelihoods(model, data, off):
        one[:, r] += np.add.reduceat(ll, start, axis=1)  # of single languages
        top[r] += np.add.reduceat(ll.max(0), start)
        n[r] += np.diff(np.append(start, ll.shape[1]))
    there = np.flatnonzero(n)  # rows with words
    there = there[[_has_letter(data, off[r], off[r + 1]) for r in there]] if len(there) else there
    one, top, n = one[:, there], top[there], n[there]
    best = one.argmax(0) if len(there) else there
    value = one.max(0) - penalty * np.log(n + 1)
    chosen = np.eye(k)[best].T
    # no mixture is likelier than the best language of each word
    open_ = np.flatnonzero(top - 2 * penalty * np.log(n + 1) > value) if k > 1 else there[:0]
    a = 0
    while a < len(open_):
        b = a + max(1, int(np.searchsorted(np.cumsum(n[open_[a:]]), HELD // k, "right")))
        some = open_[a:b]
        better, found = _mixtures(model, *_some_rows(data, off, there[some]), n[some], value[some], penalty, rounds)
        mixed = better > value[some]
        value[some] = better
        chosen[:, some[mixed]] = found[:, mixed]
        a = b
    lead = chosen.argmax(0)
    # share of the language, times its posterior against the other single languages
    post = 1 / np.exp(np.minimum(one - one.max(0), 0)).sum(0)
    lang[there] = lead
    score[there] = np.clip(np.where(chosen.max(0) < 1, chosen.max(0), post), 0, 1)
    shares[:, there] = chosen
    return lang, score, shares


def _has_letter(data, a, b) -> bool:
    seg = data[a:b]
    c = _CLASS[seg]
    return bool(((c > 0) & (c < 27)).any()) or any(ch.isalpha() for ch in string_at(data, a, b))


def predict(docs: DataFrame, model: Model, text: str = "text", through: list[str] | None = None,
            penalty: float = 1.0) -> DataFrame:
    """``through`` columns (default: all) with lang_pred, score, langs, shares.
    A column of one of these names is replaced."""
    new = ["lang_pred", "score", "langs", "shares"]
    through = [c for c in (docs.columns if through is None else through) if c not in new]
    part = docs.select(*[F.col(c) for c in through], F.col(text).alias("__text"))
    schema = T.StructType([*(part.schema[c] for c in through),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("langs", T.ArrayType(T.StringType())),
                           T.StructField("shares", T.ArrayType(T.DoubleType()))])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch, data, off in chunks(batches, "__text"):
            lang, score, shares = infer(m, data, off, penalty)
            sets = [sorted(((float(s[i]), m.langs[i]) for i in np.flatnonzero(s)), key=lambda x: (-x[0], x[1]))
                    for s in shares.T]
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, c) for c in through),
                 pa.array([m.langs[i] if i >= 0 else UND for i in lang], pa.string()), pa.array(score, pa.float64()),
                 pa.array([[x for _, x in s] for s in sets], pa.list_(pa.string())),
                 pa.array([[x for x, _ in s] for s in sets], pa.list_(pa.float64()))],
                names=[*through, *new])

    return part.mapInArrow(run, schema)
