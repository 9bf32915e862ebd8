"""Personal data by a semi-Markov conditional random field over whole spans.

Base spans are patterns with checks (e-mail, IPv4, card by Luhn, phone by digit
count), leftmost and non-overlapping for each kind, found in time linear in the
text. The field then scores candidate segments - up to ``LONGEST`` pieces of
text, a piece being a run of letters and digits, a sign or blank space - by
features of the whole span (digits, groups, checksums, shape, the words before)
for each kind, and a dynamic program over segments of bounded length chooses
boundaries and kinds of a passage jointly. Its kinds are those of the base and
``secret`` (keys, tokens, passwords). A segment it finds is added unless it
overlaps a base span; base spans always stay.

Training: spans by pattern, and keys after a telling word, of a bounded sample
of documents (``SAMPLE``, smallest text hashes; ``PASSAGES`` passages, at most
``PER_TEXT`` of a text and ``TRAINED`` characters each) are the labels; the likelihood of whole segmentations is maximised.

Offsets are code points, ends exclusive. Null and empty texts have no spans.
Repeated rows each get a row. Bytes that aren't UTF-8 count as one replacement
character each run. Of an empty table the result is empty.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import itertools
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm._spark import written
from ledgerlens.llm._text import chunks, column, string_at, sums

KINDS = ["email", "ip", "card", "phone"]
ALL_KINDS = [*KINDS, "secret"]
ORDER = {k: i for i, k in enumerate(ALL_KINDS)}
SAMPLE, PASSAGES, EPOCHS = 3_000, 1_200, 12
TRAINED, PER_TEXT = 2_000, 8  # characters of a passage learned from; passages of a text
LONGEST = 16  # pieces of a segment
BLOCK = 2_048  # first pieces whose segments are scored at once
GROUP = 1 << 16  # characters of the passages taken together

_ANCHOR = np.zeros(256, bool)
_ANCHOR[0x30:0x3A] = True
_ANCHOR[0x40] = True

_RUN = re.compile(r"\+?[0-9][0-9\x20().+\-]*")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if i % 2 == 0 else v * 2 - 9 * (v > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), sorted by start, then kind."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for run in _RUN.finditer(text):
        a, b = run.span()
        if b - a < 7:
            continue
        for m in _IP.finditer(text, a, b):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((*m.span(), "ip"))
        for m in _CARD.finditer(text, a, b):
            digits = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((*m.span(), "card"))
        for m in _PHONE.finditer(text, a, b):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], ORDER[s[2]]))


# Passages and their segments

_TOKEN = re.compile(r"\S+")
_HAS = re.compile(r"[0-9@]")
_SECRET_CUE = re.compile(r"(?i)(?:token|passw|pwd|secret|key|api|auth|bearer)")
_PHONE_CUE = re.compile(r"(?i)(?:tel|phone|call|mobile|fax)")
_SEED = re.compile(r"AKIA[0-9A-Z]{12,32}|(?i:token|password|passwd|secret|api_?key)\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9]{12,128})")


def passages(text: str):
    """(start, end, text before) of runs of tokens that hold a digit or '@'."""
    start = end = None
    before: list[str] = []
    cue = ""
    for m in _TOKEN.finditer(text):
        if _HAS.search(m[0]):
            if start is None:
                start, cue = m.start(), " ".join(before[-2:])
            end = m.end()
        else:
            if start is not None:
                yield start, end, cue
                start = None
        before.append(m[0][-40:])
        del before[:-2]
    if start is not None:
        yield start, end, cue


NAMES = ["bias", "at", "at_and_dot", "plus", "few_digits", "some_digits", "phone_digits", "card_digits", "many_digits", "luhn",
         "quad", "letters", "long_mixed", "hex", "blank", "signs", "secret_cue", "phone_cue", "cut_left", "cut_right",
         "length", "all_digits", "odd_sign"]


_CUE = {"secret": re.compile(f"(?=({_SECRET_CUE.pattern[4:]}))", re.I), "phone": re.compile(f"(?=({_PHONE_CUE.pattern[4:]}))", re.I)}
_FLAGS = {"digit": str.isdigit, "alpha": str.isalpha, "alnum": str.isalnum, "space": str.isspace, "at": "@".__eq__, "dot": ".".__eq__,
          "hex": set("0123456789abcdefABCDEF").__contains__, "odd": set("\"'=:;,/|").__contains__, "edge": set(".-+@_%").__contains__}
_ASCII = {name: np.array([test(chr(c)) for c in range(128)]) for name, test in _FLAGS.items()}


def _flag(codes: np.ndarray, name: str) -> np.ndarray:
    """Which characters are so; digits are 0-9 alone."""
    out = _ASCII[name][np.minimum(codes, 127)]
    wide = np.flatnonzero(codes > 127)
    if len(wide):
        some, at = np.unique(codes[wide], return_inverse=True)
        out[wide] = (np.array([_FLAGS[name](chr(c)) for c in some]) & (name != "digit"))[at]
    return out


class Pieces:
    """The pieces of some passages of a text, one after another: where each starts
    in ``codes`` (their characters), and what is asked of single pieces."""

    def __init__(self, text: str, found: list[tuple[int, int, str]]):
        parts = [text[a:b] for a, b, _ in found]
        joined = "".join(parts)
        self.codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.edge = np.cumsum([0, *map(len, parts)])  # of passages
        self.shift = np.array([a for a, _, _ in found]) - self.edge[:-1]
        word = _flag(self.codes, "alnum") & (self.codes < 128)
        kind = word + 2 * _flag(self.codes, "space").astype(np.uint8)
        cut = np.append(True, (kind[1:] != kind[:-1]) | (kind[1:] == 0))
        cut[self.edge[:-1]] = True
        self.start = np.append(np.flatnonzero(cut), len(self.codes))
        here = self.start[:-1]
        self.word = word[here]
        self.opens = self.word | np.isin(self.codes[here], [ord("+"), ord("(")])
        #: Whether a telling word stands in the words before a passage or the 40 characters before a piece.
        self.cue = {}
        for name, pattern in _CUE.items():
            spans = np.array([m.span(1) for m in pattern.finditer(joined)], np.int64).reshape(-1, 2)
            spans = spans[np.argsort(spans[:, 1], kind="stable")]
            latest = np.append(-1, np.maximum.accumulate(spans[:, 0]))
            near = latest[np.searchsorted(spans[:, 1], here, "right")]
            told = np.array([bool(pattern.search(c)) for _, _, c in found])
            of = self.passage(np.arange(len(here)))
            self.cue[name] = told[of] | (near >= np.maximum(self.edge[of], here - 40))

    def __len__(self):
        return len(self.start) - 1

    def passage(self, piece):
        return np.searchsorted(self.edge, self.start[piece], "right") - 1

    def segments(self, lo: int = 0, hi: int | None = None):
        """(first piece, last piece, features) of the segments that start at the
        pieces lo to hi, ordered by their first, then last piece."""
        hi = len(self) if hi is None else min(hi, len(self))
        end = min(hi + LONGEST, len(self))
        bound = self.start[lo:end + 1] - self.start[lo]
        codes = self.codes[self.start[lo]:self.start[end]]
        flag = {n: _flag(codes, n) for n in _FLAGS}
        total = {n: np.append(0, np.cumsum(np.add.reduceat(f, bound[:-1], dtype=np.int64))) for n, f in flag.items()}
        of = self.passage(np.arange(lo, end))
        last = np.searchsorted(self.start, self.edge[1:])[of[:hi - lo]] - lo  # one after the passage's last piece
        first = np.arange(hi - lo)
        to = first[:, None] + np.arange(LONGEST)
        ok = (to < last[:, None]) & self.opens[lo:hi, None] & self.word[lo:end][np.minimum(to, end - lo - 1)]
        i, step = np.nonzero(ok)
        j = i + step  # numbers of pieces from lo on
        count = {n: t[j + 1] - t[i] for n, t in total.items()}
        some = count["digit"] + count["at"] > 0
        i, j, count = i[some], j[some], {n: c[some] for n, c in count.items()}
        if not len(i):
            return i, j, np.zeros((0, len(NAMES)))
        n, letters, size = count["digit"], count["alpha"], bound[j + 1] - bound[i]
        plain = count["alnum"] == size
        one = count["at"] == 1
        at = np.append(np.flatnonzero(np.diff(total["at"])), end - lo)
        at = np.minimum(at[np.searchsorted(at, i)], j)  # the first @
        # pieces of an address: up to three digits of at most 255, and dots between
        width, place = np.diff(bound), bound[:-1]
        value = np.where(flag["digit"], codes, 48).astype(np.int64) - 48
        number = sum(np.where(width > d, value[np.minimum(place + d, len(codes) - 1)] * 10 ** np.clip(width - 1 - d, 0, 2), 0) for d in range(3))
        octet = (width <= 3) & (np.diff(total["digit"]) == width) & (number <= 255)
        quad = j - i == 6
        for d in range(7):
            quad &= (codes[place] == ord(".") if d % 2 else octet)[np.minimum(i + d, end - lo - 1)]
        left = codes[np.maximum(bound[i] - 1, 0)] if not lo else self.codes[self.start[lo] + bound[i] - 1]
        right = self.codes[np.minimum(self.start[lo] + bound[j + 1], len(self.codes) - 1)]
        inner_left = self.start[lo] + bound[i] > self.edge[of[i]]
        inner_right = self.start[lo] + bound[j + 1] < self.edge[of[i] + 1]
        card = (n >= 12) & (n <= 19)
        feats = [np.ones(len(i)), one, one & (total["dot"][j + 1] > total["dot"][at]), codes[bound[i]] == ord("+"), n < 7, (n >= 7) & (n < 9),
                 (n >= 9) & (n <= 15), card, n > 19, _luhn_of(codes, flag["digit"], bound, total["digit"], i, j, card & (letters == 0)),
                 quad, letters > 0, plain & (letters > 0) & (n > 0) & (size >= 16), plain & (size >= 16) & (count["hex"] == size),
                 count["space"] > 0, np.minimum(size - n - letters, 6) / 6, self.cue["secret"][lo:hi][i], self.cue["phone"][lo:hi][i],
                 inner_left & (_flag(left, "alnum") | _flag(left, "edge")), inner_right & (_flag(right, "alnum") | (right == ord("@"))),
                 np.minimum(size, 60) / 20, n == size, count["odd"] > 0]
        return i + lo, j + lo, np.stack(feats, axis=1).astype(float)


def _luhn_of(codes, digit, bound, total, i, j, ask):
    """Whether the digits of the segments that are asked for pass the check."""
    out = np.zeros(len(i), bool)
    ask = np.flatnonzero(ask)
    if not len(ask):
        return out
    at = np.flatnonzero(digit)
    place = total[j[ask] + 1][:, None] - 1 - np.arange(19)  # from the right
    there = place >= total[i[ask]][:, None]
    v = np.where(there, codes[at[np.maximum(place, 0)]].astype(np.int64) - 48, 0)
    v[:, 1::2] = v[:, 1::2] * 2 - 9 * (v[:, 1::2] > 4)
    out[ask] = v.sum(1) % 10 == 0
    return out


def _lattice(size, found):
    """Segments by the piece they end at."""
    by_end: list[list[int]] = [[] for _ in range(size + 1)]
    for k, (_, j) in enumerate(found):
        by_end[j].append(k)
    return by_end


def decode(weights: np.ndarray, pieces: Pieces) -> list[tuple[int, int, int]]:
    """The best segmentation: (first piece, end piece, kind); a piece in no segment
    scores 0, so a segment that scores no more is never in it. Features are held
    for BLOCK first pieces at once."""
    parts = []
    for lo in range(0, len(pieces), BLOCK):
        i, j, feats = pieces.segments(lo, lo + BLOCK)
        if len(i):
            # steps of 2**-20 add up exactly: ties don't hang on the order of additions
            score = np.rint(feats @ weights.T * 2 ** 20) / 2 ** 20
            top = score.max(1)
            good = np.flatnonzero(top > 0)
            parts.append((j[good] + 1, i[good], top[good], score[good].argmax(1).astype(np.int8)))
    if not parts:
        return []
    cols = [np.concatenate(c) for c in zip(*parts)]
    order = np.lexsort((cols[1], cols[0]))
    # the best score changes at the ends of segments only: its end, value, and the segment's
    # start, kind and the entry before it
    ends, best, starts, kinds, befores = array("q", [0]), array("d", [0]), array("q", [-1]), array("b", [-1]), array("q", [-1])
    for lo in range(0, len(order), 1 << 16):
        for end, start, top, kind in zip(*(c[order[lo:lo + (1 << 16)]].tolist() for c in cols)):
            before = bisect.bisect_right(ends, start) - 1
            v = best[before] + top
            if v > best[-1]:
                if ends[-1] == end:
                    best[-1], starts[-1], kinds[-1], befores[-1] = v, start, kind, before
                else:
                    for to, x in ((ends, end), (best, v), (starts, start), (kinds, kind), (befores, before)):
                        to.append(x)
    out, at = [], len(ends) - 1
    while at:
        out.append((starts[at], ends[at], kinds[at]))
        at = befores[at]
    return out[::-1]


def _expected(weights, size, found, feats):
    """Marginals of (segment, kind) under the model."""
    score = feats @ weights.T
    total = np.logaddexp.reduce(score, axis=1)
    by_end = _lattice(size, found)
    a, b = np.zeros(size + 1), np.zeros(size + 1)
    for j in range(1, size + 1):
        a[j] = np.logaddexp.reduce([a[j - 1], *(a[found[k][0]] + total[k] for k in by_end[j])])
    by_start: list[list[int]] = [[] for _ in range(size + 1)]
    for k, (i, _) in enumerate(found):
        by_start[i].append(k)
    for i in range(size - 1, -1, -1):
        b[i] = np.logaddexp.reduce([b[i + 1], *(b[found[k][1]] + total[k] for k in by_start[i])])
    i, j = np.array(found).T
    return np.exp(a[i, None] + score + b[j, None] - a[size])


def labelled(text: str):
    """Spans to learn from: base spans, then seeds of secrets, none overlapping another."""
    spans = [s for s in base_spans(text)]
    spans += [(m.start(1) if m[1] else m.start(), m.end(1) if m[1] else m.end(), "secret") for m in _SEED.finditer(text)]
    out: list[tuple[int, int, str]] = []
    for s in sorted(spans, key=lambda x: (ORDER[x[2]], x[0])):
        if all(s[1] <= a or b <= s[0] for a, b, _ in out):
            out.append(s)
    return out


def train(texts: list[str], at_most: int = PASSAGES, epochs: int = EPOCHS) -> np.ndarray:
    """Weights, kinds x features, by stochastic gradient steps on the log-likelihood."""
    data = []
    for text in texts:
        gold = {(a, b): ORDER[k] for a, b, k in labelled(text)}
        for found in passages(text):
            if len(data) >= at_most or found[1] - found[0] > TRAINED:
                continue
            pieces = Pieces(text, [found])
            i, j, feats = pieces.segments()
            if not len(i):
                continue
            target = np.zeros((len(i), len(ALL_KINDS)))
            shift = int(pieces.shift[0])
            for k, span in enumerate(zip((pieces.start[i] + shift).tolist(), (pieces.start[j + 1] + shift).tolist())):
                if span in gold:
                    target[k, gold[span]] = 1
            data.append((len(pieces), list(zip(i.tolist(), (j + 1).tolist())), feats, target))
    w = np.zeros((len(ALL_KINDS), len(NAMES)))
    w[:, 0] = -1
    memory = np.full_like(w, 1e-6)
    for _ in range(epochs):
        for size, found, feats, target in data:
            g = (target - _expected(w, size, found, feats)).T @ feats - 1e-3 * w / max(1, len(data)) * 10
            memory += g * g
            w = w + 0.3 * g / np.sqrt(memory)
    return w


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> np.ndarray:
    rows = docs.select(F.col(text).alias("text")).filter(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("h"))
    chosen = written(rows.select("h").distinct().orderBy("h").limit(sample), "pii-sample")

    def cut(batches):  # only what the fit reads: some short passages a text, with a little text before them
        for batch in batches:
            out = []
            for h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                short = ((zlib.crc32(f"{h}:{a}".encode()), a, b) for a, b, _ in passages(t) if b - a <= TRAINED)
                out += [(key, h, a, t[max(0, a - 60):b]) for key, a, b in heapq.nsmallest(PER_TEXT, short)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["key", "h", "at", "text"])

    # the rows of the sample are few, but many documents may have one text
    texts = rows.join(chosen, "h", "left_semi").dropDuplicates(["h"]).select("h", "text").mapInArrow(
        cut, "key long, h long, at long, text string")
    got = texts.orderBy("key", "h", "at").limit(PASSAGES).collect()
    return train([r["text"] for r in got])


def _grouped(text: str):
    """Passages, so many at once that they have about GROUP characters."""
    some, size = [], 0
    for p in passages(text):
        some.append(p)
        size += p[1] - p[0]
        if size >= GROUP:
            yield some
            some, size = [], 0
    if some:
        yield some


def all_spans(text: str, weights: np.ndarray):
    """(base spans, added spans)"""
    base = base_spans(text)
    # ends of spans up to each start: base spans of several kinds may overlap
    starts = [a for a, _, _ in base]
    reach = list(itertools.accumulate((b for _, b, _ in base), max))
    added = []
    for found in _grouped(text):
        pieces = Pieces(text, found)
        for i, j, kind in decode(weights, pieces):
            shift = int(pieces.shift[pieces.passage(i)])
            a, b = int(pieces.start[i]) + shift, int(pieces.start[j]) + shift
            k = bisect.bisect_left(starts, b)  # base spans that start before its end
            if not k or reach[k - 1] <= a:
                added.append((a, b, ALL_KINDS[kind]))
    return base, added


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], ORDER[s[2]])))


def find(docs: DataFrame, weights: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone: base spans, base_sha256, spans, n_added)"""
    part = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    counts = [f"n_{k}" for k in KINDS]
    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType), *(T.StructField(c, T.LongType()) for c in counts),
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
                           T.StructField("n_added", T.LongType())])
    none = (0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "", 0)

    def run(batches):
        for batch, data, off in chunks(batches):
            rows = [none] * batch.num_rows
            for r in np.flatnonzero(sums(_ANCHOR[data], off)):
                base, added = all_spans(string_at(data, off[r], off[r + 1]), weights)
                n = [sum(s[2] == k for s in base) for k in KINDS]
                rows[r] = (*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + added), len(added))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "id"), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string()),
                 pa.array(cols[5], pa.string()), pa.array(cols[6], pa.int64())], names=schema.names)

    return part.mapInArrow(run, schema)
