"""Grouping spelling variants by an index of variable-length grams.

1. Words are the runs of letters (A-Z, a-z, U+00C0 to U+00FF) of whole texts,
   A-Z lower-cased; where ``every`` divides the CRC-32 of id and run, one letter
   of the run is left out. They are counted within a task first, then globally.
2. Gram dictionary: all grams of 2 letters; a longer one (up to ``GRAMS`` letters)
   only if the gram without its last letter is frequent, that is, has over
   ``SHARE`` of all words. Its size is bounded by the share, not by the data.
3. A word, padded at both ends, is decomposed: at every place the longest gram
   of the dictionary, unless an earlier one covers it.
4. Affected grams: an edit touches the grams across it, those before it that a
   longer gram could replace, and those behind it that a gram across it could
   cover; both are looked up in the dictionary (has it an extension, is it the
   end of a longer gram). So many of a word's rarest grams are posted that every
   possible edit leaves one of them alone; a gram is posted at its place from
   the left if an edit behind it may be the one, and from the right if an edit
   before it may be. As one edit leaves all on its other side alone, words of a
   list share the letters from their border through the gram.
5. Lists are merged: each is a group of words, compared in pairs up to ``LIST``
   words; a longer one is first split by the words with one letter left out, of
   which two near words share one (a group of at most 90 words a letter), so
   that no list is compared in full. Every pair is verified.

Two words link if they differ by one inserted, deleted or replaced code point.
A form is the most frequent near word (of several, the smallest) with at least
twice the count; counts at least double from form to form, so roots are found
by a few rounds of doubling joins.

Null and empty texts have no word; repeated rows count each; a null id is the
text 'null'; an empty table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations, groupby
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm._spark import written
from ledgerlens.llm._text import chunks, column, word_hashes, words

LEAST_LETTERS, LEAST_COUNT, EVERY = 5, 3, 97
SHORT_GRAM, GRAMS, SHARE = 2, 4, 1 / 500
LIST = 32  # words of a list compared in pairs
FIRST, LAST = "\x02", "\x03"  # padding; no letters
LONG_RUN = 256  # bytes of a run whose checksum is taken on its own

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_ONE = np.arange(256) == 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & np.uint32(1), (_CRC >> np.uint32(1)) ^ np.uint32(0xEDB88320), _CRC >> np.uint32(1))


def runs_crc(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC-32 of each run's bytes, carried on from ``state``."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    left = np.searchsorted(-size[order], -LONG_RUN)  # runs longer than that stand first
    c = state[order] ^ np.uint32(0xFFFFFFFF)
    at, many = starts[order], -size[order]
    for j in range(int(-many[left]) if left < len(many) else 0):
        live = int(np.searchsorted(many, -j))
        byte = low[at[left:live] + j]
        c[left:live] = _CRC[(c[left:live] ^ byte) & np.uint32(0xFF)] ^ (c[left:live] >> np.uint32(8))
    out = np.empty(len(size), np.uint32)
    out[order] = c ^ np.uint32(0xFFFFFFFF)
    for i in order[:left]:
        out[i] = crc32(low[starts[i]:ends[i]].tobytes(), int(state[i]))
    return out


def count_words(docs: DataFrame, doc_id: str, text: str, least_letters: int, least_count: int, every: int) -> DataFrame:
    """(word, n): the distinct words with their counts."""
    def run(batches):
        for batch, data, off in chunks(batches):
            lead = data == 0xC3
            tail = np.append(False, lead[:-1])
            starts, ends, bounds = words((_LETTER[data] | lead | tail).view(np.uint8), off, _ONE)
            within = np.append(0, np.cumsum(tail))
            letters = ends - starts - (within[ends] - within[starts])
            row = np.repeat(np.arange(len(off) - 1), np.diff(bounds))
            some = letters >= least_letters
            starts, ends, letters, row = starts[some], ends[some], letters[some], row[some]
            low = _LOWER[data]
            state = np.array([crc32(f"{i}:".encode()) for i in column(batch, "doc").to_pylist()], np.uint32)
            h = runs_crc(low, starts, ends, state[row])
            cut = h % np.uint32(every) == 0
            found = Counter()
            for i in np.flatnonzero(cut & (letters > least_letters)):
                run_ = low[starts[i]:ends[i]].tobytes().decode()
                k = int(h[i]) % len(run_)
                found[run_[:k] + run_[k + 1:]] += 1
            starts, ends = starts[~cut], ends[~cut]
            _, first, n = np.unique(word_hashes(data, starts, ends), return_index=True, return_counts=True)
            for a, b, k in zip(starts[first].tolist(), ends[first].tolist(), n.tolist()):
                found[low[a:b].tobytes().decode()] += k
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())],
                                             names=["word", "n"])

    part = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).alias("doc"), F.col(text).alias("text"))
    counted = part.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least_count)


class Grams:
    """The gram dictionary with what decomposition asks of it."""

    def __init__(self, counts: dict[str, int], least_letters: int = LEAST_LETTERS, longest: int = GRAMS):
        self.count, self.longest = counts, longest
        self.longer = {g[:-1] for g in counts if len(g) > SHORT_GRAM}  # grams that another one extends
        self.ends = {g[k:] for g in counts for k in range(1, len(g) - 1)}  # ends of two letters or more of longer grams
        # so many signs at each end that an edit leaves the first or the last gram alone
        pad = max(1, -(-(2 * longest + 1 - least_letters) // 2))
        self.head, self.tail = FIRST * pad, LAST * pad

    def decompose(self, s: str) -> list[tuple[int, int]]:
        """(start, end) of the grams of a padded word."""
        out, covered = [], 0
        for p in range(len(s) - SHORT_GRAM + 1):
            e = p + SHORT_GRAM
            while e < len(s) and e - p < self.longest and s[p:e + 1] in self.count:
                e += 1
            if e > covered:
                out.append((p, e))
                covered = e
        return out

    def spared(self, s: str, p: int, e: int, edits: list[tuple[int, int]]) -> tuple[set, set]:
        """The edits before the gram, and those behind it, that leave it alone.
        An edit (a, b) replaces or deletes s[a:b], or inserts where a = b."""
        behind = {x for x in edits if e < x[0] or (e == x[0] and s[p:e] not in self.longer)}
        before = {x for x in edits if x[1] <= p and s[x[1]:e] not in self.ends}
        return before, behind

    def postings(self, word: str) -> list[str]:
        """The lists that the word is in."""
        s = self.head + word + self.tail
        a, b = len(self.head), len(self.head) + len(word)
        open_ = [*((i, i + 1) for i in range(a, b)), *((i, i) for i in range(a, b + 1))]
        grams = sorted(self.decompose(s), key=lambda g: (self.count.get(s[g[0]:g[1]], 0), s[g[0]:g[1]], g[0]))
        out = []
        for p, e in grams:
            before, behind = self.spared(s, p, e, open_)
            if behind:
                out.append(f"{p} {s[:e]}")
            if before:
                out.append(f"{s[p:]} {e - p}")
            open_ = [x for x in open_ if x not in before and x not in behind]
            if not open_:
                return out
        raise AssertionError(f"an edit of {word!r} touches all its grams")


def dictionary(vocabulary: DataFrame, least_letters: int = LEAST_LETTERS, longest: int = GRAMS, share: float = SHARE) -> Grams:
    """The gram dictionary of the words: length by length, only grams whose
    beginning is frequent are counted, so few rows reach the driver."""
    padded = Grams({}, least_letters, longest)
    head, tail, total = padded.head, padded.tail, vocabulary.count()
    counts: dict[str, int] = {}
    frequent = None
    for size in range(SHORT_GRAM, longest + 1):
        def run(batches, size=size, frequent=frequent):
            for batch in batches:
                found = Counter()
                for w in column(batch, "word").to_pylist():
                    s = head + w + tail
                    found.update({s[i:i + size] for i in range(len(s) - size + 1)
                                  if frequent is None or s[i:i + size - 1] in frequent})
                yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())],
                                                 names=["gram", "n"])

        level = vocabulary.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        got = {r.gram: r.n for r in level.collect()}
        counts |= got
        frequent = {g for g, n in got.items() if n > share * total}
    return Grams(counts, least_letters, longest)


def near(a: str, b: str) -> bool:
    """Do they differ by one inserted, deleted or replaced code point?"""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def _runs(batches):
    """(key, words of the list) in order of arrival; lists are short."""
    rows = (r for batch in batches for r in zip(*(column(batch, c).to_pylist() for c in ("list", "word", "n"))))
    for _, group in groupby(rows, key=lambda r: r[0]):
        yield [r[1:] for r in group]


def near_pairs(vocabulary: DataFrame, grams: Grams) -> DataFrame:
    """(a, n_a, b, n_b): the pairs of near words, each once."""
    held = vocabulary.sparkSession.sparkContext.broadcast(grams)

    def post(batches):
        for batch in batches:
            lists = [held.value.postings(w) for w in column(batch, "word").to_pylist()]
            at = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for x in lists for p in x], pa.string()), *(column(batch, c).take(pa.array(at)) for c in ("word", "n"))],
                names=["list", "word", "n"])

    posted = written(vocabulary.select("word", "n").mapInArrow(post, "list string, word string, n long")
                     .withColumn("list", F.xxhash64("list")), "spelling-lists")
    size = posted.groupBy("list").agg(F.count("*").alias("size")).filter("size > 1")
    rows = posted.join(size, "list")
    less = F.transform(F.sequence(F.lit(1), F.char_length("word")), lambda i: F.concat(
        F.substring(F.col("word"), F.lit(1), i - 1), F.substring(F.col("word"), i + 1, F.char_length("word"))))
    split = rows.filter(F.col("size") > LIST).select(
        "list", "word", "n", F.explode(F.array_distinct(F.concat(F.array("word"), less))).alias("part"))
    rows = rows.filter(F.col("size") <= LIST).select("list", "word", "n").unionByName(
        split.select(F.xxhash64("list", "part").alias("list"), "word", "n"))

    def compare(batches):
        out = []
        for group in _runs(batches):
            for x, y in combinations(sorted(group), 2):
                if near(x[0], y[0]):
                    out.append((*x, *y))
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["a", "n_a", "b", "n_b"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["a", "n_a", "b", "n_b"])

    rows = rows.repartition("list").sortWithinPartitions("list")
    return rows.mapInArrow(compare, "a string, n_a long, b string, n_b long").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by doubling: after k rounds a
    word knows the word 2**k steps on."""
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("far"))
        new = written(now.join(step, "root", "left").select("word", F.coalesce("far", "root").alias("root"),
                                                            F.col("far").isNotNull().alias("moved")), "spelling-roots")
        now = new.select("word", "root")
        if not new.filter("moved").limit(1).count():
            return now


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS,
             least_count: int = LEAST_COUNT, every: int = EVERY) -> DataFrame:
    """(word, n, n_near, form, form_n, root) per word."""
    vocabulary = written(count_words(docs, doc_id, text, least_letters, least_count, every), "spelling-words")
    pairs = written(near_pairs(vocabulary, dictionary(vocabulary, least_letters)), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("form"), F.col("n_b").alias("form_n"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("form"),
                                         F.col("n_a").alias("form_n")))
    best = both.groupBy("word", "n").agg(F.count("*").alias("n_near"),
                                         F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))
    form = F.when(-F.col("best.less") >= 2 * F.col("n"), F.col("best.form"))
    best = written(best.select("word", "n_near", form.alias("form"),
                               F.when(form.isNotNull(), -F.col("best.less")).alias("form_n")), "spelling-forms")
    root = roots(best.filter("form is not null"))
    out = vocabulary.join(best, "word", "left").join(root, "word", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n",
                      F.coalesce("root", "word").alias("root"))
