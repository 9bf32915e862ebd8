"""BPE encoding and decoding with the vocabulary of a public tokenizer.

A text is cut at the vocabulary's special strings, normalised (NFC, lower case
letter by letter), and cut into words by the vocabulary's pattern (by the
tokenizers library where a text has letters newer than this Python knows); a
word is its UTF-8 bytes, the last one marked as a word's end. Encoding works on the distinct
new words of a batch of texts at once: their symbols lie in one flat array, and
in every round each word merges its pairs of lowest rank, which a binary search
over the sorted pair keys finds. Words already merged are kept for later batches
(at most ``KEPT``, then anew), and the ids of the texts are gathered from them.

The vocabulary is read on the driver from a path (a parameter) and broadcast;
its size is fixed by the file, not by the data.

Nulls and empty texts have no ids and decode to the empty text; an empty table
gives an empty result; repeated rows are encoded each; texts are never cut.
Columns named ids or decoded are replaced, all others are carried along.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from tokenizers import Regex, normalizers, pre_tokenizers

from ledgerlens.llm._text import chunks

KEPT = 400_000  # words remembered by a task
LONG = 4096  # symbols of a word that is merged on its own
BIG = np.int32(2**31 - 1)


_cn = [unicodedata.category(chr(c)) == "Cn" for c in range(0x10000)]
_edges = [c for c in range(0x10000) if _cn[c] != (c > 0 and _cn[c - 1])] + [0x10000]
_NEW = re.compile("[" + "".join(f"\\u{a:04x}-\\u{b - 1:04x}" for a, b in zip(_edges[::2], _edges[1::2])) + "]")
_BEYOND = re.compile("[\U00010000-\U0010ffff]")


def newer(text: str) -> bool:
    """Has it code points that this Python's tables don't know?"""
    return bool(_NEW.search(text)) or any(unicodedata.category(c) == "Cn" for c in set(_BEYOND.findall(text)))


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 stands for itself,
    the others for the letters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Tables of a tokenizer file: word-end BPE over bytes, as word_bpe_49k.json has it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec["added_tokens"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        cuts = spec["pre_tokenizer"]["pretokenizers"]
        if (model["type"] != "BPE" or not model["end_of_word_suffix"] or steps != ["NFC", "Replace", "Lowercase"]
                or [c["type"] for c in cuts] != ["Split", "ByteLevel"] or spec["decoder"] is not None
                or any(a["normalized"] or a["single_word"] or a["lstrip"] or a["rstrip"] for a in added)):
            raise ValueError(f"{path}: not a vocabulary of this kind")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.pattern = cuts[0]["pattern"]["Regex"]
        self.special = {a["content"]: a["id"] for a in added}
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + end] for c in letters], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, BIG where it is no merge."""
        k = a.astype(np.int64) << 32 | b
        j = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where(self.keys[j] == k, self.rank[j], BIG)


def _alternate(at: np.ndarray) -> np.ndarray:
    """Of runs of neighbouring places, the first, third, ... (pairs must not overlap)."""
    i = np.arange(len(at))
    first = np.ones(len(at), bool)
    first[1:] = at[1:] != at[:-1] + 1
    return at[(i - np.maximum.accumulate(np.where(first, i, 0))) % 2 == 0]


def merge_words(v: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds) of the words, by rounds over all of them."""
    n = np.array([len(w) for w in words], np.int64)
    text = np.frombuffer(b"".join(words), np.uint8)
    sym = v.inner[text]
    ends = np.cumsum(n)
    sym[ends - 1] = v.last[text[ends - 1]]
    word = np.repeat(np.arange(len(n)), n)
    done = []
    while len(sym):
        rank = np.full(len(sym), BIG, np.int32)
        pair = np.flatnonzero(word[1:] == word[:-1])
        rank[pair] = v.ranks(sym[pair], sym[pair + 1])
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        low = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(sym))))
        over = low == BIG
        done.append((word[over], sym[over]))
        at = _alternate(np.flatnonzero((rank == low) & ~over))
        sym[at] = v.merged[rank[at]]
        keep = ~over
        keep[at + 1] = False
        sym, word = sym[keep], word[keep]
    word, sym = (np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, np.int64), np.zeros(0, np.int32))
    order = np.argsort(word, kind="stable")
    return sym[order], np.append(0, np.cumsum(np.bincount(word, minlength=len(words))))


def merge_long(v: Vocabulary, text: bytes) -> np.ndarray:
    """Ids of one very long word: the same rounds, but ranks are kept and only
    those beside a merge are looked up again."""
    sym = v.inner[np.frombuffer(text, np.uint8)]
    sym[-1] = v.last[text[-1]]
    n = len(sym)
    right, left = np.arange(1, n + 1), np.arange(-1, n - 1)
    rank = np.full(n, BIG, np.int32)
    rank[:-1] = v.ranks(sym[:-1], sym[1:])
    while (low := rank.min()) != BIG:
        at = np.flatnonzero(rank == low)
        # places whose left neighbour in the chain is hit as well: keep every other one of such a run
        place = np.full(1, -1)
        if len(at) > 1:
            turn = np.searchsorted(at, left[at])
            chained = (turn < len(at)) & (at[np.minimum(turn, len(at) - 1)] == left[at])
            i = np.arange(len(at))
            at = at[(i - np.maximum.accumulate(np.where(chained, 0, i))) % 2 == 0]
        gone = right[at]
        sym[at] = v.merged[low]
        rank[gone] = BIG
        right[at] = right[gone]
        inside = right[at] < n
        left[right[at][inside]] = at[inside]
        sym[gone] = -1
        rank[at] = BIG
        rank[at[inside]] = v.ranks(sym[at[inside]], sym[right[at][inside]])
        before = left[at]
        place = before[before >= 0]
        rank[place] = v.ranks(sym[place], sym[right[place]])
    return sym[sym >= 0]


class Encoder:
    """Texts to ids; remembers merged words."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.find = regex.compile(v.pattern).findall
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in v.special) + ")").split if v.special else None
        self._forget()

    def _forget(self) -> None:
        self.code = {s: i for i, s in enumerate(self.v.special)}
        self.ids = [np.array([*self.v.special.values()], np.int32)]
        self.size = np.ones(len(self.code), np.int64)

    def words(self, text: str) -> list[str]:
        if self.cut and "<" in text:
            parts = self.cut(text)
            if len(parts) > 1:
                return [w for i, p in enumerate(parts) for w in ([p] if i % 2 else self._words(p))]
        return self._words(text)

    def _words(self, text: str) -> list[str]:
        if not text.isascii():
            if newer(text):
                return self._library_words(text)
            # a capital sigma has one small form here, wherever it stands
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.find(text.lower())

    def _library_words(self, text: str) -> list[str]:
        norm = normalizers.Sequence([normalizers.NFC(), normalizers.Replace(Regex(r"\s+"), " "), normalizers.Lowercase()])
        split = pre_tokenizers.Split(Regex(self.v.pattern), "removed", invert=True)
        return [w for w, _ in split.pre_tokenize_str(norm.normalize_str(text))]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of the texts."""
        cut = [self.words(t) if t else [] for t in texts]
        new = dict.fromkeys(w for words in cut for w in words if w not in self.code)
        if new and len(self.code) + len(new) > KEPT:
            self._forget()
            new = dict.fromkeys(w for words in cut for w in words if w not in self.code)
        if new:
            self._learn(list(new))
        code = self.code
        at = np.fromiter((code[w] for words in cut for w in words), np.int64)
        if len(self.ids) > 1:
            self.ids = [np.concatenate(self.ids)]
        start = np.append(0, np.cumsum(self.size))
        n = self.size[at]
        total = np.append(0, np.cumsum(n))
        ids = self.ids[0][np.repeat(start[at] - total[:-1], n) + np.arange(total[-1])]
        return ids, total[np.append(0, np.cumsum([len(words) for words in cut]))]

    def _learn(self, words: list[str]) -> None:
        raw = [w.encode("utf-8") for w in words]
        short = [i for i, w in enumerate(raw) if len(w) <= LONG]
        long = [i for i, w in enumerate(raw) if len(w) > LONG]
        ids, bounds = merge_words(self.v, [raw[i] for i in short])
        sizes = [np.diff(bounds)]
        self.ids.append(ids)
        for i in long:
            self.ids.append(merge_long(self.v, raw[i]))
            sizes.append([len(self.ids[-1])])
        for k, i in enumerate(short + long, len(self.code)):
            self.code[words[i]] = k
        self.size = np.concatenate([self.size, *sizes])


def _through(df: DataFrame, dropped: tuple[str, ...]) -> list[str]:
    return [c for c in df.columns if c not in dropped]


def vocabulary(spark: SparkSession, path: str):
    """The file's tables, broadcast."""
    return spark.sparkContext.broadcast(Vocabulary(path))


def encode(docs: DataFrame, vocab, text: str = "text") -> DataFrame:
    """The input's columns but the text, and ids (array of int)."""
    keep = [c for c in _through(docs, ("ids", "decoded")) if c != text]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        encoder = Encoder(vocab.value)
        for batch, _, _ in chunks(batches, "__text"):
            ids, bounds = encoder.encode(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))],
                names=[*keep, "ids"])

    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, vocab, ids: str = "ids") -> DataFrame:
    """The input's columns, and decoded: its tokens, joined by a space (the
    vocabulary has no decoder of its own). Null ids decode to the empty text."""
    keep = _through(encoded, ("decoded",))
    schema = T.StructType([*(encoded.schema[c] for c in keep), T.StructField("decoded", T.StringType())])
    at = keep.index(ids)

    def run(batches):
        token = vocab.value.tokens
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                found = [" ".join([token[i] for i in x]) if x else "" for x in
                         (row.as_py() for row in part.column(at))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], names=[*keep, "decoded"])

    return encoded.select(*keep).mapInArrow(run, schema)
