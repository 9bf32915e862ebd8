"""Spelling variants, importance resampling and BPE against plain-Python versions."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from itertools import combinations
from zlib import crc32

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlens.llm import bpe, resample, spelling
from ledgerlens.llm._spark import ship

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PATH = public_tokenizers.path("word_bpe_49k.json")


def low(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def one_edit(a, b):
    """By all edits of a, not by comparing."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = low(run)
            h = crc32(f"{'null' if i is None else i}:{run}".encode())
            k = h % len(run)
            n[run[:k] + run[k + 1:] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in n.items() if c >= 3 and len(w) >= 5}
    near = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root(w)) for w in n}


def variant_rows():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(5, 9))) for _ in range(60)]
    words = Counter()
    for w in base:
        words[w] += rng.choice([40, 9, 4])
        for _ in range(9):
            i, c = rng.randrange(len(w)), rng.choice("abcdeéÿ")
            words[rng.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]])] += rng.choice([2, 3, 8])
    words.update({"common" + a + b: 3 for a in "abcdefgh" for b in "ijklmnop"})  # one long list
    words["x" * 700] = 4
    words["x" * 699 + "y"] = 9
    bag = list(words.elements())
    rng.shuffle(bag)
    rows = [(i % 50 or None, " ".join(bag[i::300])) for i in range(300)]
    return rows + [rows[0], (7, None), (8, ""), (9, "##  1 "), (10, "ABCDE abcde Abcde×÷ ŁÓDŹabcde")]


def test_variants(spark):
    ship(spark)
    rows = variant_rows()
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: tuple(r[1:]) for r in spelling.variants(d).collect()}
    want = brute_variants(rows)
    assert got == want
    assert spelling.variants(d.limit(0)).collect() == []
    assert sum(x[2] is not None for x in want.values()) > 30 and any(x[4] != x[2] for x in want.values() if x[2])


@pytest.mark.parametrize("letters,frequent", [("ab", 3), ("abc", 40), ("abcdefgh", 3), ("abcdefgh", 1000)])
def test_near_words_share_a_list(letters, frequent):
    rng = random.Random(len(letters) * frequent)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(5, 11))) for _ in range(250)}
    for w in sorted(words)[:120]:
        i, c = rng.randrange(len(w)), rng.choice(letters)
        words |= {x for x in (w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]) if len(x) >= 5}
    counts, some = Counter(), None
    pad = spelling.Grams({})
    for k in (2, 3, 4):
        level = Counter(g for s in (pad.head + w + pad.tail for w in words) for g in
                        {s[i:i + k] for i in range(len(s) - k + 1) if some is None or s[i:i + k - 1] in some})
        counts.update(level)
        some = {g for g, n in level.items() if n > frequent}
    grams = spelling.Grams(counts)
    lists = {w: set(grams.postings(w)) for w in words}
    pairs = [(a, b) for a, b in combinations(sorted(words), 2) if one_edit(a, b)]
    assert len(pairs) > 100
    for a, b in combinations(sorted(words), 2):
        assert spelling.near(a, b) == one_edit(a, b)
    assert all(lists[a] & lists[b] for a, b in pairs)


def brute_resample(rows, target):
    def grams(t):
        w = WORD.findall(low(t))
        return len(w), [" ".join(w[i:i + k]) for k in (1, 2) for i in range(len(w) - k + 1)]

    def bucket(g):
        return crc32(g.encode()) % 10000

    s, t = (Counter(bucket(g) for x in texts for g in grams(x)[1]) for texts in ([r[1] for r in rows], target))
    out = []
    for i, (d, x) in enumerate(rows):
        words, g = grams(x)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000))))
                for b in map(bucket, g)]
        h = int(sha256(f"7:{'null' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain) // len(g) if g else 0
        out.append([d, words, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    for k, r in enumerate(fit[:25 * len(fit) // 100], 1):
        r[5] = k
    return out


def test_resampling(spark):
    ship(spark)
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["A-b", "the", "Of.", "été", "x1", "東京"]) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows += [(5, None), (None, "the " * 30), (None, "the " * 30), (6, ""), (7, " .. \n"), (300, "one " * 30000)] + [rows[3]] * 3
    target = ["the x1 été", None, "", "Of the"]
    d = spark.createDataFrame([(*r, "r", 1) for r in rows], "doc_id long, text string, rank string, key long")
    t = spark.createDataFrame([(x,) for x in target], "text string")
    key = lambda r: tuple((x is None, x or 0) for x in r)
    want = sorted(map(tuple, brute_resample(rows, target)), key=key)
    assert sorted(map(tuple, resample.resample(d, t).collect()), key=key) == want
    assert resample.resample(d.limit(0), t).collect() == []
    assert all(r.rank is None for r in resample.resample(d.limit(3), t.limit(0)).collect())


def test_spans_of_three_words():
    text = b"Ab, cd;; e\tF g"
    words, crc = resample.features(text, resample.scanner(3), 3)
    w = ["ab", "cd", "e", "f", "g"]
    want = [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]
    assert words == 5 and sorted(crc.tolist()) == sorted(crc32(x.encode()) for x in want)
    assert resample.features(b" - ", resample.scanner(3), 3)[1].tolist() == []


TEXTS = [None, "", "  \n", "Hello, world! it's we'LL 'SAM 'd ''s", "İstanbul ΑΣ ΣΑΣ straße ﬁ é Å Ω", "日本語のテキスト 𝔘𝔫𝔦 👩‍👩‍👧 x²½ Ⅷ ٣",
         "<|endoftext|> a<|startoftext|>b <|endoftext <| endoftext|> <|ENDOFTEXT|>", "a\u0085b c d\x1ce​f﻿",
         "Ᲊa Ɤ́ \U00010d50x ՘y", "aaaaaaaa" * 30 + " 1234567890 " + "!?" * 50, "x" * 5000, "ab" * 3000 + "a"]


def test_bpe_is_the_librarys(spark):
    ship(spark)
    library = Tokenizer.from_file(PATH)
    rng = random.Random(8)
    texts = TEXTS + ["".join(rng.choice("aeinorst'é .,\n1ÀΣ本") for _ in range(rng.randint(0, 300))) for _ in range(200)]
    texts.append("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9000)))
    d = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts + texts[3:6])], "doc_id long, text string, ids string, word string")
    vocab = bpe.vocabulary(spark, PATH)
    got = bpe.decode(bpe.encode(d, vocab), vocab)
    assert got.columns == ["doc_id", "word", "ids", "decoded"]
    for r in got.collect():
        ids = library.encode((texts + texts[3:6])[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids, r.doc_id
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(d.limit(0), vocab), vocab).collect() == []


def test_merge_rounds_agree():
    v = bpe.Vocabulary(PATH)
    rng = random.Random(9)
    words = ["".join(rng.choice("aab cxyz") for _ in range(rng.randint(1, 300))).replace(" ", "é").encode() for _ in range(60)]
    ids, bounds = bpe.merge_words(v, words)
    for i, w in enumerate(words):
        assert bpe.merge_long(v, w).tolist() == ids[bounds[i]:bounds[i + 1]].tolist()


def test_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 20)
    e = bpe.Encoder(bpe.Vocabulary(PATH))
    library = Tokenizer.from_file(PATH)
    for t in ["one two three four", " ".join(f"w{i}q" for i in range(40)), "three four <|endoftext|> five"]:
        assert e.encode([t])[0].tolist() == library.encode(t, add_special_tokens=False).ids
