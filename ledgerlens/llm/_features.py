"""Dense features of whole texts for the two document classifiers."""

from __future__ import annotations

import numpy as np

from ledgerlens.llm._text import ALNUM, NON_SPACE, _CODE, sums, word_hashes, words

UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True
LOWER = np.zeros(256, bool)
LOWER[0x61:0x7B] = True
DIGIT = np.zeros(256, bool)
DIGIT[0x30:0x3A] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>^~=_{}[]\\")] = True
PUNCT = np.zeros(256, bool)
PUNCT[list(b".,;:!?'\"()-")] = True
HIGH = np.zeros(256, bool)
HIGH[0x80:] = True

#: Second-person words of several languages: fixed values.
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton ta vous votre vos usted ustedes ti tus vosotros".split()
#: What stands for a letter in disguised words: fixed values.
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

LEET = ALNUM.copy()
LEET[list(b"@$")] = True
_LEET_CODE = _CODE.copy()
_LEET_CODE[0x41:0x5B] = _CODE[0x61:0x7B]
for _a, _b in STANDS_FOR.items():
    _LEET_CODE[ord(_a)] = _CODE[ord(_b)]


def hash_words(texts: list[str]) -> np.ndarray:
    """Sorted hashes of single words, as the kernels hash them."""
    data = [t.encode() for t in texts]
    ends = np.cumsum([len(x) for x in data]).astype(np.int64)
    starts = ends - [len(x) for x in data]
    return np.sort(word_hashes(np.frombuffer(b"".join(data), np.uint8), starts, ends))


YOU = hash_words(SECOND_PERSON)


def has(sorted_: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)
    return sorted_[at] == x


def per_word(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    c = np.append(0, np.cumsum(mask, dtype=np.int64))
    return c[ends] - c[starts]


def _rate(n, of):
    return n / np.maximum(of, 1)


def distinct(h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Distinct values of each row (by 44 bits of their hash)."""
    key = np.sort((row.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
    new = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
    return np.bincount((key[new] >> np.uint64(44)).astype(np.int64), minlength=rows)


TOXIC_FEATURES = ["lexicon", "lexicon_n", "lexicon_odds", "weak", "disguised", "second_person", "near_second_person",
                  "capitals", "caps_words", "exclaims", "punctuation", "mixed_words", "symbols", "long_runs",
                  "lone_letters", "log_words"]


def toxic_features(data, off, lexicon: np.ndarray, odds: np.ndarray, strong: float) -> np.ndarray:
    """lexicon: sorted word hashes with their log odds; strong: the odds from which a word counts fully."""
    rows = len(off) - 1
    starts, ends, b = words(data, off, ALNUM)
    h = word_hashes(data, starts, ends)
    n, chars = np.diff(b), np.diff(off)
    row = np.repeat(np.arange(rows), n)
    weight = np.zeros(len(h))
    if len(lexicon):
        at = np.minimum(np.searchsorted(lexicon, h), len(lexicon) - 1)
        weight = np.where(lexicon[at] == h, odds[at], 0.0)
    hit = weight >= strong
    you = has(YOU, h)
    near = np.zeros(len(h), bool)
    for d in range(1, 6):  # within five words of a second person, in the same text
        near[d:] |= you[:-d] & (row[d:] == row[:-d])
        near[:-d] |= you[d:] & (row[d:] == row[:-d])
    length = ends - starts
    upper = per_word(UPPER[data], starts, ends)
    mixed = (per_word(DIGIT[data], starts, ends) > 0) & (per_word((UPPER | LOWER)[data], starts, ends) > 0)
    s2, e2, b2 = words(data, off, LEET)
    h2 = word_hashes(data, s2, e2, code=_LEET_CODE)
    plain = per_word((DIGIT | (LEET & ~ALNUM))[data], s2, e2) == 0
    disguised = has(lexicon[odds >= strong], h2) & ~plain
    same = np.zeros(len(data), bool)
    same[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (UPPER | LOWER)[data[2:]]
    lone = (length == 1) & ~DIGIT[data[starts]] if len(starts) else np.zeros(0, bool)
    letters = sums((UPPER | LOWER)[data], off)
    return np.stack([
        _rate(sums(hit, b), n), np.log1p(sums(hit, b)), _rate(sums(np.maximum(weight, 0), b), n),
        _rate(sums((weight > 0) & ~hit, b), n), _rate(sums(disguised, b2), n), _rate(sums(you, b), n),
        _rate(sums(hit & near, b), n), _rate(sums(UPPER[data], off), letters), _rate(sums((upper == length) & (length > 2), b), n),
        _rate(sums((data == 0x21) | (data == 0x3F), off), chars), _rate(sums(PUNCT[data], off), chars),
        _rate(sums(mixed, b), n), _rate(sums(SYMBOL[data], off), chars), _rate(sums(same, off), chars),
        _rate(sums(lone, b), n), np.log1p(n)], axis=1)


QUALITY_FEATURES = ["log_words", "word_length", "long_words", "symbols", "punctuation", "capitals", "caps_words", "digits",
                    "exclaims", "pipes", "distinct_words", "distinct_pairs", "same_as_before", "distinct_lines",
                    "words_a_line", "ended_lines", "letters", "symbol_words"]


def quality_features(data, off) -> np.ndarray:
    rows = len(off) - 1
    starts, ends, b = words(data, off, NON_SPACE)
    h = word_hashes(data, starts, ends)
    n, chars = np.diff(b), np.diff(off)
    row = np.repeat(np.arange(rows), n)
    length = ends - starts
    inner = np.zeros(len(h), bool)
    if len(h):
        inner[1:] = row[1:] == row[:-1]
    again = np.zeros(len(h), bool)
    if len(h):
        again[1:] = inner[1:] & (h[1:] == h[:-1])
    pair = (h[1:] * np.uint64(3) + h[:-1])[inner[1:]] if len(h) else h
    line = np.ones(256, bool)
    line[0x0A] = False
    ls, le, lb = words(data, off, line)
    lh = word_hashes(data, ls, le, lower=False)
    lrow = np.repeat(np.arange(rows), np.diff(lb))
    ended = PUNCT[data[le - 1]] if len(le) else np.zeros(0, bool)
    upper = per_word(UPPER[data], starts, ends)
    letter = (UPPER | LOWER | HIGH)[data]
    letters = sums(letter, off)
    lines = np.diff(lb)
    return np.stack([
        np.log1p(n), _rate(sums(length, b), n), _rate(sums(length > 20, b), n), _rate(sums(SYMBOL[data], off), chars),
        _rate(sums(PUNCT[data], off), chars), _rate(sums(UPPER[data], off), letters),
        _rate(sums((upper > 1) & (upper * 2 > length), b), n), _rate(sums(DIGIT[data], off), chars),
        _rate(sums((data == 0x21) | (data == 0x3F), off), chars), _rate(sums(data == 0x7C, off), n),
        _rate(distinct(h, row, rows), n), _rate(distinct(pair, row[1:][inner[1:]] if len(h) else row, rows), n - 1),
        _rate(sums(again, b), n), _rate(distinct(lh, lrow, rows), lines), np.log1p(_rate(n, lines)),
        _rate(sums(ended, lb), lines), _rate(letters, chars), _rate(sums(per_word(SYMBOL[data], starts, ends) > 0, b), n)], axis=1)
