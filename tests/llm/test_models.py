"""Held-out quality of the learned operators."""

import itertools
import tracemalloc

import numpy as np
import pytest

from ledgerlens.llm import langid, pii, puquality, queries, toxicity

SF = "/root/testdata/sf0.01"


def labelled(spark, name, label):
    got = queries.QUERIES[name](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out")
    return [(r.score, r.predicted, r[label]) for r in got.collect()]


def test_toxicity_on_held_out_rows(spark):
    rows = labelled(spark, "op8_toxicity", "toxic")
    assert all(0 <= s <= 1 and p == int(s >= 0.5) for s, p, _ in rows)
    assert np.mean([p == y for _, p, y in rows]) > 0.9


def test_quality_on_held_out_rows(spark):
    rows = labelled(spark, "op5_quality_pu", "quality")
    assert all(0 <= s <= 1 and p == int(s >= 0.3) for s, p, _ in rows)
    assert np.mean([p for _, p, y in rows if y]) > 0.95 and np.mean([p for _, p, y in rows if not y]) < 0.4


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = queries.op9_language_id(spark, SF).filter("held_out").join(docs, "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


def test_language_mixtures(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs)
    one = {k: docs.filter(f"lang = '{k}' and length(text) > 2000").first().text[:1500] for k in ("en", "de")}
    text = (one["en"] + "\n" + one["de"]).encode()
    data = np.frombuffer(text, np.uint8)
    _, _, shares = langid.infer(model, data, np.array([0, len(data)]))
    assert {model.langs[i] for i in np.flatnonzero(shares[:, 0])} >= {"en", "de"}
    assert abs(shares.sum() - 1) < 1e-6


def test_isotonic_is_monotone():
    rng = np.random.default_rng(1)
    x = rng.random(500)
    _, y = toxicity.isotonic(x, (rng.random(500) < x).astype(float))
    assert (np.diff(y) >= 0).all()


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(2)
    p = rng.normal(2, 1, (3000, 3))
    u = np.concatenate([rng.normal(2, 1, (2100, 3)), rng.normal(-2, 1, (900, 3))])
    assert abs(puquality.estimate_prior(p, rng.permutation(u), 1) - 0.7) < 0.08


def made_up(k, seed=0, words=40):
    """A model of k languages, and words that each language likes."""
    rng = np.random.default_rng(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = [["".join(rng.choice(list(letters), rng.integers(2, 9))) for _ in range(words)] for _ in range(k)]
    n = np.zeros((k, langid.BUCKETS))
    for i, some in enumerate(own):
        d = np.frombuffer(" ".join(some).encode(), np.uint8)
        n[i] = np.bincount(langid._grams(d, np.array([0, len(d)]))[2], minlength=langid.BUCKETS)
    logp = np.log((n + 0.01) / (n.sum(1, keepdims=True) + 0.01 * langid.BUCKETS)).astype(np.float32)
    return langid.Model([f"l{i:03d}" for i in range(k)], logp), own, rng


def joined(texts):
    parts = [t.encode() for t in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.append(0, np.cumsum([len(p) for p in parts]))


def plain_mixture(like, langs, rounds):
    """EM by hand: like[word][language] are log-likelihoods."""
    share = {x: 1 / len(langs) for x in langs}
    for _ in range(rounds):
        got = dict.fromkeys(langs, 0.0)
        for w in like:
            p = {x: share[x] * np.exp(w[x]) for x in langs}
            for x in langs:
                got[x] += p[x] / sum(p.values()) / len(like)
        share = got
    return share, sum(np.log(sum(share[x] * np.exp(w[x]) for x in langs)) for w in like)


def word_likelihoods(model, text):
    out = []
    for w in text.split():
        d = np.frombuffer(w.encode(), np.uint8)
        g = langid._grams(d, np.array([0, len(d)]))[2]
        out.append([float(model.logp[i][g].astype(float).sum()) for i in range(len(model.langs))])
    return out


@pytest.mark.parametrize("piece, held", [(1 << 20, 1 << 24), (24, 1 << 24), (24, 0)])
def test_mixtures_against_enumeration(monkeypatch, piece, held):
    monkeypatch.setattr(langid, "SLICE", piece)
    monkeypatch.setattr(langid, "HELD", held)
    model, own, rng = made_up(3)
    texts = [" ".join(w for i in some for w in rng.choice(own[i], 12)) for some in ([0], [1], [0, 1], [1, 2], [2, 0, 1], [2, 2, 0])]
    data, off = joined([*texts, "", "12 34"])
    lang, score, shares = langid.infer(model, data, off)
    assert list(lang[-2:]) == [-1, -1] and list(score[-2:]) == [0, 0]
    for r, text in enumerate(texts):
        like = word_likelihoods(model, text)
        price = np.log(len(like) + 1)
        full, _ = plain_mixture(like, [0, 1, 2], 10)
        ranked = sorted(full, key=lambda x: -full[x])
        best = max(range(3), key=lambda x: sum(w[x] for w in like))
        found = [(sum(w[best] for w in like) - price, {best: 1.0})]
        for size in (2, 3):
            share, total = plain_mixture(like, sorted(ranked[:size]), 10)
            found.append((total - size * price, share))
        value, share = max(found, key=lambda x: x[0])
        assert {i: pytest.approx(s, abs=1e-9) for i, s in share.items()} == {i: shares[i, r] for i in np.flatnonzero(shares[:, r])}
        # no set of languages at all is worth more, but for what ten rounds leave open
        every = [plain_mixture(like, list(c), 60)[1] - len(c) * price for n in (1, 2, 3) for c in itertools.combinations(range(3), n)]
        assert value > max(every) - 0.05 * len(like)


def test_a_hundred_languages_stay_within_memory():
    model, own, rng = made_up(100, words=60)
    texts = [" ".join(w for i in rng.integers(0, 100, 3) for w in rng.choice(own[i], 100)) for _ in range(150)]
    data, off = joined(texts)
    tracemalloc.start()
    lang, _, shares = langid.infer(model, data, off)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 << 20 and (lang >= 0).all() and ((shares > 0).sum(0) >= 2).mean() > 0.9


def test_grams_are_those_of_a_plain_count(spark):
    rows = [("ab c", "x"), ("Ab", "x"), ("é1", "y"), (None, "y"), ("zz", None), ("", "z"), ("ab", "w")]
    df = spark.createDataFrame(rows, "text string, lang string")
    want = {}
    names = langid.languages(df, most=3)
    assert names == ["w", "x", "y"]  # z ties with w and sorts after it
    for text, lang in rows:
        code = [int(langid._CLASS[b]) for b in (text or "").encode()]
        for i, c in enumerate(code):
            if c and lang in names:
                g = (([0, *code][i] << 16 | c << 8 | [*code, 0][i + 1]) * 2654435761) % (1 << 32) >> 16
                want[names.index(lang), g] = want.get((names.index(lang), g), 0) + 1
    assert {(r.lang, r.bucket): r.n for r in langid.count_grams(df, names).collect()} == want


def plain_features(text, a, b, start, end, cue):
    """Features of one span, a character at a time."""
    s, before = text[a:b], cue + " " + text[start:a][-40:]
    left, right = text[a - 1:a] if a > start else " ", text[b:b + 1] if b < end else " "
    digits = "".join(c for c in s if c in "0123456789")
    n, letters, at = len(digits), sum(map(str.isalpha, s)), s.count("@")
    quad = s.count(".") == 3 and n + 3 == len(s) and all(p and len(p) <= 3 and int(p) <= 255 for p in s.split("."))
    return [1, at == 1, at == 1 and "." in s[s.find("@"):], s[0] == "+", n < 7, 7 <= n < 9, 9 <= n <= 15, 12 <= n <= 19, n > 19,
            12 <= n <= 19 and not letters and pii.luhn(digits), quad, letters > 0, s.isalnum() and letters > 0 and n > 0 and len(s) >= 16,
            s.isalnum() and len(s) >= 16 and not s.strip("0123456789abcdefABCDEF"), any(map(str.isspace, s)),
            min(len(s) - n - letters, 6) / 6, bool(pii._SECRET_CUE.search(before)), bool(pii._PHONE_CUE.search(before)),
            left.isalnum() or left in ".-+@_%", right.isalnum() or right == "@", min(len(s), 60) / 20, n == len(s),
            any(c in "\"'=:;,/|" for c in s)]


def awkward_texts():
    rng = np.random.default_rng(4)
    some = list("0123456789" * 3 + "..--++()@@abcFGxyz%_:=\"/é²١ ")
    bits = ["12.5 ", "token ", "call ", "+41 (44) 555 ", "4111111111111111 ", "10.0.0.1 ", "a@b.ch ", "key=9 ", "4111 1111 1111 1111 "]
    return (["".join(rng.choice(some, rng.integers(1, 90))) for _ in range(60)]
            + ["x token=12 " + "".join(rng.choice(bits, 25)) for _ in range(6)])


@pytest.mark.parametrize("block", [5, 2048])
def test_span_features_against_plain_python(block):
    for text in awkward_texts():
        for start, end, cue in pii.passages(text):
            pieces = pii.Pieces(text, [(start, end, cue)])
            at = (pieces.start + start).tolist()
            found = [(int(i), int(j), f) for lo in range(0, len(pieces), block) for i, j, f in zip(*pieces.segments(lo, lo + block))]
            for i, j, f in found:
                assert f.tolist() == [float(x) for x in plain_features(text, at[i], at[j + 1], start, end, cue)]
            word = [text[a].isascii() and text[a].isalnum() for a in at[:-1]]
            assert [(i, j) for i, j, _ in found] == [
                (i, j) for i in range(len(word)) for j in range(i, min(i + pii.LONGEST, len(word)))
                if (word[i] or text[at[i]] in "+(") and word[j] and set(text[at[i]:at[j + 1]]) & set("0123456789@")]


def test_segmentation_against_enumeration():
    rng = np.random.default_rng(5)
    for text in ["a1 2-3", "+1 22", "x@y.z 9", "(4) 5.6", "1 2 3"]:
        pieces = pii.Pieces(text, list(pii.passages(text)))
        i, j, feats = pieces.segments()
        for _ in range(20):
            w = rng.normal(0, 1, (len(pii.ALL_KINDS), len(pii.NAMES)))
            score = feats @ w.T
            best = 0.0
            for n in range(1, len(pieces) + 1):
                for some in itertools.combinations(range(len(i)), n):
                    if all(j[a] < i[b] for a, b in itertools.pairwise(sorted(some, key=lambda k: i[k]))):
                        best = max(best, score[list(some)].max(1).sum())
                if n == 3:
                    break  # sets of up to three spans
            found = pii.decode(w, pieces)
            at = {(int(a), int(b) + 1): k for k, (a, b) in enumerate(zip(i, j))}
            got = sum(score[at[a, b], kind] for a, b, kind in found)
            assert got >= best - 1e-4 and (len(found) > 3 or abs(got - best) < 1e-4)
            assert all(x[1] <= y[0] for x, y in itertools.pairwise(found))


def test_passages_taken_together_change_nothing(monkeypatch):
    w = pii.train([f"token = {'%040x' % (7 ** 40 + i)} and call +1 (555) 555-{1000 + i} in 2024" for i in range(30)])
    texts = [" word ".join(awkward_texts()), "9" * 300 + " a " + "12.5 " * 500]
    whole = [pii.all_spans(t, w) for t in texts]
    monkeypatch.setattr(pii, "GROUP", 1)
    monkeypatch.setattr(pii, "BLOCK", 3)
    assert [pii.all_spans(t, w) for t in texts] == whole


def test_network_slopes_by_finite_differences():
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (9, 4))
    net = puquality.Net(x, rng)
    z, slope = net.scaled(x), rng.normal(0, 1, 9)
    start = [np.array(w, float) for w in net.w]

    def value(ws):
        net.w = ws
        return float(net.out(z) @ slope) + sum(0.5e-4 * float((w ** 2).sum()) for w in ws)

    want = []
    for i, w in enumerate(start):
        g = np.zeros_like(w)
        for k in np.ndindex(w.shape):
            up, down = [v.copy() for v in start], [v.copy() for v in start]
            up[i][k] += 1e-5
            down[i][k] -= 1e-5
            g[k] = (value(up) - value(down)) / 2e-5
        want.append(g)
    net.w = [w.copy() for w in start]
    net.learn(z, slope, 0.0)
    for m, g in zip(net.m, want):
        assert np.allclose(m / 0.1, g, atol=1e-6)


def test_non_negative_risk_separates_a_known_mixture():
    rng = np.random.default_rng(7)
    p = rng.normal(1.5, 1, (800, 2))
    u = rng.permutation(np.concatenate([rng.normal(1.5, 1, (600, 2)), rng.normal(-1.5, 1, (1000, 2))]))
    model = puquality.Model(puquality.train(p, u, 600 / 1600, 1), 600 / 1600)
    good, bad = rng.normal(1.5, 1, (500, 2)), rng.normal(-1.5, 1, (500, 2))
    assert (model.score(good) > 0.5).mean() > 0.9 and (model.score(bad) < 0.5).mean() > 0.9


def test_one_tree_takes_the_best_cut_of_all():
    rng = np.random.default_rng(8)
    for _ in range(10):
        x = rng.integers(0, 6, (40, 3)).astype(float)
        y = ((x[:, rng.integers(3)] > 2) ^ (rng.random(40) < 0.2)).astype(float)
        edges, base, [(feature, cut, value)] = toxicity.boost(x, y, trees=1, depth=1, rate=1.0)
        q = y.mean()
        g, h = y - q, np.full(40, q * (1 - q))

        def gain(side):
            return sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (side, ~side))

        every = [gain(x[:, j] <= e) for j in range(3) for e in edges[j]]
        left = x[:, feature[0]] <= edges[feature[0]][cut[0]]
        assert gain(left) == pytest.approx(max(every))
        assert value == pytest.approx([g[s].sum() / (h[s].sum() + 1) for s in (left, ~left)])
        assert toxicity.margin((edges, base, [(feature, cut, value)]), x) == pytest.approx(base + np.where(left, *value))


def test_isotonic_against_least_squares():
    rng = np.random.default_rng(9)
    x, y = np.arange(7.0), rng.integers(0, 2, 7).astype(float)
    _, fitted = toxicity.isotonic(x, y)
    best = min((sum(((y[a:b] - y[a:b].mean()) ** 2).sum() for a, b in itertools.pairwise((0, *cuts, 7)))
                for n in range(7) for cuts in itertools.combinations(range(1, 7), n)
                if all(y[a:b].mean() <= y[b:c].mean() for a, b, c in zip((0, *cuts), (*cuts, 7), (*cuts[1:], 7)) if b < c)))
    at, fit = toxicity.isotonic(x, y)
    assert (np.diff(fitted) >= 0).all() and ((np.interp(x, at, fit) - y) ** 2).sum() >= best - 1e-9


def test_lexicon_is_that_of_a_plain_count(spark):
    rows = [("bad worse worst nice", 1)] * 3 + [("bad worse day", 1)] * 2 + [("nice day worse", 0)] * 6 + [("bad", 0), (None, 0), ("", 1)]
    got, odds = toxicity.lexicon_of(spark.createDataFrame(rows, "text string, label int"), least=2)
    n = {k: sum(b == k for _, b in rows) for k in (0, 1)}
    want = {}
    for w in {w for t, _ in rows for w in (t or "").split()}:
        bad, fine = (sum(w in (t or "").split() for t, b in rows if b == k) for k in (1, 0))
        o = np.log((bad + 0.5) / (n[1] + 1)) - np.log((fine + 0.5) / (n[0] + 1))
        if bad >= 2 and o > 1:
            want[w] = o
    d, off = joined(["".join(f"{w} " for w in want)])
    starts, ends, _ = toxicity.words(d, off, toxicity.ALNUM)
    key = toxicity.word_hashes(d, starts, ends).tolist()
    assert want and dict(zip(got.tolist(), odds)) == {k: pytest.approx(o) for k, o in zip(key, want.values())}


def test_a_repeated_id_is_learned_from_once(spark):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    rows = [(i, ("fine words here " if i % 2 else "vile vile YOU ") * 5 + str(i)) for i in range(40)]
    once = spark.createDataFrame(rows, "doc_id long, text string")
    often = spark.createDataFrame(rows + [rows[3]] * 200 + [rows[4]] * 200, "doc_id long, text string")
    for module in (puquality, toxicity):
        got = [{(r.doc_id, r.score) for r in module.predict(once, module.fit(d, labels)).collect()} for d in (once, often)]
        assert got[0] == got[1]
