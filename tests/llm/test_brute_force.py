"""Each operator against a plain-Python version on the smallest tables."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from ledgerlens.llm import decontam, jaccard, linecrf, linededup, mixing, pii, queries, warc
from ledgerlens.llm._spark import ship
from ledgerlens.llm.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.read.parquet(f"{SF}/documents.parquet")


def shingles(text):
    w = SPACE_WORD.findall(low(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def check_links(rows, result):
    """rows: (doc_id, text); result: rows of jaccard_join."""
    sets = {d: shingles(t) for d, t in rows}
    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = {}
    for d, s in sets.items():
        n = Counter(e for g in s for e in holders[g])
        links[d] = {e for e, k in n.items() if e != d and k >= 0.8 * (len(s) + len(sets[e]) - k) - 1e-9}
        for e in links[d]:
            a, b = sorted((root(d), root(e)))
            parent[b] = a
    for r in result:
        assert r.n_links == len(links[r.doc_id]), r
        assert r.class_id == root(r.doc_id), r


def test_jaccard_links_and_groups(docs):
    check_links([tuple(r) for r in docs.select("doc_id", "text").collect()], jaccard.jaccard_join(docs).collect())


def test_jaccard_large_near_group_in_blocks(spark, monkeypatch):
    """Copies that differ in one word: leaves and checks larger than a block."""
    ship(spark)
    monkeypatch.setattr(jaccard, "SMALL", 8)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 16)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        w[i % 100] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(f"{i}v{j}" for j in range(30))) for i in range(20)] + [(200, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_links(rows, jaccard.jaccard_join(df).collect())


def test_edges_of_a_dense_group_grow_with_its_size(spark, monkeypatch):
    """Once, twice, four times a block of near copies: a few edges a class, not a forest for each pair of blocks."""
    from ledgerlens.llm.components import components

    ship(spark)
    monkeypatch.setattr(jaccard, "SMALL", 8)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 32)
    found = {}
    for n in (32, 64, 128, 256):
        texts = [" ".join(f"x{i}" if j == i % 150 else f"w{j}" for j in range(150)) for i in range(n)]
        d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        signed = jaccard.sign(d, "doc_id", "text", 5).selectExpr("xxhash64(k1, k2) id", "sig", "k1", "k2", "1L copies")
        edges = jaccard.likely_links(signed, 0.8, 0.99)
        groups = components(edges)
        assert groups.count() == n and groups.select("label").distinct().count() == 1
        members = signed.join(jaccard.whole_sets(d, "doc_id", "text", 5), ["k1", "k2"]).selectExpr(
            "1L comp", "id", "copies", "hashes")
        links = jaccard.exact_links(members, 0.8)
        assert links.filter("partner is null").selectExpr("sum(sets)").first()[0] == n * (n - 1)
        forest = links.filter("partner is not null").count()
        assert n - 1 <= forest <= n + (n // 32 + 1) ** 2
        found[n] = edges.count() / n
    assert max(found.values()) < 2 * found[32] + 1, found


def test_decontamination(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").unionByName(
        spark.createDataFrame([(900, "The of"), (901, "..."), (902, None)], "item_id long, text string"))
    windows = defaultdict(set)
    for r in bench.collect():
        w = ALNUM_WORD.findall(low(r.text))
        k = min(10, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[i:i + k])].add(str(r.item_id))
    sizes = {len(g) for g in windows}
    got = {r.doc_id: r for r in decontam.decontaminate(docs, bench).collect()}
    for r in docs.collect():
        w, hit, items = ALNUM_WORD.findall(low(r.text)), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if g := windows.get(tuple(w[i:i + k])):
                    hit.update(range(i, i + k))
                    items |= g
        a = got[r.doc_id]
        assert (a.n_words, a.n_hit, a.n_items, a.item_ids) == (len(w), len(hit), len(items), sorted(items))


def test_proximity_match_is_told_apart(spark):
    ship(spark)
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, "x " + item + " y"), (2, item.replace("delta ", "delta well ")), (3, "alpha kappa only")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    b = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: (r.n_items, r.n_near_items) for r in decontam.decontaminate(d, b).collect()}
    assert got == {1: (1, 0), 2: (0, 1), 3: (0, 0)}


def test_proximity_match_with_replaced_words(spark):
    """All near matches by brute force: words replaced, moved and dropped; terms rare, common and absent."""
    ship(spark)
    rng = __import__("random").Random(5)
    items = {i: [f"i{i}t{j}" if rng.random() < 0.5 else f"c{rng.randrange(12)}" for j in range(10 + i % 3)] for i in range(12)}
    items[50] = ["c1", "c2"]
    texts = ["one two three".split(), list(items[0])]
    for i in list(range(12)) * 8:
        w = list(items[i])
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice([[f"new{rng.randrange(9)}"], [], [w[at], "more"], [f"c{rng.randrange(12)}"]])
        texts.append([f"c{rng.randrange(12)}" for _ in range(rng.randrange(4))] + w + ["end"] * rng.randrange(2))
    # of item 60 two words occur nowhere; of item 61 the words replaced are as rare as any
    items[60] = [f"gone{j}" for j in range(2)] + [f"k{j}" for j in range(8)]
    items[61] = [f"m{j}" for j in range(10)]
    texts += [["a", "b"] + items[60][2:], ["x0", "x1"] + items[61][2:], ["x0", "x1", "x2"] + items[61][3:], items[61][:5], items[61][5:]]
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string").coalesce(1)
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = {r.doc_id: (r.n_items, r.n_near_items) for r in decontam.decontaminate(d, b).collect()}

    def near(w, g):
        return len(g) == 10 and any(sum(t not in w[max(0, s + o - 2):s + o + 3] for o, t in enumerate(g)) <= 2
                                    for s in range(len(w) - len(g) + 1))

    want = {}
    for i, w in enumerate(texts):
        kinds = []
        for t in items.values():
            gs = [t[j:j + min(10, len(t))] for j in range(max(1, len(t) - 9))]
            exact = any(w[s:s + len(g)] == g for g in gs for s in range(len(w) - len(g) + 1))
            kinds.append("exact" if exact else "near" if any(near(w, g) for g in gs) else "")
        want[i] = (kinds.count("exact"), kinds.count("near"))
    assert got == want
    n = len(texts)
    assert [want[i] for i in range(n - 5, n)] == [(0, 1), (0, 1), (0, 0), (0, 0), (0, 0)]
    assert sum(x for _, x in want.values()) > 20


def test_posting_lists_round_trip():
    import numpy as np

    v = np.array([0, 1, 127, 128, 16383, 16384, 2 ** 21, 2 ** 28, 2 ** 31 + 5])
    assert (decontam.decode(decontam.encode(v)[0]) == v).all()


def brute_spans(s):
    out = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", s)]
    out += [(*m.span(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", s)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", s):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and pii.luhn(d):
            out.append((*m.span(), "card"))
    out += [(*m.span(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", s)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda x: (x[0], pii.ORDER[x[2]]))


TRICKY = ["a@b.c@d.e", "a@b.c_d@e.f x@y", "@a.b a@.b a@b. é.x+1@ex-a.org.", "1.2.3.4.5.6.7.8", "1.2.3.256 0001.2.3.4 1.2.3",
          "4111 1111 1111 1111 4111-1111-1111-1112", "+1 (974) 555-3436 +12 +1234567890123456 +(12) 345678901", "+1.2.3.4.5.6.7.8.9",
          "5 5 5 5 5 5 5 5 5 5 5 5 5 5 5 5", "", "++49 30 1234567-", "1" * 40 + " 4111111111111111"]


@pytest.mark.parametrize("text", TRICKY)
def test_base_spans_match_the_patterns(text):
    assert pii.base_spans(text) == brute_spans(text)


def test_pii_query(spark, docs):
    got = {r.doc_id: r for r in queries.op3_pii_spans(spark, SF).collect()}
    for r in docs.collect():
        base = brute_spans(r.text or "")
        a = got[r.doc_id]
        joined = ",".join(f"{k}:{x}:{y}" for x, y, k in base)
        assert a.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [a.n_email, a.n_ip, a.n_card, a.n_phone] == [sum(s[2] == k for s in base) for k in pii.KINDS]
        assert set(filter(None, joined.split(","))) <= set(a.spans.split(","))


def test_pii_field_adds_secrets_and_nothing_else():
    rng = __import__("random").Random(3)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    texts = [f'some words token = "{key()}" and more, call +1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)} or '
             f"mail me.{i}@mail{i}.example.com at 10.{i}.3.4 in 2024, page {i}" for i in range(60)]
    w = pii.train(texts)
    secret = key()
    base, added = pii.all_spans(f'here token = "{secret}" and 300 of 2019, chapter 12 follow', w)
    assert base == [] and [(k, b - a) for a, b, k in added] == [("secret", 40)]


def test_line_rules_base_counts(spark, docs):
    got = {r.doc_id: r for r in linecrf.predict(docs, linecrf.fit(docs)).collect()}
    for r in docs.collect():
        s = r.text or ""
        w = SPACE_WORD.findall(s)
        lines = [x for x in s.split("\n") if SPACE_WORD.search(x)]
        n = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        twice = {i + d for i in range(len(w) - 2) if n[tuple(w[i:i + 3])] > 1 for d in range(3)}
        a = got[r.doc_id]
        assert (a.n_words, a.word_chars, a.n_symbols, a.n_dup_lines, a.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", s)), len(lines) - len(set(lines)), len(twice))
        assert a.base_failed == (len(w) < 50 or 100 * len(twice) > 50 * len(w))
        assert not (a.kept and a.base_failed)


def test_line_rules_collect_no_line_of_long_texts(spark):
    ship(spark)
    rows = [("\n".join(f"line {i} of a text" for i in range(n)),) for n in (3, 128, 129, 5000)]
    got = linecrf.sample_lines(spark.createDataFrame(rows, "text string")).collect()
    assert sorted(r.line for r in got) == sorted([*range(3), *range(128)])
    assert len({r.h for r in got}) == 2


def test_viterbi_and_marginals_against_enumeration():
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    x, bounds = rng.normal(size=(9, 3)), np.array([0, 4, 4, 5, 9])
    m = linecrf.Model(rng.normal(size=(2, 3)), rng.normal(size=(2, 2)))
    emit = x @ m.weights.T
    _, marg, _ = linecrf._forward_backward(emit, m.trans, linecrf._padded(bounds))
    labels = m.decode(x, bounds)
    for a, b in zip(bounds[:-1], bounds[1:]):
        paths = list(itertools.product([0, 1], repeat=b - a))
        score = np.array([sum(emit[a + i, y] for i, y in enumerate(p)) + sum(m.trans[u, v] for u, v in zip(p, p[1:])) for p in paths])
        if b > a:
            assert tuple(labels[a:b]) == paths[int(score.argmax())]
            p = np.exp(score - score.max()) / np.exp(score - score.max()).sum()
            for i in range(b - a):
                assert abs(marg[a + i, 1] - sum(q for q, y in zip(p, paths) if y[i])) < 1e-9


def test_warc_round_trip_and_seeking(spark, tmp_path):
    ship(spark)
    rows = [(i, f"http://h/{i}", ("same é" if i % 3 == 0 else f"page {i} " * i) if i != 5 else None) for i in range(1, 40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = warc.write_archives(pages, f"file://{tmp_path}/w", frame_bytes=500, bundle_bytes=2000)
    got = {int(r.id): r for r in warc.read_archives(index, payloads=True).collect()}
    assert index.groupBy("bundle", "frame").count().count() > 3
    for i, _, html in rows:
        first = next(j for j, _, h in rows if (h or "") == (html or ""))
        body = (html or "").encode()
        assert got[i].payload_bytes == len(body)
        assert got[i].record_type == ("response" if first == i else "revisit")
        assert got[i].refers_to == (None if first == i else str(first))
        assert got[i].payload == (body if first == i else None)
    one = warc.fetch(index.filter("id in (7, 20)")).collect()
    assert sorted((int(r.id), r.payload.decode()) for r in one) == [(7, rows[6][2]), (20, rows[19][2])]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    cur = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    want = Counter(tuple(r[names.index(c)] for c in cols) for r in cur.fetchall())
    assert Counter(tuple(r[c] for c in cols) for r in df.collect()) == want


def test_mixing_reaches_its_weights(spark):
    rows = [(i, "t", "big" if i % 10 else "small") for i in range(20000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    n = {r.source: r["count"] for r in mixing.mix(d, {"big": 1, "small": 3}).groupBy("source").count().collect()}
    assert abs(n["big"] - 5000) < 300 and abs(n["small"] - 15000) < 600  # a rate of 7.5
    big = mixing.mix(d.filter("doc_id < 200"), {"small": 1}, epochs=60).groupBy("doc_id").count().collect()
    assert len(big) == 20 and abs(sum(r["count"] for r in big) - 12000) < 500  # a rate of 600, in pieces


def test_a_hot_document_is_dealt_out(spark, monkeypatch):
    """A source of one document with a third of the mix: the same copies, whether drawn in one row or in many."""
    rows = [(i, "t", "big") for i in range(600)] + [(7000, "hot", "one"), (7001, "hot", None)] * 2
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    whole = sorted(mixing.mix(d).collect())
    monkeypatch.setattr(mixing, "CHUNK", 1)
    assert sorted(mixing.mix(d).collect()) == whole
    monkeypatch.setattr(mixing, "PIECE", 3.0)
    many = mixing.mix(d).filter("doc_id = 7000").groupBy("copy").count().collect()  # other draws, numbered on without gaps
    assert sorted(r.copy for r in many) == list(range(1, len(many) + 1)) and {r["count"] for r in many} == {2}
    assert abs(len(many) - 100) < 60


def test_line_windows_keep_the_first_place(spark):
    rows = [(2, "A\nB\nC\nD"), (1, "x\n A\nB\n\nC\t\ny"), (3, "A\nB"), (4, "R\nR\nR\nR\nR"), (5, "A\nB\nC\nB\nC\nD")]
    got = {r.doc_id: r.text for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "x\n A\nB\n\nC\t\ny", 2: "D", 3: "A\nB", 4: "R", 5: ""}
