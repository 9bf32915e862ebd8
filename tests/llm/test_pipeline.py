"""Each stage against what it should keep, and the run as a whole."""

from pyspark.sql import functions as F

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    one = P.language_id(spark, docs, SF)
    assert one.columns == docs.columns and one.count() >= 0.95 * len(before)
    two = P.line_dedup(spark, docs, SF)
    assert two.columns == docs.columns
    assert all(len(r.text) <= len(before[r.doc_id]) and r.n_chars == len(r.text) for r in two.collect() if r.text != before[r.doc_id])
    three = {r.doc_id for r in P.jaccard_join(spark, docs, SF).collect()}
    groups = P.jaccard.jaccard_join(docs).groupBy("class_id").agg(F.min("doc_id").alias("d")).collect()
    assert three == {r.d for r in groups}
    four = {r.doc_id for r in P.decontamination(spark, docs, SF).collect()}
    clean = P.decontam.decontaminate(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).filter("n_hit = 0")
    assert four == {r.doc_id for r in clean.select("doc_id").collect()}


def test_run(spark):
    out = P.run(spark, SF)
    assert {"doc_id", "text", "lang", "source", "n_chars", "copy", "position"} == set(out.columns)
    assert 0 < out.count() and [n for n, _ in P.STAGES][0] == "language_id" and len(P.STAGES) == 5


def texts(n):
    return [" ".join(f"t{i}w{j}" for j in range(30)) for i in range(n)]


def stage_jaccard(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return sorted(((r.doc_id, r.text) for r in P.jaccard_join(spark, docs, SF).collect()), key=str)


def test_jaccard_stage_keeps_each_group_without_ids(spark):
    t = texts(4)
    near = [x + " end" for x in t[:3]]
    got = stage_jaccard(spark, [(None, x, "s") for x in t[:3] + near] + [(None, t[3], "s")])
    assert len(got) == 4 and [d for d, _ in got] == [None] * 4
    assert {x.removesuffix(" end") for _, x in got} == set(t)


def test_jaccard_stage_keeps_both_groups_of_one_id(spark):
    a, b = texts(2)
    got = stage_jaccard(spark, [(1, a, "s"), (2, a, "s"), (1, b, "s"), (3, b, "s")])
    assert got == sorted([(1, a), (1, b)], key=str)


def test_jaccard_stage_merges_repeated_rows(spark):
    a, b, c = texts(3)
    rows = [(1, a, "y"), (1, a, "x"), (1, a, "x"), (2, a, "s")] + [(None, b, "s")] * 5 + [(7, b, "s"), (4, c, "s")]
    rows += [(5, "", "s"), (5, "", "s"), (6, None, "s")]
    got = stage_jaccard(spark, rows)
    assert got == sorted([(1, a), (None, b), (4, c), (5, ""), (5, ""), (6, None)], key=str)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert [r.source for r in P.jaccard_join(spark, docs, SF).filter("doc_id = 1").collect()] == ["x"]


AWKWARD = [(None, "x1 y1 z1\nx2 y2 z2\nx3 y3 z3\nown line", "s"), (3, "x1 y1 z1\nx2 y2 z2\nx3 y3 z3\nother line", "s"),
           (3, "x1 y1 z1\nx2 y2 z2\nx3 y3 z3", None), (4, "", "s"), (4, "", "s"), (5, None, "s"), (6, "alone", None), (6, "alone", None)]


def awkward(spark):
    return spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in AWKWARD],
                                 "doc_id long, text string, lang string, source string, n_chars int")


def keyed(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_line_stage_by_hand(spark):
    got = P.line_dedup(spark, awkward(spark), SF)
    assert keyed(got) == sorted([(None, AWKWARD[0][1]), (3, "other line"), (4, ""), (4, ""), (5, None), (6, "alone"), (6, "alone")], key=str)
    assert {r.n_chars for r in got.filter("text = 'other line'").collect()} == {10}


def test_decontamination_stage_by_hand(spark, tmp_path):
    item = "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"
    spark.createDataFrame([(1, item), (2, "alone"), (3, None), (4, "Own, line!")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    rows = [(1, f"a {item} b", "s"), (1, f"a {item} b", "s"), (1, "another text of the id", "s"), (None, item.replace(" w11", " end"), "s"),
            (None, item.replace("w5", "no"), "s"), (2, "alone", "s"), (None, None, "s"), (7, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = P.decontamination(spark, docs, str(tmp_path))
    assert keyed(got) == sorted([(1, "another text of the id"), (None, item.replace("w5", "no")), (2, "alone"), (None, None), (7, "")], key=str)
    assert got.columns == docs.columns


def test_mixing_stage_by_hand(spark):
    """Poisson inversion restated: equal weights of three sources, one epoch."""
    import math
    from hashlib import md5

    rows = [(i, f"t{i}", "big") for i in range(90)] + [(100 + i, "t", None) for i in range(9)] + [(200, "u", "small")] * 2 + [(None, "v", "small")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    n = {s: sum(r[2] == s for r in rows) for s in ("big", "small", None)}
    want = []
    for d, t, s in rows:
        rate = len(rows) / 3 / n[s]
        who = str(d) if d is not None else "text " + md5(t.encode()).hexdigest()
        u = (int(md5(f"mix:1:{who}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        k, total = 0, math.exp(-rate)
        while total < u:
            k += 1
            total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        want += [(d, t)] * k
    assert keyed(P.mixing_sources(spark, docs, SF)) == sorted(want, key=str) and len(want) > 30


def test_language_stage_on_awkward_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.limit(2).withColumn("doc_id", F.lit(None).cast("long"))
    odd = spark.createDataFrame([(900, t, "en", "s", 0) for t in (None, "", "123 ...", "\n")], docs.schema)
    got = P.language_id(spark, docs.unionByName(rows).unionByName(rows).unionByName(odd), SF)
    assert got.filter("doc_id is null").count() == 4 and got.filter("doc_id = 900").count() == 0
    assert got.columns == docs.columns


def test_stages_on_an_empty_table(spark):
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        out = stage(spark, none, SF)
        assert out.count() == 0 and set(none.columns) <= set(out.columns), name
