"""Candidate components of the Jaccard join: edges of a dense group, and the groups they make."""

from ledgerlens.llm import jaccard
from ledgerlens.llm._spark import ship
from ledgerlens.llm.components import components


def test_a_dense_group_leaves_the_edges_of_few_runs(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(jaccard, "SMALL", 16)
    n = 200
    texts = [" ".join(f"x{i}" if j == i % 150 else f"w{j}" for j in range(150)) for i in range(n)]
    texts += [" ".join(f"{i}v{j}" if j == 50 * (i % 2) else f"{i // 2}u{j}" for j in range(150)) for i in range(40)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    signed = jaccard.sign(d, "doc_id", "text", 5).selectExpr("xxhash64(k1, k2) id", "sig").localCheckpoint()
    edges = jaccard.likely_links(signed, 0.8, 0.99).localCheckpoint()
    groups = {tuple(r) for r in jaccard.likely_groups(signed, 0.8, 0.99).collect()}

    def sets(rows):
        out = {}
        for v, label in rows:
            out.setdefault(label, set()).add(v)
        return sorted(map(sorted, out.values()))

    assert sets(groups) == sets(tuple(r) for r in components(edges).collect())
    assert sorted(map(len, sets(groups))) == [2] * 20 + [n]
    assert edges.count() < 3 * n
